"""Licences of files, by DataFrame operations only.

Passages are the lines of a file that speak of a licence, and for a licence file its whole text too.
Passages and licence templates are sparse vectors of term frequencies weighted by inverse frequency over
all passages; the template with the highest cosine of ``least`` or more names a passage's licence. A file
takes the best of its passages. Before that, a licence file is compared as a whole with whole licence texts
(``licence_texts``, public texts kept word for word), under the same weights; a cosine of ``WHOLE`` or more names it, whatever
its lines say. Texts of one family differ in a few sentences only, so where a title with a version stands in the first lines
of such a file, as in all GNU licences, the title names it: the Affero licence is not taken for its neighbour.
A file without one inherits from the nearest directory above it that has
a licence file: distinct directories are joined with their ancestors first, then files with their directory.

Equal passages are scored once, with their number as weight, so a notice in a third of all files is one
vector. The only broadcast side that Spark may choose is bounded by the fixed list of templates.

Null and empty texts have no passages. Files with a null path inherit nothing. Rows may repeat; each
keeps a result of its own. Of equal scores the licence last by name wins. Columns named as a result (in any case) are
left out, all others are kept, whatever their names.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.common import Workspace
from finlake.llm.middle import quoted

LEAST = 0.5
#: Licence texts resemble each other and all long texts; a file that is one, with its own names and years, is above this.
WHOLE = 0.8
#: Notices by which licences are known. A licence may have several.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the copyright holder may be used to endorse products."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal license."),
    ("Proprietary", "Copyright. All rights reserved. No license is granted; unauthorized copying is prohibited."),
)
CUE = r"(?i)licen[cs]|copyright|spdx|all rights reserved|redistribut|permission is hereby|free software|public domain"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"
#: How the titles of the GNU family begin, and what they are called; the version follows.
FAMILIES = (("affero ", "AGPL-"), ("lesser ", "LGPL-"), ("library ", "LGPL-"), ("", "GPL-"))
TITLE = r"^(?:.{0,200}?\W)??gnu (affero |lesser |library |)general public license\W+version ([0-9]+(?:\.[0-9]+)?)"
RESULTS = ("license", "score", "found", "from_dir")
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def _templates(spark: SparkSession) -> DataFrame:
    """The fixed list (key, passage, n, license), with keys below zero."""
    listed = F.array(*(F.struct(F.lit(name).alias("license"), F.lit(text).alias("passage")) for name, text in TEMPLATES))
    rows = spark.range(1).select(F.posexplode(listed).alias("i", "t"))
    return rows.select((-1 - F.col("i")).cast("long").alias("key"), "t.passage", F.lit(1).cast("long").alias("n"), "t.license")


def _texts(spark: SparkSession) -> DataFrame:
    """The whole licence texts (license, passage)."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    listed = F.array(*(F.struct(F.lit(f.stem).alias("license"), F.lit(f.read_text()).alias("passage")) for f in files))
    return spark.range(1).select(F.explode(listed).alias("t")).select("t.*")


def _terms(passage: Column) -> Column:
    return F.regexp_extract_all(F.lower(passage), F.lit(WORD), F.lit(0))


def _title(text: Column) -> Column:
    """The licence that the first lines of a text name as its title, or null."""
    lines = F.filter(F.transform(F.split(text, r"\n"), F.trim), lambda line: line != "")
    head = F.regexp_replace(F.lower(F.array_join(F.slice(lines, 1, 5), " ")), r"\s+", " ")
    family, version = (F.regexp_extract(head, TITLE, i) for i in (1, 2))
    name = F.lit(None)
    for word, called in FAMILIES:
        name = F.when(family == word, called).otherwise(name)
    number = F.when(F.contains(version, F.lit(".")), version).otherwise(F.concat(version, F.lit(".0")))
    return F.when(version != "", F.concat(name, number))


def _scored(distinct: DataFrame, wholes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(key, license, score): the best template of each distinct passage (key, passage, n); and the best text of wholes (key)."""
    templates = _templates(distinct.sparkSession)
    both = distinct.unionByName(templates.drop("license"))
    total = both.agg(F.sum("n")).first()[0]
    terms = both.select("key", "n", F.explode(_terms(F.col("passage"))).alias("term"))
    terms = work.save(terms.groupBy("key", "n", "term").agg(F.count("*").alias("tf")))
    spread = terms.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1
    weights = work.save(terms.join(spread, "term").select("key", "term", (F.col("tf") * idf).alias("w")))
    norms = weights.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    one = weights.where("key >= 0")
    two = weights.where("key < 0").select(F.col("key").alias("template"), "term", F.col("w").alias("tw"))
    known = norms.where("key < 0").select(F.col("key").alias("template"), F.col("norm").alias("tnorm"))
    known = known.join(templates.select(F.col("key").alias("template"), "license"), "template")
    dots = one.join(two, "term").groupBy("key", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)
    scored = dots.join(norms, "key").join(known, "template")
    best = scored.groupBy("key").agg(F.max(F.struct(cosine.alias("score"), "license")).alias("best"))
    texts = _texts(distinct.sparkSession).select("license", F.explode(_terms(F.col("passage"))).alias("term"))
    texts = texts.groupBy("license", "term").agg(F.count("*").alias("tf")).join(spread, "term", "left")
    texts = work.save(texts.select("license", "term", (F.col("tf") * F.coalesce(idf, F.log(1 + F.lit(total)) + 1)).alias("tw")))
    sizes = texts.groupBy("license").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    some = one.join(wholes, "key", "left_semi")
    dots = some.join(texts, "term").groupBy("key", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    named = dots.join(norms, "key").join(sizes, "license")
    named = named.groupBy("key").agg(F.max(F.struct(cosine.alias("score"), "license")).alias("best"))
    return best.select("key", "best.license", "best.score"), named.select("key", "best.license", "best.score")


def _renamed(files: DataFrame, path: str, text: str) -> DataFrame:
    """(_kept, _path, _text): what is returned as it came, apart, so that no name in it matters."""
    kept = [quoted(c) for c in files.columns if c != text and c.lower() not in RESULTS]
    return files.select(
        F.struct(*kept).alias("_kept"),
        quoted(path).cast("string").alias("_path"),
        F.coalesce(quoted(text), F.lit("")).alias("_text"),
    )


def license_scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST) -> DataFrame:
    """The frame without its text, with ``license``, ``score``, ``found`` (own, inherited or null) and ``from_dir``."""
    work, files = Workspace(files.sparkSession), _renamed(files, path, text)
    name = F.element_at(F.split("_path", "/"), -1)
    is_file = F.coalesce(name.rlike(LICENCE_FILE), F.lit(False))
    text = F.col("_text")
    lines = F.filter(F.split(text, r"\n"), lambda line: line.rlike(CUE))
    whole = F.when(is_file & (F.trim(text) != ""), F.array_union(lines, F.array(F.trim(text)))).otherwise(lines)
    base = work.save(
        files.select(
            F.monotonically_increasing_id().alias("_row"),
            "_kept",
            F.regexp_extract("_path", r"^(.*)/[^/]*$", 1).alias("_dir"),
            is_file.alias("_is_file"),
            F.array_distinct(F.transform(whole, F.trim)).alias("_passages"),
            F.when(is_file & (F.trim(text) != ""), F.trim(text)).alias("_whole"),
        )
    )
    held = base.select("_row", "_dir", "_is_file", F.explode("_passages").alias("passage"))
    distinct = held.groupBy("passage").agg(F.count("*").alias("n"))
    distinct = work.save(distinct.withColumn("key", F.monotonically_increasing_id()))
    wholes = base.where("_whole is not null").select(
        "_row", "_dir", "_is_file", F.col("_whole").alias("passage"), _title(F.col("_whole")).alias("title")
    )
    wholes = work.save(wholes.join(distinct.select("key", "passage"), "passage").drop("passage"))
    best, named = _scored(distinct, wholes, work)
    best = best.where(F.col("score") >= least)
    best = work.save(best.join(distinct.select("key", "passage"), "key").drop("key"))
    columns = ["_row", "_dir", "_is_file", "score", "license"]
    by_line = held.join(best, "passage").select(*columns, F.lit(0).alias("whole"))
    by_text = wholes.join(named.where(F.col("score") >= WHOLE), "key")
    gnu = F.col("title").isNotNull() & F.col("license").contains("GPL-")
    by_text = by_text.withColumn("license", F.when(gnu, F.col("title")).otherwise(F.col("license")))
    by_text = by_text.select(*columns, F.lit(1).alias("whole"))
    own = by_line.unionByName(by_text).groupBy("_row", "_dir", "_is_file").agg(F.max(F.struct("whole", "score", "license")).alias("own"))
    own = work.save(own)
    licensed = own.where("_is_file").groupBy(F.col("_dir").alias("above")).agg(F.max("own").alias("best"))
    dirs = base.where("_dir is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    lines_up = dirs.select("_dir", F.explode(F.array_union(F.array(F.lit("")), above)).alias("above"))
    inherited = (
        lines_up.join(licensed, "above")
        .groupBy("_dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), F.col("best"), F.col("above"))).alias("from_above"))
    )
    joined = base.join(own.select("_row", "own"), "_row", "left").join(inherited, "_dir", "left")
    has_own, has_above = F.col("own").isNotNull(), F.col("from_above").isNotNull()
    return joined.select(
        "_kept.*",
        F.coalesce("own.license", "from_above.best.license").alias("license"),
        F.coalesce("own.score", "from_above.best.score").alias("score"),
        F.when(has_own, "own").when(has_above, "inherited").alias("found"),
        F.when(~has_own & has_above, F.col("from_above.above")).alias("from_dir"),
    )
