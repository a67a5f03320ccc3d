import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from finlake.llm import licenses
from finlake.llm.licenses import TEMPLATES, WORD, license_scan

FILES = [
    ("a/LICENSE", "Released under the MIT License."),
    ("a/b/x.py", "code\nLicensed under the Apache License, Version 2.0.\nmore"),
    ("a/b/y.py", "code without"),
    ("a/b/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\n"),
    ("a/b/c/d/z.py", None),
    ("a/b/c/d/z.py", ""),
    ("ab/z.py", "the licence of poets\nis a permission of another kind: licensed to dance"),
    ("top.py", "x"),
    (None, "Licensed under CC BY-NC 4.0."),
    (None, None),
]
NAMES = {(p, t): None for p, t in FILES}


def scan(spark, files):
    rows = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit("clash")).withColumn("key", F.lit(1))
    return {(r["path"], i): r for i, r in enumerate(license_scan(rows).collect())}


def test_own_and_inherited(spark):
    found = sorted((str(r["path"]), str(r["license"]), str(r["found"]), str(r["from_dir"])) for r in scan(spark, FILES).values())
    assert found == sorted(
        [
            ("a/LICENSE", "MIT", "own", "None"),
            ("a/b/x.py", "Apache-2.0", "own", "None"),
            ("a/b/y.py", "MIT", "inherited", "a"),
            ("a/b/c/COPYING.txt", "GPL-3.0", "own", "None"),
            ("a/b/c/d/z.py", "GPL-3.0", "inherited", "a/b/c"),
            ("a/b/c/d/z.py", "GPL-3.0", "inherited", "a/b/c"),
            ("ab/z.py", "None", "None", "None"),
            ("top.py", "None", "None", "None"),
            ("None", "CC-BY-NC-4.0", "own", "None"),
            ("None", "None", "None", "None"),
        ]
    )


def test_a_licence_at_the_root_covers_all(spark):
    found = scan(spark, [*FILES, ("LICENSE", "Licensed under CC BY 4.0.")])
    assert {r["from_dir"] for r in found.values() if r["path"] == "top.py"} == {""}


def test_scores_are_plain_cosines(spark):
    notices = [
        "Licensed under the Apache License, Version 2.0, or MIT",
        "license of another kind",
        "copyright by nobody, all rights reserved",
        "copyright by nobody, all rights reserved",
    ]
    rows = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(notices)], "path string, text string")
    got = {r["path"]: (r["license"], r["score"]) for r in license_scan(rows, least=0.0).collect()}
    bags = [Counter(re.findall(WORD, t.lower())) for t in notices]
    known = [(name, Counter(re.findall(WORD, t.lower()))) for name, t in TEMPLATES]
    df = Counter(w for bag in [*bags, *(b for _, b in known)] for w in bag)
    total = len(bags) + len(known)
    weigh = lambda bag: {w: n * (math.log((1 + total) / (1 + df[w])) + 1) for w, n in bag.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for i, bag in enumerate(bags):
        a = weigh(bag)
        best = max((round(sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b), 6), n) for n, b in ((n, weigh(b)) for n, b in known))
        assert got[f"f{i}"][0] == best[1] and abs(got[f"f{i}"][1] - best[0]) < 2e-6


def test_no_files(spark):
    assert license_scan(spark.createDataFrame([], "path string, text string")).collect() == []


def test_whole_licence_texts(spark):
    folder = Path(licenses.__file__).parent / "licence_texts"
    texts = {f.stem: f.read_text() for f in folder.glob("*.txt")}
    assert {"BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0"} <= texts.keys()
    head = "Copyright (c) 2019, Jane Roe and others.\nAll rights reserved.\n\n"
    files = [(f"{name}/LICENSE", head + text.replace("copyright holder", "Example Foundation")) for name, text in texts.items()]
    files += [(f"{name}/x.py", "code") for name in texts]
    found = {r["path"]: r["license"] for r in license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert found == {path: path.split("/")[0] for path, _ in files}


def test_a_title_tells_texts_of_one_family_apart(spark):
    folder = Path(licenses.__file__).parent / "licence_texts"
    gpl = (folder / "GPL-3.0.txt").read_text()
    affero = gpl.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)
    affero = affero.replace("13. Use with the GNU Affero General Public License.", "13. Remote Network Interaction; Use with the GNU General Public License.")
    lesser = (folder / "LGPL-2.1.txt").read_text()
    files = [("a/LICENSE", affero), ("a/b/x.py", "code"), ("g/COPYING", gpl), ("g/y.py", ""), ("l/LICENSE.txt", lesser)]
    files += [("n/LICENSE", "Some project, by its authors\n\n" + affero), ("u/UNLICENSE", (folder / "Unlicense.txt").read_text())]
    files += [("i/LICENSE", (folder / "ISC.txt").read_text().replace("<year> <copyright holders>", "2001 Jane Roe"))]
    found = {r["path"]: r["license"] for r in license_scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert found == {
        "a/LICENSE": "AGPL-3.0", "a/b/x.py": "AGPL-3.0", "g/COPYING": "GPL-3.0", "g/y.py": "GPL-3.0",
        "l/LICENSE.txt": "LGPL-2.1", "n/LICENSE": "AGPL-3.0", "u/UNLICENSE": "Unlicense", "i/LICENSE": "ISC",
    }


def test_clashing_names(spark):
    columns = "`my.path` string, `the.text` string, License string, _path int, _dir int, `a.b` int, whole int, key int"
    rows = [("p/LICENSE", "SPDX-License-Identifier: MIT", "x", 1, 2, 3, 4, 5), ("p/f", None, "y", 6, 7, 8, 9, 10), (None, "", "z", 1, 1, 1, 1, 1)]
    got = license_scan(spark.createDataFrame(rows, columns), path="my.path", text="the.text")
    assert got.columns == ["my.path", "_path", "_dir", "a.b", "whole", "key", "license", "score", "found", "from_dir"]
    assert sorted((str(r["my.path"]), r["a.b"], r["license"], r["found"]) for r in got.collect()) == [
        ("None", 1, None, None), ("p/LICENSE", 3, "MIT", "own"), ("p/f", 8, "MIT", "inherited"),
    ]
