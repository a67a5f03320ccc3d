"""The registered queries of this package, one thin query for each operator, and the SQL some must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import (
    byte_bpe,
    forest,
    html_text,
    jaccard,
    language,
    licenses,
    lines,
    middle,
    periodic,
    token_counts,
    toxicity,
    warc,
    winnow,
)
from finlake.llm.common import bounded_batches, held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = held_out("doc_id", 5, 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~fold)
    model = toxicity.fit(docs.where(~fold).join(labels, "doc_id"))
    scored = docs.select("doc_id", fold.alias("held_out"), toxicity.score("text", model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = held_out("doc_id", 3, 1)
    model = language.fit(docs.where(~fold))
    found = docs.select("doc_id", fold.alias("held_out"), language.label("text", model, docs).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", F.size("found.spans").alias("n_spans"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"), least=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder for each source and thousand ids, whose first documents are its licence files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    place = F.concat(F.col("source"), F.lit("/p"), F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("/"))
    name = F.when(F.col("doc_id") % 1000 < 20, "LICENSE").otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    files = docs.select("doc_id", F.concat(place, name).alias("path"), "text")
    return licenses.license_scan(files)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.token_counts(docs, tokenizer("word_bpe_49k.json"), limit=2048)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return counted.select("doc_id", n_bytes, "n_tokens", "over_limit")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rule = tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", byte_bpe.round_trip("text", *rule).alias("coded"))
    return coded.select(
        "doc_id",
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored("output", "form"), 256).alias("restored_sha256"),
    )


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"), documents=10, least=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def repeating(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a tenth of the texts, by id, made to repeat their last words, as op13's contract says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(picked, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n).cast("int")
    rows = rows.select("doc_id", "text", "words", "g", a.alias("a"), n.alias("n"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.select("doc_id", "text", "words", "n", "a", p.alias("p"))
    again = F.transform(
        "words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeating(table(spark, sf_dir, "documents")).select("doc_id", periodic.periodic_runs("text").alias("found"))
    runs = F.col("found.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("n"), -r["start"], -r["period"].alias("q"))))
    listed = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "found", longest.cast("struct<n: long, s: long, q: long>").alias("best"), listed.alias("listed"))
    return rows.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("1000 * best.n div -best.q").alias("exponent_milli"),
        F.sha2(F.array_join("listed", ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
    with d as (
        select row_number() over () as r, doc_id,
               regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from documents
    ), i as (
        select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
    ), windows as (
        select distinct item_id, least(10, len(w)) as size, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') as g
        from i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(p) where len(w) > 0
    ), sizes as (select distinct size from windows), places as (
        select r, size, p, array_to_string(w[p:p + size - 1], ' ') as g
        from d, sizes, unnest(range(1, len(w) - size + 2)) t(p)
    ), found as (select r, p, size, item_id from places join windows using (size, g)), covered as (
        select r, count(distinct q) as n_hit from found, unnest(range(p, p + size)) t(q) group by r
    ), named as (
        select r, count(distinct item_id) as n_items,
               string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
        from found group by r
    )
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join covered using (r) left join named using (r)
"""

OP3_SQL = rf"""
    with recursive d as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents
    ), sets as (
        select doc_id, list_sort(list_distinct(case
            when len(w) = 0 then cast([] as varchar[])
            when len(w) < 3 then [array_to_string(w, ' ')]
            else [array_to_string(w[p:p + 2], ' ') for p in range(1, len(w) - 1)] end)) as s
        from d
    ), shingles as (select doc_id, len(s) as n, unnest(s) as g from sets), pairs as (
        select a.doc_id as a, b.doc_id as b
        from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having 190 * count(*) >= 90 * (a.n + b.n)
    ), reached(doc_id, other) as (
        select doc_id, doc_id from sets union select r.doc_id, b from reached r join pairs p on p.a = r.other
    )
    select doc_id, len(any_value(s)) as n_shingles, min(other) as component_id
    from sets join reached using (doc_id) group by doc_id
"""

# Base 32 of a SHA-1: five hexadecimal digits (20 bits) are four characters.
OP6_SQL = """
    with p as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as hex
        from pages
    ), d as (
        select *, max(page_id) over (partition by hex) as largest,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
                   (cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as integer), 1)), '')
               as payload_digest
        from p
    )
    select page_id, payload_bytes, payload_digest,
           case when page_id = largest then 'response' else 'revisit' end as record_type,
           case when page_id <> largest then largest end as refers_to
    from d
"""

_NOTICES = ", ".join(
    f"({-1 - i}, '{text.replace(chr(39), chr(39) * 2)}', '{name}')" for i, (name, text) in enumerate(licenses.TEMPLATES)
)

OP7_SQL = rf"""
    with files as (
        select doc_id, source || '/p' || cast(doc_id // 1000 as varchar) as dir,
               case when doc_id % 1000 < 20 then 'LICENSE' else 'd' || cast(doc_id as varchar) end as name,
               coalesce(text, '') as text
        from documents
    ), held as (
        select distinct doc_id, dir, name, trim(line) as passage
        from (select *, unnest(string_split(text, chr(10))) as line from files)
        where regexp_matches(line, '{licenses.CUE}')
        union
        select doc_id, dir, name, trim(text) from files where name = 'LICENSE' and trim(text) <> ''
    ), passages as (
        select row_number() over () as key, passage, count(*) as n, cast(null as varchar) as license
        from held group by passage
        union all select key, passage, 1, license from (values {_NOTICES}) t(key, passage, license)
    ), terms as (
        select key, n, term, count(*) as tf
        from (select key, n, unnest(regexp_extract_all(lower(passage), '{licenses.WORD}')) as term from passages)
        group by all
    ), weights as (
        select key, term, tf * (ln((1 + (select sum(n) from passages)) / (1 + df)) + 1) as w
        from terms join (select term, sum(n) as df from terms group by term) using (term)
    ), norms as (select key, sqrt(sum(w * w)) as norm from weights group by key), best as (
        select key, max({{'score': round(dot / (a.norm * b.norm), 6), 'license': license}}) as best
        from (
            select x.key, y.key as template, sum(x.w * y.w) as dot
            from weights x join weights y using (term) where x.key > 0 and y.key < 0 group by all
        ) join norms a using (key) join norms b on b.key = template
        join (select key as template, license from passages where key < 0) using (template)
        group by key
    ), own as (
        select doc_id, dir, name, max(best) as own
        from held join passages using (passage) join best using (key)
        where passages.key > 0 and best.score >= {licenses.LEAST} group by all
    ), licensed as (select dir as above, max(own) as best from own where name = 'LICENSE' group by dir), inherited as (
        select dir, max({{'depth': length(above), 'best': best, 'above': above}}) as up
        from (select distinct dir from files) join licensed
          on above = '' or dir = above or starts_with(dir, above || '/')
        group by dir
    )
    select doc_id, dir || '/' || files.name as path,
           coalesce(own.license, up.best.license) as license, coalesce(own.score, up.best.score) as score,
           case when own is not null then 'own' when up is not null then 'inherited' end as found,
           case when own is null and up is not null then up.above end as from_dir
    from files left join (select doc_id, own from own) using (doc_id) left join inherited using (dir)
"""

OP10_SQL = """
    with recursive v as (
        select vec_id, cast(embedding as double[]) as e from embeddings
        where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), good as (select *, sqrt(list_dot_product(e, e)) as norm from v where list_dot_product(e, e) > 0), links as (
        select a.vec_id as a, b.vec_id as b from good a join good b
          on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
        where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
    ), reached(vec_id, other) as (
        select vec_id, vec_id from embeddings union select r.vec_id, b from reached r join links l on l.a = r.other
    )
    select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
    from (select vec_id, min(other) as component_id from reached group by vec_id)
    left join (select a as vec_id, count(*) as n_links from links group by a) using (vec_id)
"""

_H = "cast('0x' || substr(hex, {}, 8) as bigint)".format

OP11_SQL = f"""
    with d as (
        select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hex,
               regexp_extract_all(coalesce(text, ''), '{middle.UNIT}') as u
        from documents
    ), cuts as (
        select *, len(u) as n, least({_H(1)} % (len(u) + 1), {_H(9)} % (len(u) + 1)) as a,
               greatest({_H(1)} % (len(u) + 1), {_H(9)} % (len(u) + 1)) as b,
               case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                      or {_H(17)} % 100 >= 90 then 'plain'
                    when {_H(25)} % 100 < 20 then 'spm' else 'psm' end as form
        from d
    ), parts as (
        select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid,
               array_to_string(u[b + 1:n], '') as post from cuts
    )
    select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
           case when form <> 'plain' then length(mid) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || post || '<M>' || mid
                  else '<S>' || post || '<P>' || pre || '<M>' || mid end) as output_sha256,
           sha256(text) as restored_sha256
    from parts
"""

OP12_SQL = r"""
    with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
    held as (
        select r, p, l[p] as line, translate(trim(l[p], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
        from d, unnest(range(1, len(l) + 1)) t(p)
    ), often as (select k from held where length(k) >= 1 group by k having count(distinct r) >= 10), kept as (
        select r, count(*) as n, string_agg(line, chr(10) order by p) as text
        from held where k not in (select k from often) group by r
    )
    select doc_id, len(l) as n_lines, len(l) - coalesce(n, 0) as n_dropped, sha256(coalesce(text, '')) as kept_sha256
    from d left join kept using (r)
"""

# crc32 bit by bit. Words q apart that are equal, as stretches of positions; a stretch of 3 q and 5 at least is a run,
# unless a run with a smaller period covers it.
OP13_SQL = r"""
    with d as (
        select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as w,
               xor(4294967295, list_reduce(
                   [4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                            lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) as h
        from documents
    ), planted as (
        select r, doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as picked, (h // 10) % greatest(len(w), 1) as a,
               1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) as p
        from d
    ), words as (
        select r, i, case when picked and i >= a then w[a + (i - a) % p + 1] else w[i + 1] end as x
        from planted, unnest(range(0, n)) t(i)
    ), equal as (
        select one.r, one.i, two.i - one.i as q
        from words one join words two on one.r = two.r and one.x = two.x and two.i > one.i
        join planted on planted.r = one.r where 4 * (two.i - one.i) <= n
    ), stretches as (
        select r, q, min(i) as s, count(*) as same
        from (select *, i - row_number() over (partition by r, q order by i) as island from equal) group by r, q, island
    ), periodic as (
        select r, q, s, same + q as n from stretches where same >= 3 * q and same + q >= 6
    ), runs as (
        select * from periodic x where not exists (
            select 1 from periodic y where y.r = x.r and y.q < x.q and y.s <= x.s and y.s + y.n >= x.s + x.n)
    ), gone as (select distinct r, i from runs, unnest(range(s + q, s + n)) t(i)), kept as (
        select r, string_agg(x, ' ' order by i) as text from words anti join gone using (r, i) group by r
    ), listed as (
        select r, count(*) as n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' order by s, q) as runs,
               first({'s': s, 'n': n, 'q': q} order by n desc, s, q) as best
        from runs group by r
    )
    select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.n as length, best.q as period,
           1000 * best.n // best.q as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256,
           sha256(coalesce(kept.text, '')) as collapsed_sha256
    from planted left join listed using (r) left join kept using (r)
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_jaccard": op3_jaccard,
    "op4_winnowing": op4_winnowing,
    "op5_html_text": op5_html_text,
    "op6_warc": op6_warc,
    "op7_licenses": op7_licenses,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_forest": op10_forest,
    "op11_middle": op11_middle,
    "op12_lines": op12_lines,
    "op13_runs": op13_runs,
}

ORACLE: dict[str, str] = {
    "op3_jaccard": OP3_SQL,
    "op4_winnowing": OP4_SQL,
    "op6_warc": OP6_SQL,
    "op7_licenses": OP7_SQL,
    "op10_forest": OP10_SQL,
    "op11_middle": OP11_SQL,
    "op12_lines": OP12_SQL,
    "op13_runs": OP13_SQL,
}
