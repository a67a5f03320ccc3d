"""Line dedup against a plain version, its bitmaps, and its plan."""

import random

import pytest

from finlake.llm import lines
from finlake.llm.common import Workspace

SCHEMA = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(texts, documents, least, keep_first=False):
    split = [(t or "").split("\n") for t in texts]
    keys = [[line.strip(BLANKS).translate(FOLD) for line in one] for one in split]
    held = {}
    for one in keys:
        for key in set(one):
            held[key] = held.get(key, 0) + 1
    gone = {k for k, n in held.items() if n >= documents and len(k) >= least}
    spared, out = set(), []
    for one, key in zip(split, keys):
        kept = []
        for line, k in zip(one, key):
            if k not in gone or (keep_first and k not in spared):
                kept.append(line)
            spared.add(k)
        out.append((len(one), len(one) - len(kept), "\n".join(kept)))
    return out


def made(seed=3, n=150):
    draw = random.Random(seed)
    pool = ["Common Line", " common line\t", "COMMON LINE\r", "É is not é", "é is not é", "", "   ", "a", "\x0b\x0c", " x", "x"]
    pool += [f"line {i}" for i in range(60)]
    weights = [8, 4, 4, 2, 2, 6, 3, 5, 2, 1, 1] + [1] * 60
    return ["\n".join(draw.choices(pool, weights, k=draw.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("documents, least", [(10, 1), (2, 3), (1, 0), (10_000, 1), (5, 12)])
def test_against_plain_version(spark, documents, least):
    texts = made() + [None, "", "\n", "\n\n", "x\n", None]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(5, "doc_id")
    got = lines.dedup_lines(frame, documents=documents, least=least).collect()
    want = brute(texts, documents, least)
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in got} == dict(enumerate(want))
    assert len(got) == len(texts)


def test_bitmaps_are_runs_of_kept_lines(spark):
    frame = spark.createDataFrame([(1, "a\nb\nx\nx\nc\nx"), (2, "x"), (3, "y\nx")], SCHEMA)
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame, documents=2).collect()}
    assert [tuple(run) for run in got[1]["keep"]] == [(0, 2), (4, 1)] and got[1]["kept"] == "a\nb\nc"
    assert got[2]["keep"] == [] and got[2]["kept"] == ""
    assert [tuple(run) for run in got[3]["keep"]] == [(0, 1)]


def test_first_occurrence_stays_where_asked(spark):
    texts = made(seed=8)
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(1)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in lines.dedup_lines(frame, documents=2, keep_first=True).collect()}
    assert got == dict(enumerate(brute(texts, 2, 1, keep_first=True)))


def test_a_key_over_many_blocks(spark):
    """One line in every document: many tasks number the rows, so its group is dealt to many tasks."""
    texts = [f"one {i}\nshared by all\nshared by all" for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(16, "doc_id")
    got = lines.dedup_lines(frame, documents=400).collect()
    assert {(r["n_dropped"], r["kept"]) for r in got} == {(2, f"one {i}") for i in range(400)}
    assert {r["n_dropped"] for r in lines.dedup_lines(frame, documents=401).collect()} == {0}


def test_null_and_repeated_ids_and_rows(spark):
    rows = [(None, "s\na"), (None, "s\na"), (1, "s"), (1, "s"), (1, "s\nb")]
    got = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA), documents=5).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in got) == [("1", ""), ("1", ""), ("1", "b"), ("None", "a"), ("None", "a")]


def test_empty_table_long_text_and_clashing_names(spark):
    columns = "`my.id` long, `the text` string, row int, keep int, h1 int, lines int, block int, doc_id int, text int"
    names = dict(text="the text", doc_id="my.id")
    assert lines.dedup_lines(spark.createDataFrame([], columns), **names).collect() == []
    long = "\n".join(f"{i}\nsame" for i in range(100_000))
    rows = [(i, long, 0, 0, 0, 0, 0, 0, 0) for i in range(2)] + [(2, "same", 0, 0, 0, 0, 0, 0, 0)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, columns), documents=3, **names).collect()}
    assert got[0]["kept"] == "\n".join(map(str, range(100_000))) and got[0]["n_dropped"] == 100_000
    assert got[2]["kept"] == ""


def test_plan_is_native(spark):
    work = Workspace(spark)
    rows = lines.numbered_rows(spark.createDataFrame(list(enumerate(made())), SCHEMA), work)
    plan = lines.dedup_lines(rows.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    work.drop(rows)


def test_the_stream_follows_the_range(spark):
    """The window and the first step of the count take the sorted ranges as they are."""
    hashed = spark.range(100).selectExpr("id % 7 as h1", "id % 7 as h2", "id as row", "cast(id % 3 as int) as pos")
    counted = lines.occurrences(hashed)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("rangepartitioning") == 1
    assert plan.index("partial_count") < plan.index("Window") < plan.index("rangepartitioning")
    assert plan.index("hashpartitioning") < plan.index("partial_count")
    assert {(r["h1"], r["documents"], r["first"]["row"]) for r in counted.collect()} == {
        (k, len(range(k, 100, 7)), k) for k in range(7)
    }
