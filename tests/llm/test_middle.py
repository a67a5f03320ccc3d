"""Fill-in-middle against a plain version with Python's re, and its way back."""

import hashlib
import random
import re

import pytest

from finlake.llm import middle

SCHEMA = "doc_id long, text string"


def brute(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    pre, mid, post = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{post}<P>{pre}<M>{mid}", len(pre), len(mid)
    return n, "psm", f"<P>{pre}<S>{post}<M>{mid}", len(pre), len(mid)


def found(frame):
    made = middle.fill_in_middle(frame)
    return made.withColumn("restored", middle.restored("output", "form")).collect()


def texts():
    draw = random.Random(5)
    alphabet = ["a", "Zb", "word", " ", "\n", "é", "漢", "😀", "<", ">", "P", "<P", "$1", "\\", "{2}", "\x00", " ", "\r\n"]
    return ["".join(draw.choices(alphabet, k=draw.randrange(60))) for _ in range(300)]


def test_against_plain_version(spark):
    marked = ["<P>", "a <S> b", "x<M", "<M>y", "<<P>>", "<P <S <M"]
    rows = list(enumerate(texts() + marked + [None, "", " ", "one"]))
    rows += [(None, "an id that is null"), (None, None), (7, "the same row"), (7, "the same row"), (-3, "minus")]
    got = found(spark.createDataFrame(rows, SCHEMA))
    key = str
    assert sorted(((r[0], *r[1:6]) for r in got), key=key) == sorted(((i, *brute(i, t)) for i, t in rows), key=key)
    assert sorted((str(r["doc_id"]), r["restored"]) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_very_long_text(spark):
    long = "ab 漢\n" * 400_000
    rows = [(i, long) for i in range(1, 4)]
    for r in found(spark.createDataFrame(rows, SCHEMA)):
        n, form, output, prefix, mid = brute(r["doc_id"], long)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, mid)
        assert r["output"] == output and r["restored"] == long


@pytest.mark.parametrize("plain, spm, forms", [(100, 0, {"plain"}), (0, 100, {"spm"}), (0, 0, {"psm"})])
def test_shares(spark, plain, spm, forms):
    frame = spark.createDataFrame([(i, "some words here") for i in range(30)], SCHEMA)
    assert {r["form"] for r in middle.fill_in_middle(frame, plain_percent=plain, spm_percent=spm).collect()} == forms


def test_empty_table_and_clashing_names(spark):
    columns = "`my.id` long, `the ``text` string, n string, form int, output string, a int, b int, doc_id int, text int"
    empty = spark.createDataFrame([], columns)
    names = dict(text="the `text", doc_id="my.id")
    assert middle.fill_in_middle(empty, **names).collect() == []
    row = spark.createDataFrame([(5, "three small words", "x", 1, "y", 2, 3, 4, 6)], columns)
    (made,) = middle.fill_in_middle(row, **names).collect()
    assert tuple(made) == (5, *brute(5, "three small words"))


def test_no_python_and_no_shuffle(spark):
    plan = middle.fill_in_middle(spark.createDataFrame([(1, "a")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
