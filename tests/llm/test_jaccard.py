import random
import re

import pytest

from finlake.llm import jaccard
from finlake.llm.common import Workspace
from finlake.llm.jaccard import jaccard_components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = {i: shingles(text, size) for i, text in rows}
    component = {i: i for i in sets}
    for _ in sets:
        before = dict(component)
        for i, a in sets.items():
            for j, b in sets.items():
                if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                    component[i] = component[j] = min(component[i], component[j])
        if component == before:
            break
    return {i: (len(sets[i]), component[i]) for i in sets}


def corpus(seed, families=6, copies=6):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = ["", None, " \n", "one", "ONE", "one two", "a b c", "a b c d", "a b c\td", "a b d c"]
    for _ in range(families):
        base = [rnd.choice(words) for _ in range(rnd.choice([6, 12, 40, 90, 200]))]
        for _ in range(copies):  # chains: each copy differs a little from the one before
            texts.append(" ".join(base))
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                base[rnd.randrange(len(base))] = rnd.choice(words)
    passage = " ".join(rnd.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 3, 20, 60)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 50), (1, 100)])
def test_against_brute_force(spark, size, percent):
    rows = corpus(size)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=size, percent=percent)
    assert {r["id"]: (r["n"], r["component"]) for r in found.collect()} == brute(rows, size, percent)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rows = corpus(11, families=2, copies=14)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["id"]: (r["n"], r["component"]) for r in found.collect()} == brute(rows, 3, 90)


def test_any_set_of_frequent_tokens_is_right(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "FEW", 2)
    rows = corpus(5)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=5, percent=80)
    assert {r["id"]: (r["n"], r["component"]) for r in found.collect()} == brute(rows, 5, 80)


def test_edges(spark):
    rows = [(3, "x y z"), (3, "x y z"), (None, "x y z"), (None, "alone a b"), (9, "X y\nz"), (4, None)]
    docs = spark.createDataFrame([r + (1, 2, "c") for r in rows], "doc_id long, text string, n int, node int, tokens string")
    got = sorted(map(str, (tuple(r) for r in jaccard_components(docs).collect())))
    assert got == sorted(map(str, [(3, 1, 3), (3, 1, 3), (None, 1, 3), (None, 1, None), (9, 1, 3), (4, 0, 4)]))
    assert jaccard_components(docs.limit(0)).collect() == []


def test_unlike_texts_of_the_same_words_are_left_out_early(spark, monkeypatch):
    rnd = random.Random(3)
    common, other = [f"c{i}" for i in range(6)], [f"o{i}" for i in range(100)]
    rows = [(i, [rnd.choice(common if rnd.random() < 0.7 else other) for _ in range(60)]) for i in range(400)]
    rows += [(400 + i, rows[i][1][:-1] + ["changed"]) for i in range(10)]
    rows = [(i, " ".join(words)) for i, words in rows]
    save, met, whole = Workspace.save, [], []

    def saved(self, df):
        table = save(self, df)
        if {"key1", "need"} <= set(df.columns):
            met.append(table.count())
        if "tokens" in df.columns:
            whole.append(table.where("tokens is not null").count())
        return table

    monkeypatch.setattr(Workspace, "save", saved)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["id"]: (r["n"], r["component"]) for r in found.collect()} == brute(rows, 3, 90)
    assert 20 <= met[0] < 60 and max(whole) < 60
