"""Periodic runs against a plain version that tries every period."""

import random

import numpy as np
import pytest

from finlake.llm import periodic


def brute(words):
    """Stretches of equal words q apart, of every q; those that a smaller period covers are left out."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s < n - q:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e - s + q >= max(6, 4 * q) and not any(t <= s and t + m >= e + q for t, m, _ in runs):
                runs.append((s, e - s + q, q))
            s = e
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = frame.select("id", periodic.periodic_runs("text").alias("f")).collect()
    assert len(got) == len(texts)
    total = 0
    for r in got:
        words = (texts[r["id"]] or "").encode().split()
        words = [w.decode() for w in words]
        want = brute(words)
        assert [tuple(x) for x in r["f"]["runs"]] == want
        assert r["f"]["n_words"] == len(words) and r["f"]["collapsed"] == collapsed(words, want)
        total += len(want)
    return total


def built(draw, alphabet):
    """Words with periodic stretches, also nested and overlapping ones."""
    words = []
    for _ in range(draw.randrange(1, 6)):
        unit = draw.choices(alphabet, k=draw.randrange(1, 7))
        if draw.random() < 0.4:
            unit = unit * draw.randrange(2, 6) + draw.choices(alphabet, k=draw.randrange(3))
        words += unit * draw.randrange(1, 8) + unit[: draw.randrange(len(unit))]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_against_plain_version(spark, letters):
    draw = random.Random(letters)
    alphabet = ["a", "b", "Ä", "long word".replace(" ", "-"), "x1", "B", "é", "."][:letters]
    texts = [" ".join(built(draw, alphabet)) for _ in range(250)]
    assert check(spark, texts) > 100


def test_random_words_of_two_kinds(spark):
    draw = random.Random(9)
    assert check(spark, [" ".join(draw.choices("ab", k=draw.randrange(200))) for _ in range(150)]) > 20


def test_edges(spark):
    texts = [None, "", " \n\t ", "one", "a a a a a", "a a a a a a", "A a A a A a A a", "a b c a b c a b c", "a b c a b c a b c a b c"]
    texts += ["a\nb\x0ba\x0cb\ra\tb  a b", "a a a a a a a a a a a a", "x a a a a a a y", "a b a b a b a b b b b b b b"]
    texts += ["a a a a a a", "a a a a a a"]  # repeated rows, and no run from one text into the next
    assert check(spark, texts)


def test_fibonacci_and_thue_morse_words(spark):
    a, b = ["a"], ["a", "b"]
    for _ in range(11):
        a, b = b, b + a
    thue = [bin(i).count("1") & 1 for i in range(512)]
    assert check(spark, [" ".join(b), " ".join(map(str, thue)), " ".join(["a"] * 3000)]) >= 1


def test_long_texts():
    """One class of very many positions, and a unit that comes again a thousand times."""
    def runs(words):
        return periodic.find_runs(np.array(words, np.uint64), np.array([0, len(words)]))

    assert runs([5] * 1_000_000) == [(0, 1_000_000, 1)]
    unit = list(range(500))
    assert runs([900, *unit * 1000, 7, 901]) == [(1, 500_000, 500)]
    draw = np.random.default_rng(2).integers(0, 3, 200_000)
    assert runs(draw.tolist())[:3] == brute(draw[:2000].tolist())[:3]


def test_sets_of_about_one_size(monkeypatch):
    """Units that differ in their last word unite large classes in the middle."""
    draw = random.Random(4)
    words = [w for _ in range(300) for w in (1, 1, 1, 1, 1, 1, draw.randrange(3, 6))]
    got = periodic.find_runs(np.array(words, np.uint64), np.array([0, len(words)]))
    assert got == brute(words)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "text string, runs int, n_words int, collapsed int")
    assert empty.select(periodic.periodic_runs("text").alias("f"), "runs").collect() == []
