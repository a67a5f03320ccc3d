import duckdb
import numpy as np
import pytest

from finlake.llm import forest, queries
from finlake.llm.forest import near_vectors

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, threshold=0.9):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and len(v) == 16 and None not in v}
    good = {i: v / np.linalg.norm(v) for i, v in good.items() if np.isfinite(v).all() and v.any()}
    links = {i: {j for j in good if j != i and good[i] @ good[j] >= threshold} if i in good else set() for i, _ in rows}
    component = {i: i for i in links}
    for _ in range(len(rows)):
        new = {i: min([component[i], *(component[j] for j in links[i])]) for i in links}
        if new == component:
            break
        component = new
    return {i: (len(links[i]), component[i]) for i in links}


def rows_of(seed, n=500):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    x[100:180] = x[0] + rng.normal(size=(80, 16)) * 0.25  # about the threshold
    x[200:300] = x[1] + rng.normal(size=(100, 16)) * 0.01
    x[300:320] = x[2]
    x[320:330] = 5 * x[3]
    return list(enumerate(x.tolist()))


@pytest.mark.parametrize("leaf, part", [(32, 20), (256, 2048)])
def test_against_brute_force(spark, monkeypatch, leaf, part):
    monkeypatch.setattr(forest, "PART", part)
    rows = rows_of(3)
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0] * 15]
    rows += [(1000 + i, v) for i, v in enumerate(bad)]
    vectors = spark.createDataFrame([r + (1, 2) for r in rows], SCHEMA + ", node int, leaf int")
    got = {r["id"]: r for r in near_vectors(vectors, leaf=leaf).collect()}
    expected = brute(rows)
    assert got.keys() == expected.keys()
    assert all(got[i]["n_links"] <= n for i, (n, _) in expected.items())  # none below the threshold, none twice
    recall = sum(r["n_links"] for r in got.values()) / sum(n for n, _ in expected.values())
    assert recall >= 0.97
    if leaf == 256:
        assert sum(got[i]["component"] == c for i, (_, c) in expected.items()) >= 0.99 * len(rows)
    assert all(r["kept"] == (r["id"] == r["component"]) for r in got.values())
    assert all((got[i]["n_links"], got[i]["component"]) == (0, i) for i in range(1000, 1000 + len(bad)))


def test_equal_rows_and_null_ids(spark):
    v = [1.0, 2.0]
    rows = [(5, v), (5, v), (None, v), (None, [-1.0, 4.0]), (2, [2.0, 4.0])]
    got = sorted((str(r["id"]), r["n_links"], str(r["component"]), r["kept"]) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("2", 3, "2", True), ("5", 3, "2", False), ("5", 3, "2", False), ("None", 0, "None", False), ("None", 3, "2", False)]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r["n_links"] for r in near_vectors(spark.createDataFrame([(1, None)], SCHEMA)).collect()] == [0]


def test_each_width_links_within_itself(spark):
    rng = np.random.default_rng(5)
    rows = list(enumerate(rng.normal(size=(40, 8)).tolist()))
    narrow = rng.normal(size=(12, 5))
    narrow[3:6] = narrow[0]
    narrow[6] = narrow[1] * 3 + 0.01
    rows += [(100 + i, v) for i, v in enumerate(narrow.tolist())] + [(200, [1.0]), (201, [2.0]), (202, [-1.0]), (203, [1.0] * 9)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    embeddings = vectors.toArrow()  # noqa: F841
    expected = duckdb.sql(f"select vec_id, n_links, component_id, kept from ({queries.OP10_SQL}) order by 1").fetchall()
    assert sorted(tuple(r) for r in near_vectors(vectors).collect()) == expected
    assert {r[0]: r[1] for r in expected}[103] == 3
