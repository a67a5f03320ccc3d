"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits its vectors at the median of a random projection, again and again, until a leaf is small
enough. Vectors within ``spill`` of a split go to both sides. Vectors are compared within leaves, exactly
and in double precision; a pair of cosine ``threshold`` or more links, and links unite vectors.

The splits of a tree are fitted on a sample of about ``sample`` rows drawn by a hash of the id, of
``sample_numbers`` components at most (documented bounds); every vector is
indexed. Two vectors with cosine c are ``sqrt(2 - 2c)`` apart, and no
further apart on any projection, so with a spill of half of that over the square root of the dimension few of
them are parted, and several trees find almost all: recall is measured against brute force in the tests.

A pair that meets in several leaves counts in the first only: the leaves of each vector travel with it,
in the order of the trees. A large leaf is dealt out as pairs of parts of about ``PART`` vectors, so
none is gathered in one task, and a dense region costs what its number of links costs. Equal vectors are
one vector with a weight until the end. Counts are summed by vector and links are kept only as far as
they unite vectors; no list of pairs is made.

Vectors link with vectors of their own length only; each length that occurs has a forest of its own.
Vectors that are null or empty, zero, or hold nulls or non-finite components link with nothing. Rows with a null id take part only through an equal vector; their component is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import Workspace, by_key
from finlake.llm.components import components
from finlake.llm.language import sampled

TREES = 5
LEAF = 256
SAMPLE = 50_000
SAMPLE_NUMBERS = 8 << 20
PART = 2048
LINKS = "a long, b long, links long"


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of a heap; ``cut`` is nan at a leaf."""

    directions: np.ndarray
    cuts: np.ndarray


def _grown(x: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
    """Splits a sample at medians, ``depth`` times."""
    nodes = (1 << depth) - 1
    directions = rng.standard_normal((nodes, x.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    cuts = np.zeros(nodes)
    rows = {0: np.arange(len(x))}
    for node in range(nodes):
        mine = rows.pop(node)
        projected = x[mine] @ directions[node]
        cuts[node] = np.median(projected) if len(mine) else 0.0
        rows[2 * node + 1], rows[2 * node + 2] = mine[projected <= cuts[node]], mine[projected > cuts[node]]
    return Tree(directions, cuts)


def _leaves(tree: Tree, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that each row of x goes to."""
    rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
    while len(nodes) and nodes.min() < len(tree.cuts):
        side = np.einsum("ij,ij->i", x[rows], tree.directions[nodes]) - tree.cuts[nodes]
        left, right = side <= spill, side >= -spill
        rows = np.concatenate((rows[left], rows[right]))
        nodes = np.concatenate((2 * nodes[left] + 1, 2 * nodes[right] + 2))
    return rows, nodes


def _unit(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors, all fit for it, at length 1 in double precision."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assigned(nodes: DataFrame, trees: list[Tree], width: int, spill: float) -> DataFrame:
    """(node, weight, vector, leaves): the leaves of each vector over all trees, in ascending order."""
    shared = nodes.sparkSession.sparkContext.broadcast(trees)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(batch.column("vector"), width)
            found, base = [], 0
            for tree in shared.value:
                rows, leaves = _leaves(tree, unit, spill)
                found.append((rows, leaves + base))
                base += 2 * len(tree.cuts) + 1
            rows, leaves = (np.concatenate(part) for part in zip(*found))
            order = np.lexsort((leaves, rows))
            offsets = np.searchsorted(rows[order], np.arange(batch.num_rows + 1))
            yield pa.record_batch(
                {
                    "node": batch.column("node"),
                    "weight": batch.column("weight"),
                    "vector": batch.column("vector"),
                    "leaves": pa.ListArray.from_arrays(offsets.astype(np.int32), leaves[order].astype(np.int32)),
                }
            )

    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"node long, weight long, vector {kind}, leaves array<int>"
    return nodes.select("node", "weight", "vector").mapInArrow(assign, schema)


def _met_before(leaves: pa.ListArray, rows: np.ndarray, leaf: int) -> np.ndarray:
    """For each pair of some rows, whether they share an earlier leaf."""
    lists = leaves.take(pa.array(rows))
    owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy(zero_copy_only=False))
    held = lists.flatten().to_numpy(zero_copy_only=False)
    owner, held = owner[held < leaf], held[held < leaf]
    names, place = np.unique(held, return_inverse=True)
    inside = np.zeros((len(rows), len(names)), np.float32)
    inside[owner, place] = 1
    return inside @ inside.T > 0


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _compared(threshold: float, width: int):
    """Counts the links of each vector of a pair of parts of a leaf, and gives links that unite them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, ["leaf", "one", "two"]):
            table = table.combine_chunks()
            leaf, one, two = (table.column(c)[0].as_py() for c in ("leaf", "one", "two"))
            part, node, weight = (table.column(c).to_numpy() for c in ("part", "node", "weight"))
            unit = _unit(table.column("vector").combine_chunks(), width)
            left = np.flatnonzero(part == one)
            right = left if one == two else np.flatnonzero(part == two)
            if not len(left) or not len(right):
                continue
            close = unit[left] @ unit[right].T >= threshold
            if one == two:
                close = np.triu(close, 1)
            i, j = np.nonzero(close)
            if not len(i):
                continue
            i, j = left[i], right[j]
            rows = np.unique(np.concatenate((i, j)))
            met = _met_before(table.column("leaves").combine_chunks(), rows, leaf)
            new = ~met[np.searchsorted(rows, i), np.searchsorted(rows, j)]
            i, j = i[new], j[new]
            if not len(i):
                continue
            links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
            union = _Union(len(node))
            kept = [(x, y) for x, y in zip(i.tolist(), j.tolist()) if union.join(x, y)]
            some = np.flatnonzero(links)
            yield pa.record_batch(
                {
                    "a": np.concatenate((node[some], node[[x for x, _ in kept]])),
                    "b": pa.array([None] * len(some) + node[[y for _, y in kept]].tolist(), pa.int64()),
                    "links": np.concatenate((links[some], np.zeros(len(kept)))).astype(np.int64),
                }
            )

    return compare


def _links(
    joinable: DataFrame, count: int, width: int, work: Workspace, threshold: float, trees: int, leaf: int, sample: tuple[int, int], seed: int
) -> DataFrame:
    """(a, b, links) of the vectors of one width: numbers of links by node, and links that unite nodes."""
    some = _unit(sampled(joinable, "node", max(1, min(sample[0], sample[1] // width))).select("vector").toArrow().column(0).combine_chunks(), width)
    depth = max(0, int(np.ceil(np.log2(max(1, count) / leaf))))
    depth = min(depth, max(0, int(np.log2(max(1, len(some)) / 8))))  # a split rests on 8 rows of the sample or more
    rng = np.random.default_rng(seed)
    spill = float(np.sqrt(max(0.0, 2 - 2 * threshold) / width)) / 2
    forest = [_grown(some, depth, rng) for _ in range(trees)]
    placed = work.save(_assigned(joinable, forest, width, spill))
    in_leaf = placed.withColumn("leaf", F.explode("leaves"))
    parts = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = in_leaf.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    # Each part meets every part of its leaf, itself included, once.
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = met.select("leaf", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", "node", "weight", "vector", "leaves")
    return work.save(
        met.repartition("leaf", "one", "two")
        .sortWithinPartitions("leaf", "one", "two")
        .mapInArrow(_compared(threshold, width), LINKS)
    )


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    sample_numbers: int = SAMPLE_NUMBERS,
    seed: int = 11,
) -> DataFrame:
    """Per row: ``id``, ``n_links``, ``component`` (the smallest id reachable) and ``kept``.

    Splits are chosen from a sample of at most ``sample`` vectors and ``sample_numbers`` components, which the driver holds;
    for trees deeper than these allow raise both.
    """
    work = Workspace(vectors.sparkSession)
    # Single precision travels as such; it is compared in double.
    kind = "float" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    clean = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce((F.size("vector") > 0) & clean & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", good).withColumn("key", F.when(good, F.sha2(F.array_join("vector", ",").cast("binary"), 256)))
    nodes = work.save(
        rows.where("good")
        .groupBy("key")
        .agg(F.min("id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
        .withColumn("width", F.size("vector"))
    )
    joinable = nodes.where("node is not null")
    widths = joinable.groupBy("width").count().orderBy("width").collect()
    found = [
        _links(joinable.where(F.col("width") == w["width"]), w["count"], w["width"], work, threshold, trees, leaf, (sample, sample_numbers), seed)
        for w in widths
    ]
    found = reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], LINKS)
    linked = components(found.where("b is not null").select("a", "b"), work)
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    by_key = (
        nodes.join(counts.withColumnRenamed("a", "node"), "node", "left")
        .join(linked, "node", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    out = rows.select("id", "key").join(by_key, "key", "left")
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
