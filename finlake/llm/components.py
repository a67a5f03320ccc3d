"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import Workspace


#: A join on nodes of no more links than this is left to single tasks.
FEW = 1 << 17


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, work: Workspace, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; the component is its smallest node.

    Large-star and small-star steps in turn, until the links are stars around the smallest nodes. Each
    step takes the least neighbour of a node by an aggregation that is partial before the shuffle. Of more than
    ``FEW`` links it is written before it is joined, so that both sides of the join are plain tables and
    Spark splits a node with very many links; fewer links are no matter for one task.
    Nulls and links of a node with itself are left out.
    """

    def small(table: DataFrame, rows: int) -> DataFrame:
        return work.save(table) if rows > FEW else table

    low, high = F.least(a, b), F.greatest(a, b)
    linked = edges.where((F.col(a) != F.col(b))).select(high.alias("u"), low.alias("v")).distinct()
    now = work.save(linked)
    seen = _mark(now)
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = small(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), 2 * seen[0])
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work.save(large.distinct())
        least = small(large.groupBy("u").agg(F.min("v").alias("m")), 2 * seen[0])
        near = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = near.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = work.save(stars)
        work.drop(now, large)
        now, before, seen = after, seen, _mark(after)
        if seen == before:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
