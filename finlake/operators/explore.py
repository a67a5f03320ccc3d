"""Interactive questions to a summary table.

Every function stays lazy: filters reach the partitions and the file footers of
the table, and only the rows of the answer ever leave the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.days import Day, parse_day
from finlake.functions.money import exact_sum
from finlake.operators.reports import Report, get_report
from finlake.sources.lake import Lake, read_table

ALL_PRODUCTS = "*"


def open_report(spark: SparkSession, lake: Lake, report: Report | str) -> DataFrame:
    """The summary table behind a report."""
    report = get_report(report)
    return read_table(spark, lake.gold_path(report.table), "CodigoData", lake.fmt)


def filter_report(
    summary: DataFrame,
    report: Report | str,
    branches: Sequence[str],
    first: Day | None,
    last: Day | None,
    product: object = ALL_PRODUCTS,
) -> DataFrame:
    """Rows of some branches between two days, both included, and of one product if given.

    No branches means no rows, and so does a day that is None; a malformed day raises.
    The product is ignored by reports without one.
    """
    selected = _selected(report, product, first, last)
    return summary.where(F.col("FilialId").isin(list(branches)) & selected)


def _selected(report: Report | str, product: object, first: Day | None, last: Day | None) -> Column:
    low, high = (F.lit(None if day is None else parse_day(day)).cast("date") for day in (first, last))
    selected = F.col("CodigoData").between(low, high)
    if get_report(report).has_product and product not in (None, ALL_PRODUCTS):
        selected &= F.col("ProdutoId") == F.lit(product)
    return selected


def selection_sizes(
    summary: DataFrame,
    report: Report | str,
    selections: Sequence[Sequence[str]],
    first: Day | None,
    last: Day | None,
    product: object = ALL_PRODUCTS,
) -> DataFrame:
    """How many rows :func:`filter_report` would give for each of several sets of branches, by one scan.

    (selection, n_rows): the number of the set, from 0, and its rows; 0 where a selection is empty.
    """
    every = sorted({branch for branches in selections for branch in branches})
    rows = filter_report(summary, report, every, first, last, product)
    sizes = [
        F.struct(F.lit(i).alias("selection"), F.count_if(F.col("FilialId").isin(list(branches))).alias("n_rows"))
        for i, branches in enumerate(selections)
    ]
    return rows.agg(F.array(*sizes).alias("sizes")).select(F.inline("sizes"))


def report_series(
    summary: DataFrame,
    report: Report | str,
    branches: Sequence[str],
    first: Day | None,
    last: Day | None,
    product: object = ALL_PRODUCTS,
) -> DataFrame:
    """The report's measure per day and branch, over the rows of :func:`filter_report`.

    A group whose values are all NULL counts as zero. Rows without a day or a
    branch cannot pass the filter.
    """
    measure = get_report(report).measure
    rows = filter_report(summary, report, branches, first, last, product)
    total = F.coalesce(exact_sum(rows, measure), F.lit(0))
    if summary.schema[measure].dataType.typeName() == "double":
        total = total.cast("double")
    return rows.groupBy("CodigoData", "FilialId").agg(total.alias(measure))


def option_values(summary: DataFrame, column: str) -> DataFrame:
    """The values one can choose from, in order."""
    return summary.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def default_branch(summary: DataFrame) -> DataFrame:
    """The branch selected at first: the smallest one; no row if there is none."""
    smallest = summary.agg(F.min("FilialId").alias("FilialId"))
    return smallest.where(F.col("FilialId").isNotNull())


def date_bounds(summary: DataFrame) -> DataFrame:
    """First and last day; both NULL for an empty table."""
    return summary.agg(
        F.min("CodigoData").alias("first_day"), F.max("CodigoData").alias("last_day")
    )


def in_report_order(summary: DataFrame, report: Report | str) -> DataFrame:
    return summary.orderBy(*get_report(report).keys)


def preview(summary: DataFrame, report: Report | str, rows: int = 5) -> DataFrame:
    """The first rows in report order (a top-k, not a full sort)."""
    return in_report_order(summary, report).limit(rows)
