"""The daily run and the back-fill of missed days."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.days import Day, parse_days
from finlake.operators.maintenance import compact_days, create, replace_days
from finlake.operators.reports import REPORTS, Report, get_report
from finlake.plans.ingest import ingest, ingest_range
from finlake.sources.daily_csv import SPECS, SourceSpec
from finlake.sources.lake import Lake, path_exists, read_table, table_exists


def open_source(spark: SparkSession, lake: Lake, spec: SourceSpec) -> DataFrame:
    """A cleaned table with its declared columns."""
    path = lake.silver_path(spec.domain, spec.table)
    return read_table(spark, path, spec.date_col, lake.fmt, spec.struct())


def open_days(spark: SparkSession, lake: Lake, spec: SourceSpec, days: list) -> DataFrame:
    """A cleaned table of which only some days are wanted.

    For a few days only their partitions are listed; for more, listing the whole
    table once is cheaper. The caller filters in either case.
    """
    path, schema = lake.silver_path(spec.domain, spec.table), spec.struct()
    if lake.fmt == "delta" or schema is None or len(days) > 32:
        return open_source(spark, lake, spec)
    paths = [p for p in (f"{path}/{spec.date_col}={day}" for day in days) if path_exists(spark, p)]
    if not paths:
        return open_source(spark, lake, spec)
    reader = spark.read.option("basePath", path).schema(schema)
    return reader.parquet(*paths).select(*schema.fieldNames())


def build_report(
    spark: SparkSession,
    lake: Lake,
    report: Report | str,
    days: Day | Iterable[Day] | None = None,
    specs: Mapping[str, SourceSpec] = SPECS,
) -> DataFrame:
    """A summary computed from the cleaned tables: of some days, or of all of them."""
    report = get_report(report)
    frames = []
    for name in report.sources:
        spec = specs[name]
        if days is None:
            frame = open_source(spark, lake, spec)
        else:
            wanted = parse_days(days)
            frame = open_days(spark, lake, spec, wanted).where(F.col(spec.date_col).isin(wanted))
        frames.append(frame)
    return report.build(*frames)


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    report: Report | str,
    days: Day | Iterable[Day],
    specs: Mapping[str, SourceSpec] = SPECS,
) -> dict[str, int]:
    """Recompute the given days of a summary table, or all of it if it is missing."""
    report = get_report(report)
    path = lake.gold_path(report.table)
    order = report.keys[1:]
    if table_exists(spark, path, lake.fmt, complete=True):
        summary = build_report(spark, lake, report, days, specs)
        return replace_days(summary, path, "CodigoData", days, lake.fmt, order)
    summary = build_report(spark, lake, report, None, specs)
    create(summary, path, "CodigoData", lake.fmt, order)
    return {}


def compact(
    spark: SparkSession, lake: Lake, spec: SourceSpec, days: Iterable[Day | None] | None = None
) -> dict[str, int]:
    """Pack the small files of some or all days of a source's table, as daily upserts leave them, sorted by id if it has one."""
    if lake.fmt == "delta":
        raise ValueError("Delta tables have a compaction of their own, OPTIMIZE")
    path = lake.silver_path(spec.domain, spec.table)
    order = (spec.id_col,) if spec.id_col else ()
    return compact_days(spark, path, spec.date_col, days, order)


def _side_by_side(step, things: Iterable) -> None:
    """Run jobs that share no table at the same time; the first error is raised once all are done."""
    things = list(things)
    with ThreadPoolExecutor(len(things)) as pool:
        running = [pool.submit(step, thing) for thing in things]
    for job in running:
        job.result()


def run_day(
    spark: SparkSession,
    lake: Lake,
    day: Day,
    specs: Mapping[str, SourceSpec] = SPECS,
    changed_days: bool = False,
) -> None:
    """Ingest every source for one day and refresh each report once its sources are in.

    ``changed_days`` also refreshes every other day whose rows an ingestion changed: the day that an
    order left or went to, or that a late row belongs to. By default these wait for a refresh of
    their own. Rows without a date have no day to be refreshed.
    """

    def step(report: Report) -> None:
        changed: set = set()  # a set of days; each ingestion adds its own at once
        _side_by_side(lambda name: ingest(spark, lake, specs[name], day, changed), report.sources)
        more = changed - {None} if changed_days else ()
        refresh_gold(spark, lake, report, [day, *more], specs)

    _side_by_side(step, REPORTS.values())


def backfill(
    spark: SparkSession,
    lake: Lake,
    days: Iterable[Day],
    specs: Mapping[str, SourceSpec] = SPECS,
    replay: bool = False,
) -> None:
    """Process missed days.

    Each source is read in one scan and each summary is computed once, after all
    days are in. The cleaned tables come out as if the days had run in order.
    So do the summaries, except that a late row which a daily run would have left
    out of an earlier day's total is counted. ``replay`` runs day by day instead.
    """
    days = parse_days(days)
    if replay:
        for day in days:
            run_day(spark, lake, day, specs)
        return

    def step(report: Report) -> None:
        _side_by_side(lambda name: ingest_range(spark, lake, specs[name], days), report.sources)
        refresh_gold(spark, lake, report, days, specs)

    _side_by_side(step, REPORTS.values())
