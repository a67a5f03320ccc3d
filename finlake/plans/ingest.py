"""From raw daily files to cleaned tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.days import Day, parse_days
from finlake.operators.maintenance import (
    UpsertConflict,
    conform,
    create,
    replace_days,
    upsert,
    widen,
)
from finlake.sources.daily_csv import FILE_DAY, SourceSpec, read_day, read_days
from finlake.sources.lake import Lake, materialize, read_table, scratch, stored_days, table_exists, table_schema


def ingest(
    spark: SparkSession, lake: Lake, spec: SourceSpec, day: Day, changed: set[date | None] | None = None
) -> dict[str, int]:
    """Bring one source's file of one day into its table, creating the table if need be.

    ``changed`` gets the days whose rows changed, None among them for rows without a date.
    """
    path = lake.silver_path(spec.domain, spec.table)
    with scratch(spark, path) as folder:
        batch = read_day(spark, lake, spec, day, folder)
        if table_exists(spark, path, lake.fmt):
            return _maintain(spark, lake, spec, batch, day, changed)
        _create(spark, lake, spec, batch, changed)
    return {}


def _create(
    spark: SparkSession,
    lake: Lake,
    spec: SourceSpec,
    rows: DataFrame,
    changed: set[date | None] | None,
    order: tuple[str, ...] = (),
) -> None:
    path = lake.silver_path(spec.domain, spec.table)
    create(rows, path, spec.date_col, lake.fmt, order)
    if changed is not None and lake.fmt != "delta":
        changed |= set(stored_days(spark, path))


def _maintain(
    spark: SparkSession,
    lake: Lake,
    spec: SourceSpec,
    batch: DataFrame,
    days: Day | Iterable[Day],
    changed: set[date | None] | None,
) -> dict[str, int]:
    path = lake.silver_path(spec.domain, spec.table)
    if not spec.append_only:
        return upsert(spark, path, batch, spec.id_col, spec.date_col, lake.fmt, changed=changed)
    declared = spec.struct()
    if lake.fmt != "delta":
        # Only columns outside the declared ones need a look at what is stored.
        names = set() if declared is None else {n.lower() for n in declared.fieldNames()}
        if declared is None or any(c.lower() not in names for c in batch.columns):
            fixed, declared = declared, table_schema(spark, path, spec.date_col)
            if spec.widen:
                declared = widen(spark, path, spec.date_col, batch.schema, fixed)
        batch = conform(batch, declared, extra=True)
    return replace_days(batch, path, spec.date_col, days, lake.fmt, changed=changed)


def ingest_range(
    spark: SparkSession,
    lake: Lake,
    spec: SourceSpec,
    days: Iterable[Day],
    changed: set[date | None] | None = None,
) -> dict[str, int]:
    """:func:`ingest` for many days at once, with the outcome of running them in order."""
    days = parse_days(days)
    path = lake.silver_path(spec.domain, spec.table)
    exists = table_exists(spark, path, lake.fmt)
    with scratch(spark, path) as folder:
        frames = read_days(spark, lake, spec, days, folder)
        if spec.append_only:
            rows = _surviving_rows(_union(frames), spec, days)
            if exists:
                return _maintain(spark, lake, spec, rows, days, changed)
            _create(spark, lake, spec, rows, changed)
            return {}
        # An upsert keeps the columns of the stored table or, if there is none yet,
        # of the first file, and insists that every batch has them.
        first = read_table(spark, path, spec.date_col, lake.fmt) if exists else frames[0].drop(FILE_DAY)
        columns = first.schema.add(FILE_DAY, "date")
        rows = _union([conform(frame, columns, missing="error") for frame in frames])
        rows = _latest_versions(materialize(rows, f"{folder}/files"), spec.id_col, folder)
        if exists:
            return upsert(spark, path, rows, spec.id_col, spec.date_col, lake.fmt, changed=changed)
        _create(spark, lake, spec, rows, changed, order=(spec.id_col,))
    return {}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _surviving_rows(rows: DataFrame, spec: SourceSpec, days: list) -> DataFrame:
    """What is left of the files after each day in turn deleted its own date.

    A row dated on a processed day is deleted by that day's run if it came from
    an earlier file, and stays if it came from the same or a later one.
    """
    # Few rows are dated after their file, so the list of days is searched for these alone.
    deleted_later = (F.col(spec.date_col) > F.col(FILE_DAY)) & F.col(spec.date_col).isin(days)
    return rows.where(~F.coalesce(deleted_later, F.lit(False))).drop(FILE_DAY)


def _latest_versions(rows: DataFrame, id_col: str, folder: str) -> DataFrame:
    """One batch that has the effect of upserting the files one after the other.

    The first file that has an id says how many rows there will be, the last one
    what they hold. From its second file on, an id may occur only once per file.

    Most ids come in one file only. They take part in no more than an aggregate of days, which
    says what ids come again; only the rows of these travel whole. Rows without an id, which may
    be many, go through neither.
    """
    columns = [c for c in rows.columns if c != FILE_DAY]
    known = rows.where(F.col(id_col).isNotNull())
    span = known.groupBy(id_col).agg(F.min(FILE_DAY).alias("_first"), F.max(FILE_DAY).alias("_last"))
    several = materialize(span.where(F.col("_first") < F.col("_last")).drop("_last"), f"{folder}/several")
    if several.isEmpty():
        return rows.drop(FILE_DAY)
    per_file = (
        known.join(several, id_col)
        .where(F.col(FILE_DAY) > F.col("_first"))
        .groupBy(id_col, "_first", FILE_DAY)
        .agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*columns)).alias("_row"))
    )
    per_id = per_file.groupBy(id_col, "_first").agg(
        F.max("n").alias("_most"), F.max_by("_row", FILE_DAY).alias("_new")
    )
    again = materialize(per_id, f"{folder}/again")
    if not again.where(F.col("_most") > 1).isEmpty():
        raise UpsertConflict(f"several rows of one file share a stored {id_col}")
    merged = (
        known.join(again.select(id_col, "_first", "_new"), id_col, "left")
        .where(F.col("_first").isNull() | (F.col(FILE_DAY) == F.col("_first")))
        .select(
            *(
                F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c)
                for c in columns
            )
        )
    )
    return merged.unionByName(rows.where(F.col(id_col).isNull()).select(*columns))
