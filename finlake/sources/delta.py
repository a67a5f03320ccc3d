"""The same table maintenance on Delta tables, where the Delta classes are installed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _tables():
    try:
        from delta.tables import DeltaTable
    except ImportError as missing:
        raise RuntimeError("fmt='delta' needs the Delta Lake package and its jar") from missing
    return DeltaTable


def table_exists(spark: SparkSession, path: str) -> bool:
    return _tables().isDeltaTable(spark, path)


def create(df: DataFrame, path: str, date_col: str) -> None:
    writer = df.write.format("delta").mode("overwrite").option("mergeSchema", True)
    writer.partitionBy(date_col).save(path)


def append(df: DataFrame, path: str) -> None:
    df.write.format("delta").mode("append").option("mergeSchema", True).save(path)


def replace_days(df: DataFrame, path: str, date_col: str, days: list[date]) -> None:
    """One commit that exchanges the given days for the rows of the frame."""
    listed = ", ".join(f"DATE'{d.isoformat()}'" for d in days)
    writer = df.write.format("delta").mode("overwrite").option("mergeSchema", True)
    writer.option("replaceWhere", f"{date_col} IN ({listed})").save(path)


def delete_day(spark: SparkSession, path: str, date_col: str, day: date) -> None:
    _tables().forPath(spark, path).delete(F.col(date_col) == F.lit(day))


def upsert(spark: SparkSession, path: str, batch: DataFrame, id_col: str) -> None:
    merge = _tables().forPath(spark, path).alias("kept")
    same = F.col(f"kept.{id_col}") == F.col(f"batch.{id_col}")
    merge = merge.merge(batch.alias("batch"), same)
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
