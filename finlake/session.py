"""A local session for tests and timings. On a cluster the caller brings its own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", memory: str = "8g", conf: Mapping[str, str] | None = None
) -> SparkSession:
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("finlake")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", partitions)
        # Small test tables, too, are to be written by all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
