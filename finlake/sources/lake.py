"""Where the tables live, and how they are found and opened."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.days import NULL_PARTITION


@dataclass(frozen=True)
class Lake:
    """The three layers of a lake on storage that every executor reaches."""

    bronze: str
    silver: str
    gold: str
    fmt: str = "parquet"

    @classmethod
    def at(cls, root: str, fmt: str = "parquet") -> Lake:
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", fmt)

    def silver_path(self, domain: str, table: str) -> str:
        return f"{self.silver}/{domain}/{table}"

    def gold_path(self, table: str) -> str:
        return f"{self.gold}/{table}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def table_exists(
    spark: SparkSession, path: str, fmt: str = "parquet", complete: bool = False
) -> bool:
    """Whether a table is stored at the path.

    ``complete`` also asks for the marker that Spark leaves after a finished
    write, so a first build that died half-way does not count.
    """
    if fmt == "delta":
        from finlake.sources import delta

        return delta.table_exists(spark, path)
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return False
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    has_data = any(not name.startswith(("_", ".")) for name in names)
    return has_data and (not complete or "_SUCCESS" in names)


def read_table(
    spark: SparkSession,
    path: str,
    date_col: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    evolved: bool = False,
) -> DataFrame:
    """A whole stored table, lazily.

    With a ``schema``, or with one kept beside the table, no file footer is opened
    for planning. Without either a single footer gives the columns, or, if the
    table has ``evolved``, all of them do (in a distributed job).
    """
    if fmt == "delta":
        table = spark.read.format("delta").load(path)
        return table if schema is None else table.select(*schema.fieldNames())
    schema = schema or kept_schema(spark, path)
    reader = spark.read.option("mergeSchema", evolved)
    if schema is not None:
        return reader.schema(schema).parquet(path).select(*schema.fieldNames())
    table = reader.parquet(path)
    # The type of a partition column whose every value is NULL cannot be inferred.
    columns = [F.col(c).cast("date").alias(c) if c == date_col else F.col(c) for c in table.columns]
    return table.select(*columns)


SCHEMA_FILE = "_finlake_schema.json"


def kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns kept beside a table, its date last; None if there is no such file or it is damaged."""
    file = f"{path}/{SCHEMA_FILE}"
    if not path_exists(spark, file):
        return None
    try:
        held = json.loads(read_head(spark, file) or "")
        text = json.dumps(held["schema"], sort_keys=True)
        return T.StructType.fromJson(held["schema"]) if held["check"] == zlib.crc32(text.encode()) else None
    except (ValueError, KeyError, TypeError, Py4JJavaError):
        return None


def keep_schema(spark: SparkSession, path: str, date_col: str, columns: Iterable[T.StructField]) -> None:
    """Write a table's columns beside it. A write that breaks off leaves a damaged file, which counts as none."""
    fields = [T.StructField(f.name, f.dataType) for f in columns]
    fields.sort(key=lambda f: f.name.lower() == date_col.lower())
    schema = T.StructType(fields).jsonValue()
    check = zlib.crc32(json.dumps(schema, sort_keys=True).encode())
    fs, target = _file_system(spark, f"{path}/{SCHEMA_FILE}")
    out = fs.create(target, True)
    try:
        out.write(bytearray(json.dumps({"check": check, "schema": schema}).encode()))
    finally:
        out.close()


def table_schema(spark: SparkSession, path: str, date_col: str) -> T.StructType:
    """All columns of a table: those kept beside it or, for want of that, those in the footers of all its files."""
    return kept_schema(spark, path) or read_table(spark, path, date_col, evolved=True).schema


def sibling(path: str, purpose: str) -> str:
    """A new folder beside another one, with a name that readers of the parent skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{purpose}_{name}_{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another one, by renaming; the old one is deleted last."""
    fs, target = _file_system(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, sibling(path, "replaced")))
    if not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"cannot move a new table to {path}")
    fs.delete(old, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def file_sizes(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Bytes of the data files in each partition folder of a table, by the folder's name. One listing, no file is opened."""
    fs, target = _file_system(spark, path)
    found: dict[str, list[int]] = {}
    entries = fs.listFiles(target, True)
    while entries.hasNext():
        entry = entries.next()
        name, folder = entry.getPath().getName(), entry.getPath().getParent().getName()
        if not name.startswith(("_", ".")) and "=" in folder:
            found.setdefault(folder, []).append(entry.getLen())
    return found


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def mark_complete(spark: SparkSession, path: str) -> None:
    """Leave the marker of a finished write, also where Spark is set not to."""
    fs, target = _file_system(spark, path)
    marker = spark._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")
    if not fs.exists(marker):
        fs.create(marker).close()


def read_partitions(
    spark: SparkSession,
    path: str,
    date_col: str,
    days: Iterable[date | None],
    schema: T.StructType,
    whole: bool = False,
) -> DataFrame:
    """Some days of a table with all columns that their files hold; no other file is opened.

    The columns of ``schema`` come first, with its types. If these are known to be
    the ``whole`` of the table's columns, no footer is opened either.
    """
    paths = [f"{path}/{partition_name(date_col, day)}" for day in days]
    if not whole:
        found = spark.read.option("mergeSchema", True).parquet(*paths).schema
        known = {f.name.lower() for f in schema}
        schema = T.StructType([*schema.fields, *(f for f in found if f.name.lower() not in known)])
    return spark.read.option("basePath", path).schema(schema).parquet(*paths).select(*schema.fieldNames())


def partition_name(date_col: str, day: date | None) -> str:
    return f"{date_col}={NULL_PARTITION if day is None else day.isoformat()}"


def partition_day(folder: str) -> date | None:
    """The day of a partition folder's name."""
    value = folder.split("=", 1)[1]
    return None if value == NULL_PARTITION else date.fromisoformat(value)


def stored_days(spark: SparkSession, path: str) -> list[date | None]:
    """The days that a table has a folder for, None for rows without a date first."""
    fs, target = _file_system(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    days = [partition_day(name) for name in names if "=" in name and not name.startswith(("_", "."))]
    return sorted(days, key=lambda day: (day is not None, day))


def read_head(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, or of the first file of a folder that has any; None if all are empty.

    Read by the driver through the file system, without a Spark job. A missing file raises.
    """
    fs, target = _file_system(spark, path)
    entry = fs.getFileStatus(target)
    entries = [entry]
    if entry.isDirectory():
        parts = sorted(fs.listStatus(target), key=lambda e: e.getPath().getName())
        entries = [part for part in parts if not part.getPath().getName().startswith(("_", "."))]
    for part in entries:
        if part.getLen():
            text = spark._jvm.java.io.InputStreamReader(fs.open(part.getPath()), "UTF-8")
            lines = spark._jvm.java.io.BufferedReader(text)
            try:
                return lines.readLine()
            finally:
                lines.close()
    return None


def read_heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, line): the first line of every text file under the paths that has any, by one job.

    Each file is a partition of its own, of which no more than the first line is taken, so of a large
    file only the beginning is read. A missing path raises Spark's own error.
    """
    apart = spark.newSession()  # its settings are not those of the caller's session
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = apart.read.text(paths).select("_metadata.file_path", "_metadata.file_block_start", "value")
    firsts = lines.rdd.mapPartitions(lambda rows: islice(rows, 1))
    heads = spark.createDataFrame(firsts, "file string, at long, line string")
    return heads.where("at = 0").select("file", "line")


@contextmanager
def scratch(spark: SparkSession, near: str) -> Iterator[str]:
    """A folder for intermediate tables, removed at the end.

    It lies in the cluster's shared checkpoint folder or, where none is
    configured, beside the table that is being written.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        near.rstrip("/").rsplit("/", 1)[0]
    )
    folder = f"{base}/_finlake_{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        fs, target = _file_system(spark, folder)
        fs.delete(target, True)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and continue from the written copy."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
