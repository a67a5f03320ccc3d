"""Raw input: one CSV per source system, table and day."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.days import Day, file_token, parse_days
from finlake.sources.lake import Lake, materialize, path_exists, read_head, read_heads

FILE_DAY = "_file_day"


@dataclass(frozen=True)
class SourceSpec:
    """One source: its files, its columns, and how its table is kept up to date.

    ``append_only`` sources replace the processed day; the others are upserted
    by ``id_col``. ``schema`` may be None to take types from the values. ``widen`` lets an undeclared
    stored column take a wider type that a file comes with, where it can without a rewrite; else
    a value that does not fit the stored type is an error.
    """

    system: str
    domain: str
    table: str
    prefix: str
    date_col: str
    schema: str | None
    id_col: str | None = None
    append_only: bool = False
    csv_mode: str = "FAILFAST"
    widen: bool = False

    def struct(self) -> T.StructType | None:
        return None if self.schema is None else T.StructType.fromDDL(self.schema)


# Folders, file prefixes and columns of the source systems.
SPECS = {
    "returns": SourceSpec(
        system="sistema_devolucao",
        domain="devolucao",
        table="devolucao",
        prefix="devolucao",
        date_col="data_devolucao",
        id_col="pedido_id",
        schema="pedido_id string, produto_id int, quantidade int, motivo string, "
        "data_devolucao date, filial_id string",
    ),
    "stock": SourceSpec(
        system="sistema_estoque",
        domain="estoque",
        table="estoque",
        prefix="estoque",
        date_col="data_referencia",
        append_only=True,
        schema="produto_id int, filial_id string, quantidade_disponivel int, data_referencia date",
    ),
    "sales": SourceSpec(
        system="sistema_vendas",
        domain="vendas",
        table="vendas",
        prefix="vendas",
        date_col="data_venda",
        append_only=True,
        schema="data_venda date, produto_id int, filial_id string, quantidade int, "
        "valor_unitario double",
    ),
    "freight": SourceSpec(
        system="sistema_frete",
        domain="frete",
        table="frete",
        prefix="frete",
        date_col="data_envio",
        id_col="pedido_id",
        schema="pedido_id string, valor_frete double, data_envio date, transportadora string, "
        "filial_id string",
    ),
    "taxes": SourceSpec(
        system="sistema_tributos",
        domain="tributos",
        table="tributos",
        prefix="tributos",
        date_col="data_pagamento",
        append_only=True,
        schema="data_pagamento date, tipo_imposto string, valor_pago double, filial_id string",
    ),
}


def day_path(lake: Lake, spec: SourceSpec, day: Day) -> str:
    return f"{lake.bronze}/{spec.system}/{spec.table}/{spec.prefix}_{file_token(day)}.csv"


_TOKEN = r".*_(\d{4}_\d{2}_\d{2})\.csv"


def _file_day() -> Column:
    """The day of the file that a row comes from, be that a file or a folder of part files.

    It is cut out at its place before the first ``.csv`` of the last two names of the path; a pattern
    over the whole path, which costs more than that, is kept for paths where no day stands there.
    """
    path = F.col("_metadata.file_path")
    names = F.substring_index(path, "/", -2)
    token = F.right(F.substring_index(names, ".csv", 1), F.lit(len("yyyy_MM_dd")))
    anywhere = F.to_date(F.regexp_extract(path, _TOKEN, 1), "yyyy_MM_dd")
    return F.coalesce(F.try_to_date(token, "yyyy_MM_dd"), anywhere)


#: So few files are looked at by the driver itself, a few at a time, which is quicker than a job.
FEW, AT_ONCE = 256, 8


def _parsed(path: str, line: str | None) -> tuple[str, ...]:
    """Column names of one file.

    A day without rows still has a header. An empty file is a broken delivery, and
    taking it for an empty day would delete the day that is stored.
    """
    if line is None or not line.strip("\ufeff "):
        raise ValueError(f"{path} is empty, it does not even have a header")
    return tuple(next(csv.reader([line.removeprefix("\ufeff")])))


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file (or folder of part files); raises if it is missing or has no byte."""
    if not path_exists(spark, path):
        spark.read.csv(path)  # raises Spark's own error
    return _parsed(path, read_head(spark, path))


def _headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, ...]]:
    """:func:`_header` of each file; of more than ``FEW`` by one job, however many there are."""
    if len(paths) <= FEW:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(lambda path: _header(spark, path), paths))
    # A day that is a folder of part files has the header of the first one that has a byte.
    heads = read_heads(spark, paths).withColumn("day", F.regexp_extract("file", _TOKEN, 1))
    lines = dict(heads.groupBy("day").agg(F.min_by("line", "file")).collect())
    return [_parsed(path, lines.get(re.match(_TOKEN, path)[1])) for path in paths]


def _scan(spark: SparkSession, spec: SourceSpec, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """Files that share a header.

    Known columns take the names and types of the spec, whatever their order and
    case in the file; columns the spec does not know are text until :func:`typed`.
    """
    declared = spec.struct()
    known = {} if declared is None else {f.name.lower(): f for f in declared}
    fields = [known.get(name.lower()) or T.StructField(name, T.StringType()) for name in header]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(header, fields)])
    files = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", spec.csv_mode)
        .csv(paths)
    )
    columns = [F.col(f"`{n}`").alias(f.name) for n, f in zip(header, fields)]
    return files.select(*columns, _file_day().alias(FILE_DAY))


# What text must look like to be of a type, narrowest type first; it must also be in the type's range.
_WHOLE, _REAL = r"^[+-]?\d+$", r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|-?Inf)$"
LATTICE = [
    ("int", _WHOLE),
    ("bigint", _WHOLE),
    ("decimal(38,0)", _WHOLE),
    ("double", _REAL),
    ("date", r"^\d{4}-\d{2}-\d{2}$"),
    ("timestamp", r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"),
    ("boolean", r"^(?i)(true|false)$"),
]


def narrowest_types(frames: list[DataFrame], names: list[str]) -> dict[str, T.DataType | None]:
    """For each text column, by lower-case name, the narrowest type that holds all its values in all frames.

    One aggregation per frame, over rows of all its files; None where there is no value. Whole numbers
    on some days and others on the next are doubles; kinds with nothing in common stay text.
    """
    sums: dict[str, list[int]] = {name: [0] * (len(LATTICE) + 1) for name in names}
    for frame in frames:
        own = [c for c in frame.columns if c.lower() in sums]
        counts = []
        for name in own:
            text = F.col(f"`{name}`")
            fits = [F.count_if(text.rlike(look) & text.try_cast(kind).isNotNull()) for kind, look in LATTICE]
            counts.append(F.array(F.count(text), *fits).alias(name))
        for name, seen in zip(own, frame.agg(*counts).first() if own else ()):
            sums[name.lower()] = [a + b for a, b in zip(sums[name.lower()], seen)]
    return {name: _narrowest(seen) for name, seen in sums.items()}


def _narrowest(seen: list[int]) -> T.DataType | None:
    values, *fits = seen
    if not values:
        return None
    kind = next((kind for (kind, _), n in zip(LATTICE, fits) if n == values), "string")
    return T.StructType.fromDDL(f"x {kind}")[0].dataType


def typed(frames: list[DataFrame], spec: SourceSpec, folder: str | None = None) -> list[DataFrame]:
    """Frames of :func:`read_days` with their undeclared columns in one type each.

    With a ``folder`` for intermediate tables the raw files are read once: rows are written there as
    they come, and both the types and the values are taken from that copy. Without one
    the raw files are read for the types, and again for the values.
    """
    declared = spec.struct()
    known = set() if declared is None else {n.lower() for n in declared.fieldNames()}
    unknown = sorted({c.lower() for f in frames for c in f.columns} - known - {FILE_DAY})
    if not unknown:
        return frames
    if folder is not None:
        frames = [materialize(frame, f"{folder}/raw{i}") for i, frame in enumerate(frames)]
    kinds = narrowest_types(frames, unknown)
    # Columns without a value: the date is known to be one, the others stay text.
    kinds = {n: kind or (T.DateType() if n == spec.date_col.lower() else T.StringType()) for n, kind in kinds.items()}

    def cast(frame: DataFrame) -> DataFrame:
        casts = {c: F.col(f"`{c}`").cast(kinds[c.lower()]).alias(c) for c in frame.columns if c.lower() in kinds}
        return frame.select(*(casts.get(c, F.col(f"`{c}`")) for c in frame.columns))

    return [cast(frame) for frame in frames]


def read_days(
    spark: SparkSession, lake: Lake, spec: SourceSpec, days: Day | Iterable[Day], folder: str | None = None
) -> list[DataFrame]:
    """The files of some days, each row tagged with the day of its file.

    One frame per distinct header, so a column that appears half-way through
    the range keeps its place; usually that is a single scan. ``folder`` is as in :func:`typed`.
    """
    paths = [day_path(lake, spec, day) for day in parse_days(days)]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, _headers(spark, paths)):
        groups.setdefault(header, []).append(path)
    return typed([_scan(spark, spec, same, header) for header, same in groups.items()], spec, folder)


def read_day(spark: SparkSession, lake: Lake, spec: SourceSpec, day: Day, folder: str | None = None) -> DataFrame:
    """The file of one day. A missing file raises; a header-only file is an empty batch."""
    (frame,) = read_days(spark, lake, spec, day, folder)
    return frame.drop(FILE_DAY)
