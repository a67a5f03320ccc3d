"""Keeping date-partitioned tables up to date: create, append, delete a day, replace days, upsert.

Tables are partitioned by their date. A day is then replaced by exchanging its
partition, a one-day read opens one partition, and an upsert rewrites only the
days that hold a row to be changed. Nothing here overwrites a path in a way that
Spark could still be reading from.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.days import (
    Day,
    on_days,
    parse_day,
    parse_days,
    presence,
)
from finlake.sources import delta
from finlake.sources.lake import (
    delete_folder,
    file_sizes,
    folder_bytes,
    keep_schema,
    kept_schema,
    mark_complete,
    materialize,
    partition_day,
    partition_name,
    path_exists,
    read_partitions,
    read_table,
    replace_folder,
    scratch,
    sibling,
    table_schema,
)


class UpsertConflict(ValueError):
    """Several rows of one batch claim the same stored row."""


def conform(
    df: DataFrame, schema: T.StructType, extra: bool = False, missing: str = "null"
) -> DataFrame:
    """The frame with a table's columns, by case-insensitive name and with its types.

    ``extra`` keeps columns the table does not have; ``missing`` is ``null`` to
    fill absent ones or ``error`` to refuse them. A value that its column's type
    cannot hold in full raises when it is met, naming the column.
    """
    own = {name.lower(): name for name in df.columns}
    absent = [f.name for f in schema if f.name.lower() not in own]
    if absent and missing == "error":
        raise ValueError(f"columns missing from the batch: {', '.join(absent)}")
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    columns = [
        _fitted(F.col(f"`{own[f.name.lower()]}`"), kinds[f.name.lower()], f).alias(f.name)
        if f.name.lower() in own
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    if extra:
        taken = {name.lower() for name in schema.fieldNames()}
        columns += [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*columns)


_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of one type has its equal in the other."""
    if source == target or isinstance(source, T.NullType) or isinstance(target, T.StringType):
        return True
    one, two = source.simpleString(), target.simpleString()
    if isinstance(target, T.DecimalType):
        places = (_WHOLE[one], 0) if one in _WHOLE else None
        if isinstance(source, T.DecimalType):
            places = (source.precision - source.scale, source.scale)
        return bool(places) and places[0] <= target.precision - target.scale and places[1] <= target.scale
    if one in _WHOLE and two in _WHOLE:
        return _WHOLE[one] <= _WHOLE[two]
    return (one, two) in {("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz")} or (
        two == "double" and one in ("tinyint", "smallint", "int")
    )


def _fitted(column: Column, source: T.DataType, field: T.StructField) -> Column:
    """The column in a table's type. A cast that may lose something is compared with its way back."""
    if _widens(source, field.dataType):
        return column.cast(field.dataType)
    if isinstance(source, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        return column.cast(field.dataType)
    cast = column.try_cast(field.dataType)
    # Text need only be readable as the type: 007 is a number, and 1e2 too.
    kept = cast.isNotNull() if isinstance(source, T.StringType) else cast.try_cast(source).eqNullSafe(column)
    wrong = F.concat(F.lit(f"column {field.name}: "), column.cast("string"), F.lit(f" does not fit {field.dataType.simpleString()}"))
    return F.when(column.isNull() | kept, cast).otherwise(F.raise_error(wrong).cast(field.dataType))


def _by_day(df: DataFrame, date_col: str) -> DataFrame:
    """Bring each day's rows together for few, well-sized files.

    Unlike a repartition by date, a rebalance splits a day that is larger than
    the advisory partition size over several tasks.
    """
    return df.hint("rebalance", date_col)


def _sorted_files(df: DataFrame, date_col: str, order: Sequence[str]) -> DataFrame:
    return df.sortWithinPartitions(date_col, *order) if order else df


def _save(df: DataFrame, path: str, date_col: str, mode: str, dynamic: bool = False) -> None:
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(date_col)
        .parquet(path)
    )


def _empty_partition(df: DataFrame, path: str, date_col: str, day: date | None) -> None:
    """Leave a day without rows; the written file still carries the columns."""
    columns = T.StructType([f for f in df.schema if f.name.lower() != date_col.lower()])
    empty = df.sparkSession.createDataFrame([], columns)
    empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{partition_name(date_col, day)}")


def clear_day(spark: SparkSession, path: str, date_col: str, day: date | None) -> None:
    """Empty a day's partition if there is one."""
    partition = f"{path}/{partition_name(date_col, day)}"
    if path_exists(spark, partition):
        _empty_partition(spark.read.parquet(partition), path, date_col, day)


def create(
    df: DataFrame, path: str, date_col: str, fmt: str = "parquet", order: Sequence[str] = ()
) -> None:
    """Write a new table, or overwrite one.

    With an ``order`` the rows of a day are brought together and sorted in their
    files. Raw files need no such shuffle, as each already belongs to one day.

    A stored table is replaced only when the new one is complete: that one is built
    in a folder beside it, which then takes its name. A job that fails or is killed
    half-way leaves the old table whole, and at worst an unread folder beside it.
    (Where a rename copies, as in object stores, this costs one copy.)
    """
    if fmt == "delta":
        return delta.create(df, path, date_col)
    spark = df.sparkSession
    exists = path_exists(spark, path)
    place = sibling(path, "building") if exists else path
    try:
        rows = Observation()
        out = _by_day(df, date_col) if order else df
        out = out.observe(rows, F.count(F.lit(1)).alias("rows"))
        _save(_sorted_files(out, date_col, order), place, date_col, "overwrite")
        if not rows.get["rows"]:
            _empty_partition(df, place, date_col, None)
        keep_schema(spark, place, date_col, df.schema)
        mark_complete(spark, place)
    except BaseException:
        if exists:
            delete_folder(spark, place)
        raise
    if exists:
        replace_folder(spark, place, path)


def _grow(spark: SparkSession, path: str, date_col: str, batch: T.StructType, whole: T.StructType | None = None) -> None:
    """Note the columns that a batch adds, before it is written: a noted column that no file has yet reads as NULL.

    ``whole``: the table's columns, where the caller has them; else a table without kept columns stays so.
    """
    kept = kept_schema(spark, path)
    base = whole or kept
    if base is None:
        return
    known = {f.name.lower() for f in base}
    new = [f for f in batch if f.name.lower() not in known]
    if new or kept is None:
        keep_schema(spark, path, date_col, [*base, *new])


#: A file's column of the first type reads as any of the others, so a table's column can be widened without a rewrite.
_READS_AS = {"int": ("bigint", "double", "decimal(38,0)"), "bigint": ("decimal(38,0)",), "float": ("double",)}


def widen(
    spark: SparkSession, path: str, date_col: str, batch: T.StructType, declared: T.StructType | None = None
) -> T.StructType:
    """A table's columns, of which those that a batch holds in a wider type, and that files can be read as, take that type.

    Columns in ``declared`` keep their type. The new types are noted beside the table, and no file is rewritten. A column that cannot
    be read in the wider type stays as it is, and a value that does not fit it raises when it is written.
    """
    schema = table_schema(spark, path, date_col)
    fixed = set() if declared is None else {n.lower() for n in declared.fieldNames()}
    comes = {f.name.lower(): f.dataType for f in batch if f.name.lower() not in fixed}

    def wider(field: T.StructField) -> T.StructField:
        new = comes.get(field.name.lower(), field.dataType)
        reads = new.simpleString() in _READS_AS.get(field.dataType.simpleString(), ())
        return T.StructField(field.name, new) if reads else field

    fields = [wider(field) for field in schema]
    if fields != list(schema.fields):
        keep_schema(spark, path, date_col, fields)
    return T.StructType(fields)


def append(
    df: DataFrame,
    path: str,
    date_col: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> None:
    """Add rows; columns the table lacks become part of it.

    Common columns take the table's types: those in ``schema`` or, without one,
    those kept beside the table. Only where these are missing or damaged are the footers of
    its files opened, and what they say is kept from then on.
    """
    if fmt == "delta":
        return delta.append(df, path)
    spark = df.sparkSession
    whole = table_schema(spark, path, date_col) if schema is None else None
    batch = conform(df, schema or whole, extra=True)
    _grow(spark, path, date_col, batch.schema, whole)
    _save(_by_day(batch, date_col), path, date_col, "append")


def delete_day(
    spark: SparkSession, path: str, date_col: str, day: Day, fmt: str = "parquet"
) -> None:
    """Remove the rows of one day; rows without a date stay."""
    if fmt == "delta":
        return delta.delete_day(spark, path, date_col, parse_day(day))
    clear_day(spark, path, date_col, parse_day(day))


def replace_days(
    df: DataFrame,
    path: str,
    date_col: str,
    days: Day | Iterable[Day],
    fmt: str = "parquet",
    order: Sequence[str] = (),
    changed: set[date | None] | None = None,
) -> dict[str, int]:
    """Delete the given days, then add every row of the frame.

    Rows dated on one of the days take its partition over in a single job. Rows
    of any other date, or of none, are appended in a second job that runs only
    if the first one met such rows. Days for which no row came end up empty.
    ``order`` is as in :func:`create`; ``changed`` gets every day whose rows changed. The second job computes the frame again, so
    a frame whose rows may change between two runs must be written by the caller first.
    """
    days = parse_days(days)
    spark = df.sparkSession
    if fmt != "delta":
        _grow(spark, path, date_col, df.schema)
    seen = Observation()
    dated = F.col(date_col).isin(days)
    watched = (_by_day(df, date_col) if order else df).observe(
        seen,
        F.count_if(dated).alias("replaced"),
        F.count_if(F.coalesce(~dated, F.lit(True))).alias("stray"),
        presence(F.col(date_col), days).alias("present"),
    )
    if fmt == "delta":
        delta.replace_days(watched.where(dated), path, date_col, days)
    else:
        fresh = _sorted_files(watched.where(dated), date_col, order)
        _save(fresh, path, date_col, "overwrite", dynamic=True)
        for day in sorted(set(days) - set(seen.get["present"])):
            clear_day(spark, path, date_col, day)
    counts = {name: seen.get[name] or 0 for name in ("replaced", "stray")}
    late = Observation()
    if counts["stray"]:
        strays = _watch_days(df.where(F.coalesce(~dated, F.lit(True))), date_col, late)
        if fmt == "delta":
            delta.append(strays, path)
        else:
            _save(_by_day(strays, date_col), path, date_col, "append")
    if changed is not None:
        changed |= set(days) | (_days_of(late) if counts["stray"] else set())
    return counts


#: The filter over a batch's ids: a power of two of 64-bit words, about one for so many ids, and no more than so many.
FILTER_IDS, FILTER_WORDS = 4, 1 << 20


def _words(n_ids: int) -> int:
    """How many words the filter over so many ids has; 16 bits for each id up to the bound."""
    return min(FILTER_WORDS, 1 << max(0, ceil(n_ids / FILTER_IDS) - 1).bit_length())


def _slot(id_col: str, words: int) -> Column:
    return F.xxhash64(id_col).bitwiseAND(F.lit(words - 1))


def _bits(id_col: str) -> Column:
    """Four bits of a word, from a part of the id's hash that does not choose the word."""
    parts = [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64(`{id_col}`), {at}) & 63 as int))") for at in (20, 26, 32, 38)]
    bits = parts[0]
    for part in parts[1:]:
        bits = bits.bitwiseOR(part)
    return bits


def id_filter(ids: DataFrame, id_col: str, n_ids: int) -> tuple[DataFrame, int]:
    """A Bloom filter as a table of (_slot, _word), at most ``FILTER_WORDS`` rows, and its number of slots."""
    words = _words(n_ids)
    table = ids.select(_slot(id_col, words).alias("_slot"), _bits(id_col).alias("_bits"))
    return table.groupBy("_slot").agg(F.bit_or("_bits").alias("_word")), words


def may_match(rows: DataFrame, id_col: str, bloom: DataFrame, words: int) -> DataFrame:
    """The rows whose id the filter may hold: all that do, and few others. The filter's size is bounded, so it is broadcast."""
    bits = _bits(id_col)
    same = (_slot(id_col, words) == F.col("_slot")) & (F.col("_word").bitwiseAND(bits) == bits)
    return rows.join(F.broadcast(bloom), same, "left_semi")


def _is_broadcast(spark: SparkSession, table: str) -> bool:
    """Whether Spark broadcasts a written table by its size, so that a join with it shuffles and splits nothing."""
    return folder_bytes(spark, table) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _search(ids: DataFrame, id_col: str, wanted: DataFrame, bounds: dict, folder: str) -> DataFrame:
    """Stored ids that the batch has, with what is wanted of them.

    The least and the largest id of the batch reach the scan, which skips files and row groups by
    them. Unless the batch is small enough for Spark to broadcast it anyway, a Bloom filter over its ids then leaves out,
    before the shuffle, the stored ids it does not have.
    """
    spark = ids.sparkSession
    if not bounds.get("n"):
        return ids.limit(0).join(wanted, id_col)
    near = ids.where(F.col(id_col).between(F.lit(bounds["low"]), F.lit(bounds["high"])))
    if not _is_broadcast(spark, f"{folder}/wanted"):
        bloom, words = id_filter(wanted, id_col, bounds["n"])
        near = may_match(near, id_col, materialize(bloom, f"{folder}/bloom"), words)
    return near.join(wanted, id_col)


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    id_col: str,
    date_col: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    changed: set[date | None] | None = None,
) -> dict[str, int]:
    """Update stored rows whose id is in the batch, insert the other rows of the batch.

    * Every stored row with a matching id is updated, also if an id is stored
      more than once; an update may move a row to another day.
    * Ids that are NULL never match, so such rows are always inserted.
    * Two batch rows for one stored id raise :class:`UpsertConflict`; repeated
      ids that match nothing are all inserted.
    * A stored column missing from the batch is an error; a new one is left out.
      Stored columns are those of ``schema`` or those kept beside the table (or,
      without either, of some stored file and whatever the files of rewritten days hold beyond it).

    The stored table is searched once, reading only ids that lie between the batch's
    least and largest one, and shuffling only those that a Bloom filter over
    the batch's ids lets pass; so the rows shuffled grow with the batch and not
    with the table. A batch that is not small enough to be broadcast is written before each join, search
    and rewrite, so Spark splits a stored id or a batch id that very many rows have. Days that hold a
    match are rewritten, and everything else is appended. Rows that leave a day
    are removed before they are added elsewhere, so running a broken upsert
    again completes it instead of duplicating rows.

    Returns counts, and adds to ``changed`` every day whose rows changed (at most one for each partition).
    """
    if fmt == "delta":
        delta.upsert(spark, path, batch, id_col)
        return {}
    whole = schema is None and kept_schema(spark, path) is not None
    stored_ids = read_table(spark, path, date_col, schema=schema)
    batch = conform(batch, stored_ids.schema, extra=True, missing="error")

    with scratch(spark, path) as folder:
        batch = materialize(batch, f"{folder}/batch")
        # One row per id of the batch: how often it occurs and the day it goes to.
        wanted = (
            batch.where(F.col(id_col).isNotNull())
            .groupBy(id_col)
            .agg(F.count(F.lit(1)).alias("_copies"), F.min(date_col).alias("_to"))
        )
        bounds = Observation()
        ends = F.min(id_col).alias("low"), F.max(id_col).alias("high")
        wanted = materialize(wanted.observe(bounds, F.count(F.lit(1)).alias("n"), *ends), f"{folder}/wanted")
        # One row per matched id and day. A written copy, because the search
        # must not be repeated on a table that has begun to change.
        found = _search(stored_ids.select(id_col, F.col(date_col).alias("_from")), id_col, wanted, bounds.get, folder)
        hits = materialize(found, f"{folder}/hits").distinct()
        leaves = ~F.col("_from").eqNullSafe(F.col("_to"))
        # At most one row per partition of the table.
        touched = (
            hits.groupBy("_from")
            .agg(
                F.max("_copies").alias("copies"),
                F.count_if(leaves).alias("leaving"),
                F.count(F.lit(1)).alias("ids"),
            )
            .collect()
        )
        if any(row.copies > 1 for row in touched):
            raise UpsertConflict(f"several batch rows share a stored {id_col}")

        # All columns of the days to be rewritten, which must stay whole.
        target = stored_ids
        if touched and not whole:
            target = read_partitions(spark, path, date_col, [row["_from"] for row in touched], stored_ids.schema)
        columns = target.columns
        batch = conform(batch, target.schema, missing="error")
        additions, matched_ids = batch, hits.select(id_col)
        losing = [row["_from"] for row in touched if row.leaving]
        emptied: set[date | None] = set()
        if touched:
            additions = batch.join(matched_ids, id_col, "left_anti").select(*columns)
            updates = batch.join(matched_ids, id_col, "left_semi").select(id_col, F.struct(*columns).alias("_new"))
            stays = F.col("_new").isNull() | F.col(f"_new.{date_col}").eqNullSafe(F.col(date_col))
            large = not _is_broadcast(spark, f"{folder}/batch")
            with ThreadPoolExecutor(2) as pool:
                if large:
                    written = pool.submit(materialize, updates, f"{folder}/updates")
                if losing:
                    stored = target.where(on_days(F.col(date_col), losing)).select(id_col, date_col)
                    gone = hits.where(leaves).select(F.col(id_col).alias("_id"), "_from")
                    same = (F.col(id_col) == F.col("_id")) & F.col(date_col).eqNullSafe(F.col("_from"))
                    held = stored.join(gone, same, "left_anti").select(date_col).distinct()
                    holding = pool.submit(held.collect)
                if large:
                    updates = written.result()
                if losing:
                    moved = stored.join(updates, id_col).where(~stays).select("_new.*")
                    additions = additions.unionByName(materialize(moved, f"{folder}/moved"))
                    emptied = set(losing) - {row[date_col] for row in holding.result()}

        for day in emptied:
            clear_day(spark, path, date_col, day)
        rewritten = [row["_from"] for row in touched if row["_from"] not in emptied]
        if rewritten:
            merged = (
                target.where(on_days(F.col(date_col), rewritten))
                .join(updates, id_col, "left")
                .where(stays)
                .select(
                    *(
                        F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c)
                        for c in columns
                    )
                )
            )
            _save(_by_day(merged, date_col), path, date_col, "overwrite", dynamic=True)
        added = Observation()
        _save(_watch_days(_by_day(additions, date_col), date_col, added), path, date_col, "append")
    if changed is not None:
        changed |= {row["_from"] for row in touched} | _days_of(added)
    return {
        "matched_ids": sum(row.ids for row in touched),
        "days_rewritten": len(rewritten),
        "days_emptied": len(emptied),
    }


def _watch_days(df: DataFrame, date_col: str, seen: Observation) -> DataFrame:
    """The frame, whose days (at most one for each partition written) are noted when it is written."""
    days = F.collect_set(date_col).alias("days"), F.count_if(F.col(date_col).isNull()).alias("undated")
    return df.observe(seen, *days)


def _days_of(seen: Observation) -> set[date | None]:
    return set(seen.get.get("days") or ()) | ({None} if seen.get.get("undated") else set())


def compact_days(
    spark: SparkSession,
    path: str,
    date_col: str,
    days: Iterable[Day | None] | None = None,
    order: Sequence[str] = (),
    target_bytes: int = 128 << 20,
) -> dict[str, int]:
    """Pack the files of days that hold more of them than their bytes need; contents stay as they are.

    ``days`` are those to look at (None among them for rows without a date), or all. A day of B bytes becomes
    at most ceil(B / target_bytes) files, each sorted by ``order`` anew. The rows of a day are dealt to its files by a
    hash of all columns, so a day or an id with very many rows is spread over tasks. Days that have no file too many are not read. The
    days are exchanged in one job, after all of it is written.
    """
    wanted = None if days is None else {None if day is None else parse_day(day) for day in days}
    bins = {}
    for folder, sizes in file_sizes(spark, path).items():
        day, most = partition_day(folder), max(1, ceil(sum(sizes) / target_bytes))
        if len(sizes) > most and (wanted is None or day in wanted):
            bins[day] = most
    if not bins:
        return {"days": 0, "files_before": 0, "files_after": 0}
    kept = kept_schema(spark, path)
    schema = kept or read_table(spark, path, date_col).schema
    rows = read_partitions(spark, path, date_col, sorted(bins, key=str), schema, whole=kept is not None)
    n_files = F.lit(bins.get(None, 1))
    for most in sorted(set(bins.values())):
        of_size = [day for day, n in bins.items() if n == most and day is not None]
        n_files = F.when(F.col(date_col).isin(of_size), most).otherwise(n_files)
    bin_no = F.pmod(F.xxhash64(*[c for c in rows.columns if c != date_col]), n_files)
    dealt = rows.withColumn("_bin", bin_no).repartition(sum(bins.values()), date_col, "_bin")
    before = sum(len(sizes) for folder, sizes in file_sizes(spark, path).items() if partition_day(folder) in bins)
    _save(dealt.drop("_bin").sortWithinPartitions(date_col, *order), path, date_col, "overwrite", dynamic=True)
    after = sum(len(sizes) for folder, sizes in file_sizes(spark, path).items() if partition_day(folder) in bins)
    return {"days": len(bins), "files_before": before, "files_after": after}
