"""Benchmark decontamination by winnowing.

Texts are words of letters and digits, A-Z lower-cased. Of every window of ``n`` words, both sides keep
the smallest hash among its grams of ``k`` words (the last of equal ones), so two texts that share ``n``
words in a row always keep a common gram inside them. Kept grams of documents and benchmark items are
joined, and each hit is extended word by word to both sides; a run of ``n`` equal words or more counts.
An item of fewer than ``n`` words is one window by itself: its first ``k`` words or fewer are looked up
among all grams of a document, and it must match in full.

Only grams that may occur in the benchmark leave the scan: they pass a bitmap of a fixed size
(``2 ** BITS`` bits), made from the benchmark's grams in a distributed aggregation. The join behind it
is exact, and Spark splits a gram that very many documents hold.

Null and empty texts have no words; such documents are clean and such items match nothing. Rows are
told apart by position, so equal or null document ids each keep a result of their own. Items without an
id mark words but are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.common import ALPHANUMERIC, Words, Workspace, grams, mixed, slices

BITS = 23
GRAM_SCHEMA = "row long, n_words long, pos int, gram long, size int, before array<long>, after array<long>"


def winnowed(hashes: np.ndarray, bounds: np.ndarray, n: int, k: int) -> np.ndarray:
    """The positions of kept grams; ``bounds`` parts the words of different texts."""
    spans = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    windows = len(hashes) - n + 1
    if windows <= 0:
        return np.zeros(0, np.int64)
    gram = grams(hashes, k)
    width = n - k + 1
    least = gram[:windows].copy()
    for s in range(1, width):
        np.minimum(least, gram[s : s + windows], out=least)
    kept = np.zeros(len(gram), bool)
    place = np.zeros(windows, np.int64)
    for s in range(width):
        np.copyto(place, np.arange(s, s + windows), where=gram[s : s + windows] == least)
    kept[place[spans[:windows] == spans[n - 1 :]]] = True
    return np.flatnonzero(kept)


def marked(gram: np.ndarray, kind: int) -> np.ndarray:
    """The hash that is joined. Kind 0: winnowed grams; kind g: first words of short items."""
    return mixed(gram ^ np.uint64(kind)).view(np.int64)


def _around(words: np.ndarray, begin: int, end: int, pos: int, size: int, reach: int) -> tuple:
    """Hashes of the words before a gram, nearest first, and after it."""
    left = words[max(begin, pos - reach) : pos][::-1]
    return left, words[pos + size : min(end, pos + size + reach)]


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)


_ARROW = pa.schema(
    [("row", pa.int64()), ("n_words", pa.int64()), ("pos", pa.int32()), ("gram", pa.int64()), ("size", pa.int32())]
    + [(side, pa.list_(pa.int64())) for side in ("before", "after")]
)


def item_grams(items: DataFrame, text: str, n: int, k: int) -> DataFrame:
    """The grams of items by which they are found: ``row`` tells items apart, ``size`` 0 marks a long item's."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = Words(batch.column(text), ALPHANUMERIC)
            hashed, bounds = words.hashes.view(np.int64), words.bounds
            gram, kept = grams(words.hashes, k), winnowed(words.hashes, bounds, n, k)
            owner = np.searchsorted(bounds, kept, "right") - 1
            keys = marked(gram[kept], 0) if len(kept) else []
            rows = batch.column("row").to_pylist()
            found = [
                (rows[i], None, pos, key, 0, *_around(hashed, bounds[i], bounds[i + 1], pos, k, n - k))
                for i, pos, key in zip(owner, kept, keys)
            ]
            for i in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < n)):
                begin, size = bounds[i], int(bounds[i + 1] - bounds[i])
                g = min(size, k)
                key = marked(grams(words.hashes[begin : begin + g], g), g)[0]
                found.append((rows[i], size, begin, key, g, *_around(hashed, begin, bounds[i + 1], begin, g, n)))
            yield _rows(found, _ARROW)

    return items.select("row", text).mapInArrow(scan, GRAM_SCHEMA)


def bitmap(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """A bitmap of 2 ** bits over hashes, gathered as words of 64 bits: its size is fixed."""
    at = F.col(key).bitwiseAND((1 << bits) - 1)
    parts = (
        keys.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast({key} & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[parts["word"].to_numpy()] = parts["bits"].to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def document_grams(docs: DataFrame, n: int, k: int, known: np.ndarray, short: list[int]) -> DataFrame:
    """For each row (row, id, text) one with its number of words, and one for each gram that may be an item's."""
    kind_of_id = docs.schema["id"].dataType
    packed = np.packbits(known, bitorder="little")
    mask = np.uint64(len(known) - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(packed, bitorder="little").view(bool)
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), ALPHANUMERIC)
            hashed, bounds = words.hashes.view(np.int64), words.bounds
            rows = batch.column("row").to_pylist()
            base = [(row, count, None, None, None, None, None) for row, count in zip(rows, np.diff(bounds))]
            yield _rows(base, _ARROW).append_column("id", batch.column("id"))
            spans, found = np.repeat(np.arange(len(rows)), np.diff(bounds)), []
            for kind in [0, *short]:
                size = kind or k
                gram = grams(words.hashes, size)
                at = np.arange(len(gram)) if kind else winnowed(words.hashes, bounds, n, k)
                at = at[spans[at] == spans[at + size - 1]]
                keys = marked(gram[at], kind)
                hit = bits[(keys.view(np.uint64) & mask).astype(np.int64)]
                for pos, key in zip(at[hit], keys[hit]):
                    i = spans[pos]
                    near = _around(hashed, bounds[i], bounds[i + 1], pos, size, n - k if kind == 0 else n)
                    found.append((rows[i], None, pos - bounds[i], key, kind, *near))
            yield _rows(found, _ARROW).append_column("id", pa.nulls(len(found), batch.column("id").type))

    schema = T._parse_datatype_string(GRAM_SCHEMA).add("id", kind_of_id)
    return docs.select("row", "id", "text").mapInArrow(scan, schema)


def _equal_run(left: Column, right: Column) -> Column:
    """How many entries of two arrays are equal from the front."""
    differ = F.array_position(F.zip_with(left, right, lambda x, y: ~x.eqNullSafe(y)), True)
    shorter = F.least(F.size(left), F.size(right))
    return F.when(differ == 0, shorter).otherwise(F.least(differ - 1, shorter))


def hits(docs: DataFrame, items: DataFrame, n: int, k: int) -> DataFrame:
    """Matched runs: document ``row``, words ``begin`` to ``end`` (exclusive) and ``item``."""
    d, i = docs.alias("d"), items.select(F.col("row").alias("item"), "n_words", "gram", "size", "before", "after").alias("i")
    joined = d.join(i, (F.col("d.gram") == F.col("i.gram")) & (F.col("d.size") == F.col("i.size")))
    short = F.col("d.size") > 0
    left = F.when(short, 0).otherwise(_equal_run(F.col("d.before"), F.col("i.before")))
    right = _equal_run(F.col("d.after"), F.col("i.after"))
    runs = joined.select(
        "d.row", "item", "d.pos", left.alias("left"), right.alias("right"), F.col("d.size").alias("size"), "i.n_words"
    )
    size = F.when(F.col("size") > 0, F.col("size")).otherwise(k)
    enough = F.coalesce(F.col("n_words"), F.lit(n))
    return runs.where(F.col("left") + size + F.col("right") >= enough).select(
        "row",
        "item",
        (F.col("pos") - F.col("left")).cast("long").alias("begin"),
        F.when(F.col("size") > 0, F.col("pos") + F.col("n_words"))
        .otherwise(F.col("pos") + k + F.col("right"))
        .cast("long")
        .alias("end"),
    )


def _covered(spans: Column) -> Column:
    """How many words a set of spans covers."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("upto"))

    def add(state: Column, span: Column) -> Column:
        upto = F.greatest(state["upto"], span["end"])
        new = F.greatest(span["end"] - F.greatest(state["upto"], span["begin"]), F.lit(0))
        return F.struct((state["words"] + new).alias("words"), upto.alias("upto"))

    return F.aggregate(F.array_sort(spans), start, add)["words"]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    k: int = 5,
) -> DataFrame:
    """Per document row: its id, ``n_words``, ``n_hit`` and ``item_ids`` (sorted strings) of the items it holds."""
    if not 0 < k <= n:
        raise ValueError("a gram has at least one word and at most as many as a window")
    work = Workspace(docs.sparkSession)
    items = work.save(
        items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).cast("string").alias("key"), F.col(item_text).alias("text"))
    )
    sought = work.save(item_grams(items, "text", n, k))
    short = sorted(r[0] for r in sought.where("size > 0").select("size").distinct().collect())  # k at most
    known = bitmap(sought, "gram")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    scanned = work.save(document_grams(numbered, n, k, known, short))
    found = hits(scanned.where("pos is not null"), sought, n, k).join(
        items.select(F.col("row").alias("item"), "key"), "item", "left"
    )
    base = scanned.where("pos is null")
    nothing = F.lit(None)
    both = base.select("row", "id", "n_words", nothing.cast("struct<begin:long,end:long>").alias("span"), nothing.cast("string").alias("key")).unionByName(
        found.select("row", nothing.cast(scanned.schema["id"].dataType).alias("id"), nothing.cast("long").alias("n_words"), F.struct("begin", "end").alias("span"), "key")
    )
    return (
        both.groupBy("row")
        .agg(
            F.max("id").alias(doc_id),
            F.max("n_words").alias("n_words"),
            F.collect_set("span").alias("spans"),
            F.array_sort(F.collect_set("key")).alias("item_ids"),
        )
        .select(doc_id, "n_words", _covered(F.col("spans")).alias("n_hit"), "item_ids")
    )
