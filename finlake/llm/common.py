"""What the operators share: tables in the shared folder, and words as hashes straight from Arrow's bytes."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors reach."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/_work_{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sends Python workers at most so many rows at once; Spark's default suits short rows, and texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends inside go with it; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_made: ContextVar[list[Workspace] | None] = ContextVar("made", default=None)


@contextlib.contextmanager
def workspaces() -> Iterator[list[Workspace]]:
    """Lists the workspaces that are made inside, for the caller to drop once their results are written."""
    made: list[Workspace] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


class Workspace:
    """Intermediate tables of one run, written once and read back, so that no lineage is run twice.

    They survive the loss of executors. ``drop`` removes tables that nothing reads any more, ``drop_all``
    the whole folder. A result that is not written yet may still read tables, so what is left goes when
    this process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.count = spark, shared_folder(spark), 0
        atexit.register(self._forget)
        listed = _made.get()
        if listed is not None:
            listed.append(self)

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.workspace_path = path
        return kept

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(table.workspace_path)

    def drop_all(self) -> None:
        if self.count:
            self._delete(self.root)
        self.count = 0
        atexit.unregister(self._forget)

    def _forget(self) -> None:
        """Best effort: the session may have ended before."""
        with contextlib.suppress(Exception):
            self.drop_all()


def held_out(doc_id: str, folds: int, fold: int):
    """True for the rows whose crc32 of the id as text falls in the fold; a null id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def byte_table(separators: bytes) -> np.ndarray:
    """A look-up table over bytes: whether each belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Lower case for A-Z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Blanks part words; and: all of ASCII but letters and digits parts words.
NOT_BLANK = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
ALPHANUMERIC = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))

_SYMBOL = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text begins (one more entry ends the last)."""
    texts = texts.cast(pa.large_binary())
    raw = texts.buffers()
    ends = np.frombuffer(raw[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may keep bytes in the buffer
        texts = pa.array(texts.to_pylist(), pa.large_binary()).fill_null(b"")
        return text_bytes(texts)
    return data[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """The words of a column of texts, lower-cased unless told not to: a 64-bit hash each, without a loop over words.

    ``hashes``: by word; ``starts``, ``ends``: its place in ``data``; ``bounds``: the words of text i
    are ``bounds[i]`` to ``bounds[i + 1]``. A null text has no words.
    """

    def __init__(self, texts: pa.Array, is_word: np.ndarray, fold: bool = True):
        data, offsets = text_bytes(texts)
        self.data = data = LOWER[data] if fold else data
        inside = np.concatenate(([False], is_word[data], [False]))
        first, last = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        first[cuts] |= inside[cuts + 1]  # no word runs from one text into the next
        last[cuts] |= inside[cuts]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        sizes = self.ends - self.starts
        out = np.zeros(len(sizes), np.uint64)
        if not len(sizes):
            return out
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))
            upto = np.concatenate(([0], np.cumsum(sizes)))
            begin = 0
            while begin < len(sizes):  # a range of words at a time, for the sake of memory
                end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + (1 << 19), "right")) - 1)
                some = sizes[begin:end]
                first = upto[begin:end] - upto[begin]
                place = np.arange(int(some.sum())) - np.repeat(first, some)
                symbols = _SYMBOL[self.data[np.repeat(self.starts[begin:end], some) + place]]
                out[begin:end] = np.add.reduceat(symbols * powers[place], first)
                begin = end
            return mixed(out + sizes.astype(np.uint64))

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive entries; the caller leaves out those that run over a bound."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total = mixed(total * MIX + hashes[i : i + n])
    return total


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in runs of about so many bytes of text, or of a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(sizes.astype(np.int64) + 1)))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + most, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            part = batch.slice(begin, end - begin)
            if held and any(held[0].column(key)[0] != part.column(key)[0] for key in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)
