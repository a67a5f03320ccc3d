"""Line dedup: lines that many documents share, found by sorted hashes; the answer is a bitmap per document.

Each line's key (blanks at both ends cut, A-Z in lower case) becomes a hash of 128 bits; no text is moved
with it. The hashes are partitioned by range and sorted by document and position behind them, so a
window streams over each key and sees where it first occurs in a document. A key that very many documents share is cut
into blocks: the block of a row is the task that numbered it, so blocks grow in number with the data,
follow the order of the documents, and are part of the range. The occurrences are then counted in two steps,
the first of them where the sorted rows lie. The few keys that qualify are written before they are joined to the lines, so that Spark can
split the partitions of a frequent key.

The result per document is a bitmap of the lines to keep, compressed to runs of kept lines (``first``,
``n``). :func:`kept_text` applies it. Everything is DataFrame functions: no Python runs on rows.

A null or empty text is one empty line. A key shorter than ``least`` code points is never dropped. Documents
are told apart by their row, so null and repeated ids and repeated rows count as documents of their own.
An empty table gives an empty one. Other columns than id and text are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import Workspace
from finlake.llm.middle import quoted

BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: str | Column) -> Column:
    """A line as it is compared: blanks at both ends cut, A-Z in lower case, all else as it is."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    # For ASCII text the general lower case is the same, and much faster.
    return F.when(F.length(trimmed) == F.octet_length(trimmed), F.lower(trimmed)).otherwise(
        F.translate(trimmed, _UPPER, _LOWER)
    )


def _split(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def numbered_rows(docs: DataFrame, work: Workspace, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, doc_id, text), written, so that a row's number is the same in all that reads it."""
    number = F.monotonically_increasing_id().alias("row")
    return work.save(docs.select(number, quoted(doc_id).alias("doc_id"), quoted(text).alias("text")))


def occurrences(lines: DataFrame) -> DataFrame:
    """(h1, h2, documents, first): in how many rows each key occurs and where first, by a stream over the sorted hashes."""
    block = F.shiftright("row", 33).alias("block")  # the task that numbered the row
    ranged = lines.select("h1", "h2", block, "row", "pos").repartitionByRange("h1", "h2", "block")
    stream = Window.partitionBy("h1", "h2", "block").orderBy("row", "pos")
    before = F.lag("row").over(stream)
    seen = ranged.select("h1", "h2", "row", "pos", (before.isNull() | (before != F.col("row"))).alias("opens"))
    counts = F.count_if("opens").alias("documents"), F.min(F.struct("row", "pos")).alias("first")
    return seen.groupBy("h1", "h2").agg(*counts)


def keep_bitmaps(
    rows: DataFrame, work: Workspace, documents: int = 10, least: int = 1, keep_first: bool = False
) -> DataFrame:
    """(row, n_dropped, keep) for each numbered row that loses a line; all others keep theirs.

    ``keep``: the runs of lines to keep, in order, as structs of the first line's number and how many they
    are. Lines whose key at least ``documents`` rows hold are dropped; ``keep_first`` spares the first one
    of each such key, in the order of rows and lines.
    """
    split = rows.select("row", _split("text").alias("lines"))
    split = split.select("row", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = split.select("row", "n_lines", "pos", line_key("line").alias("key")).where(F.length("key") >= least)
    hashes = F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    lines = work.save(keyed.select("row", "n_lines", "pos", *hashes))

    often = work.save(occurrences(lines).where(F.col("documents") >= documents))

    found = lines.join(often, ["h1", "h2"])
    if keep_first:
        found = found.where(F.struct("row", "pos") != F.col("first"))
    dropped = found.groupBy("row").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_list("pos")).alias("gone"))
    return dropped.select("row", F.size("gone").cast("long").alias("n_dropped"), _kept_runs().alias("keep"))


def _kept_runs() -> Column:
    """What lies between the dropped lines, whose numbers are sorted, as runs."""
    edges = F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array("n_lines"))
    between = F.zip_with(*edges, lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("n")))
    return F.filter(between, lambda run: run["n"] > 0)


def kept_text(lines: str | Column, keep: str | Column) -> Column:
    """The kept lines of a text that is split, joined again; a null bitmap keeps all."""
    lines, keep = (F.col(c) if isinstance(c, str) else c for c in (lines, keep))
    runs = F.transform(keep, lambda run: F.array_join(F.slice(lines, run["first"] + 1, run["n"]), "\n"))
    return F.array_join(F.coalesce(runs, lines), "\n")


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    documents: int = 10,
    least: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep, kept) for each row: its lines, those that go, the bitmap and the text left.

    ``keep`` is null where no line goes. The other parameters are those of :func:`keep_bitmaps`.
    """
    work = Workspace(docs.sparkSession)
    rows = numbered_rows(docs, work, text, doc_id)
    bitmaps = keep_bitmaps(rows, work, documents, least, keep_first)
    whole = rows.join(bitmaps, "row", "left").select("doc_id", "n_dropped", "keep", _split("text").alias("lines"))
    return whole.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        "keep",
        kept_text("lines", "keep").alias("kept"),
    )
