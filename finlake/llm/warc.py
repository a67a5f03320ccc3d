"""WARC archives: a writer, and a sequential reader that checks what it reads.

``write`` turns pages into archives of about ``ARCHIVE_BYTES`` each, one gzip member per record. Archives
are rows (``archive``, ``content``), kept as a table that Spark writes, so they lie wherever Spark can
write; archives in files are read with the ``binaryFile`` source, whose column is called ``content`` too.

``read`` walks through each archive: it inflates a member piece by piece, parses the record's headers,
takes as many bytes as Content-Length says, and verifies the two line ends, the end of the member and the
digests of block and payload. A damaged record raises an error with its archive and offset.

Payloads that are equal, and of at least ``least`` bytes, are stored once: the page with the largest id
is the response, and the others are revisit records, which name that page and carry no payload. The
search counts digests, before any shuffle by task, and writes those that come again. Pages move only to be joined with
these where they are too many to be broadcast.

A null html is an empty payload. Rows that repeat the largest id of a payload are responses each. Pages
without an id are written as responses.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import Workspace

ARCHIVE_BYTES = 8 << 20
INFLATED = 1 << 16
RECORD = "page_id long, record_type string, url string, payload binary, payload_bytes long, payload_digest string, refers_to long"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, as a gzip member."""
    size = 0 if revisit else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    named = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{URN}{'' if page is None else page}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": "" if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        named |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<{URN}{refers_to}>"}
    named["Content-Length"] = str(len(block))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in named.items()) + b"\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head + block + b"\r\n\r\n") + deflate.flush()


class Member:
    """The inflated bytes of one gzip member, made as they are asked for."""

    def __init__(self, data: memoryview, at: int):
        self.data, self.at, self.inflate, self.held = data, at, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        tail = self.inflate.unconsumed_tail
        if not tail:
            tail = self.data[self.at : self.at + INFLATED]
            self.at += len(tail)
            if not tail:
                raise ValueError("the archive ends within a record")
        self.held += self.inflate.decompress(tail, INFLATED)
        self.at -= len(self.inflate.unused_data)
        return True

    def line(self) -> bytes:
        while (end := self.held.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a header line has no end")
        line = bytes(self.held[:end])
        del self.held[: end + 2]
        return line

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise ValueError("the record is shorter than its Content-Length")
        taken = bytes(self.held[:size])
        del self.held[:size]
        return taken

    def end(self) -> int:
        """Where the next member begins; nothing may be left in this one."""
        while self._more():
            pass
        if self.held:
            raise ValueError("the record is longer than its Content-Length")
        return self.at


def _headers(member: Member) -> dict[str, str]:
    named = {}
    while line := member.line():
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line has no colon")
        named[name.decode().lower()] = value.strip().decode()
    return named


def _page(uri: str) -> int | None:
    number = uri.strip("<>").removeprefix(URN)
    return int(number) if number else None


def records(content: bytes, name: str = "") -> Iterator[tuple]:
    """The records of one archive in order, as rows of RECORD."""
    data, at = memoryview(content), 0
    while at < len(data):
        try:
            member = Member(data, at)
            if member.line() != VERSION:
                raise ValueError("no record begins here")
            named = _headers(member)
            block = member.take(int(named["content-length"]))
            if member.take(4) != b"\r\n\r\n":
                raise ValueError("the record doesn't end with two line ends")
            after = member.end()
            if named["warc-block-digest"] != f"sha1:{sha1(block)}":
                raise ValueError("the block's digest is another")
            revisit = named["warc-type"] == "revisit"
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            digest, size = named["warc-payload-digest"].removeprefix("sha1:"), int(named["x-payload-length"])
            if not revisit and (sha1(payload), len(payload)) != (digest, size):
                raise ValueError("the payload's digest or length is another")
            refers = _page(named["warc-refers-to"]) if revisit else None
            page, url = _page(named["warc-record-id"]), named["warc-target-uri"]
        except (ValueError, KeyError, zlib.error) as wrong:
            raise ValueError(f"archive {name}, record at byte {at}: {wrong}") from wrong
        yield page, named["warc-type"], url, None if revisit else payload, size, digest, refers
        at = after


def with_revisits(pages: DataFrame, page_id: str, html: str, url: str, least: int) -> DataFrame:
    """(id, url, payload, refers_to, revisit) of each page.

    The digests that come more than once, with their largest page, are written before the pages are joined to them: where
    they are few Spark broadcasts them and no page moves, and else it splits the pages of a digest that very many have.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    often = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.max("id").alias("largest"), F.count("*").alias("copies"))
        .where("copies > 1 and largest is not null")
        .select("same", "largest")
    )
    often = Workspace(pages.sparkSession).save(often)
    joined = rows.join(often, F.col("digest") == F.col("same"), "left")
    revisit = F.col("largest").isNotNull() & F.col("id").isNotNull() & (F.col("id") < F.col("largest"))
    return joined.select("id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit"))


def write(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url", least: int = 0, size: int = ARCHIVE_BYTES
) -> DataFrame:
    """Archives (archive, content) with a record for each page; ``archive`` is a number within the table."""

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def done() -> pa.RecordBatch:
            return pa.record_batch({"content": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("id", "url", "payload", "refers_to", "revisit"))):
                held.append(record(*(value.as_py() for value in row)))
                count += len(held[-1])
                if count >= size:
                    yield done()
                    held, count = [], 0
        if held:
            yield done()

    rows = with_revisits(pages, page_id, html, url, least)
    packed = rows.select("id", "url", "payload", "refers_to", "revisit").mapInArrow(archive, "content binary")
    return packed.withColumn("archive", F.monotonically_increasing_id())


def read(archives: DataFrame, name: str = "archive", content: str = "content") -> DataFrame:
    """The records of archives, verified."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for label, data in zip(batch.column("name"), batch.column("content")):
                held, size = [], 0
                for row in records(data.as_py() or b"", label.as_py()):
                    held.append(row)
                    size += row[4]
                    if size > ARCHIVE_BYTES // 4:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                        held, size = [], 0
                if held:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    named = archives.select(F.col(name).cast("string").alias("name"), F.col(content).alias("content"))
    return named.mapInArrow(walk, RECORD)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    return read(Workspace(pages.sparkSession).save(write(pages, least=least)))
