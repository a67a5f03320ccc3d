import gzip
import zlib

import pytest

from finlake.llm import warc

PAGES = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (5, None, None), (7, "u", ""), (9, "http://b", "x" * 200_000), (9, "http://b", "x" * 200_000), (None, "v", "<p>é</p>")]
SCHEMA = "page_id long, url string, html string"


def expected(least=0):
    out = []
    for page, url, html in PAGES:
        payload = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None and len(payload) >= least]
        revisit = page is not None and bool(same) and page < max(same)
        out.append((page, "revisit" if revisit else "response", url or "", None if revisit else payload, len(payload), warc.sha1(payload), max(same) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least, size", [(0, warc.ARCHIVE_BYTES), (0, 300), (5, 300), (10**6, 10)])
def test_round_trip(spark, least, size):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumnRenamed("url", "link").selectExpr("*", "1 as digest", "2 as archive", "link as url")
    archives = warc.write(pages, least=least, size=size)
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read(archives).collect()]
    assert sorted(got, key=str) == expected(least)


def test_members_are_plain_gzip_and_files_are_read(spark, tmp_path):
    records = [warc.record(i, "u", b"x" * i, None, False) for i in range(3)]
    assert gzip.decompress(b"".join(records)).count(b"WARC/1.1\r\n") == 3
    (tmp_path / "one.warc.gz").write_bytes(b"".join(records))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert sorted(r["page_id"] for r in warc.read(files, name="path").collect()) == [0, 1, 2]


def test_damage_is_told():
    whole = warc.record(4, "http://a", b"payload " * 50, None, False)
    assert len(list(warc.records(whole * 2))) == 2
    plain = gzip.decompress(whole)
    longer = plain.replace(b"Content-Length: ", b"Content-Length: 1", 2)
    for broken in (
        whole[:-9],
        whole + b"junk",
        gzip.compress(plain.replace(b"payload p", b"payloaX p", 1)),
        gzip.compress(longer),
        gzip.compress(plain + b"more"),
        gzip.compress(plain.replace(b"WARC/1.1", b"WARX/1.1")),
        gzip.compress(plain.replace(b"Content-Length", b"Content-Size")),
        zlib.compress(plain),
    ):
        with pytest.raises(ValueError, match="archive A, record at byte"):
            list(warc.records(broken, "A"))


def test_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
    assert list(warc.records(b"")) == []
