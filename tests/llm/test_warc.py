import glob
import gzip
import hashlib

from pyspark.sql import functions as F

from quillstream.llm import warc as R
from quillstream.llm.common import shared

BIG = "x" * (17 << 20)
BODY = "head\r\n\r\n\n" + "é" * 1200
ROWS = [(1, "http://a\nb", BODY), (2, None, BODY), (None, "u", BODY), (4, "u", None), (5, "u", BIG), (6, "v", BIG), (7, "u", ""),
        (8, "", "a" * 999), (9, "", "a" * 999), (10, "w", "b" * 1000), (10, "w", "b" * 1000), (11, "w", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 40)]


def expected():
    best = {}
    for page, _, html in ROWS:
        if len((html or "").encode()) >= 1000 and page is not None:
            best[html] = max(best.get(html, page), page)
    out = []
    for page, _, html in ROWS:
        raw = (html or "").encode()
        first = best.get(html)
        kind = "response" if len(raw) < 1000 or page == first else "revisit"
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), kind, first if kind == "revisit" else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("record", F.lit(1)).withColumn("payload", F.lit("x"))
    whole, members = shared(spark, "t"), shared(spark, "t")
    R.write_archives(pages, whole)
    R.normalise(spark, whole, members)
    index = R.index_archives(spark, members).persist()
    got = sorted((tuple(r) for r in index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    assert got == expected()
    # every record is a member of its own, the index names its bytes, and any gzip reader sees the whole file
    for path in glob.glob(f"{members.removeprefix('file://')}/archive=*/part-*"):
        raw, name = open(path, "rb").read(), path.split("archive=")[1].split("/")[0]
        own = index.filter(F.col("archive") == name).orderBy("offset").collect()
        parts = [gzip.decompress(raw[r.offset:r.offset + r.length]) for r in own]
        assert gzip.decompress(raw) == b"".join(parts) and all(p.startswith(b"WARC/1.1\r\n") for p in parts)
    # the stored payload of each response, by way of the index
    some = index.filter("record_type = 'response'")
    records = R.read_records(spark, members, some).collect()
    digests = sorted(hashlib.sha1(R.parse(r.record)[1].partition(b"\r\n\r\n")[2]).hexdigest() for r in records)
    assert digests == sorted(r.payload_digest for r in some.collect())


def test_foreign_stream_and_empty(spark):
    records = [b"WARC/1.0\r\nWARC-Type: warcinfo\r\ncontent-length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in (b"", b"a\nb\r\n\r\nc", b"\x00\xff\x1f\x8b")]
    lines = (line + b"\n" for line in b"".join(records).split(b"\n"))
    assert list(R.cut_records(lines)) == records
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert R.archive_report(empty).count() == 0
