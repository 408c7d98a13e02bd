"""Operator 2: WARC archives, from whole-file gzip streams to one member a record.

``write_archives`` lets Spark's text writer deflate each task's records as one
monolithic gzip stream. ``normalise`` has Spark inflate each such file once, as
a stream of lines, cuts it into records by their Content-Length and writes every
record as a gzip member of its own. ``index_archives`` walks the members of the
written files and gives each record's offset and length with its headers; that
table is written beside the archives as the sidecar index.

A task holds one record at a time while it normalises, and one normalised
archive (about what one writing task got) while it indexes. Payloads are
compared by SHA-256; groups of equal payloads are counted before the shuffle,
and the join with their one response row leaves Spark free to split a payload
that a third of all pages share.

Defined cases: null html is an empty payload and a response; a null page_id is
never the largest, in a group without ids all are responses; rows equal in
page_id and payload that hold the largest id are all responses; a null url has
no target header; line breaks in a url are percent-encoded; an empty table
gives no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm.byte_files import read_files, write_pieces
from quillstream.llm.common import session, shared, written

#: Payloads of fewer bytes are always stored.
MIN_REVISIT = 1000
CRLF = "\r\n"
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member ends in the high byte of its length, zero below this size.
PLAIN_END = 1 << 24


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of each page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("key", F.sha2("payload", 256)))
    groups = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("key")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "response"))
    refers_to = F.when(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return (rows.join(groups, "key", "left").withColumn("refers_to", refers_to)
            .select("page_id", "url", "payload", "payload_bytes", F.sha1("payload").alias("payload_digest"),
                    F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to"))


def _record_id(page: Column, kind: str) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}:"), F.coalesce(page.cast("string"), F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), *[F.concat(F.substring(h, a, n), F.lit(end)) for a, n, end in
                                            ((1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))])


def records(typed: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One ``record`` string per page: WARC headers, then HTTP headers and, for a response, the payload."""
    body = F.when(F.col("record_type") == "response", F.concat(F.lit(HTTP), F.col("payload").cast("string"))).otherwise(F.lit(HTTP))
    header = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    refers = F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to"), "page"))
    headers = [F.lit(f"WARC/1.1{CRLF}"), header("WARC-Type", F.col("record_type")), header("WARC-Record-ID", _record_id(F.col("page_id"), "page")),
               header("WARC-Date", F.lit(date)), header("WARC-Target-URI", url),
               header("Content-Type", F.lit("application/http; msgtype=response")),
               header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
               header("WARC-Profile", F.when(F.col("refers_to").isNotNull(), PROFILE)), header("WARC-Refers-To", refers),
               header("X-Page-ID", F.col("page_id")), header("X-Refers-To-Page-ID", F.col("refers_to")),
               header("X-Payload-Length", F.col("payload_bytes")), header("Content-Length", F.octet_length("body")), F.lit(CRLF)]
    return typed.withColumn("body", body).select(F.concat(*headers, F.col("body"), F.lit(CRLF)).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT) -> None:
    """A monolithic gzip archive per task, one record for each page."""
    (records(record_types(pages, min_bytes)).write.option("lineSep", CRLF).option("compression", "gzip").text(path))


_LENGTH = re.compile(rb"^content-length:\s*(\d+)\s*$", re.IGNORECASE)


def cut_records(lines: Iterator[bytes]) -> Iterator[bytes]:
    """Records (through the two line ends that close each) from the lines of one
    inflated archive, each line with its newline."""
    for line in lines:
        if not line.strip():
            continue  # between records
        head, length = [line], 0
        for line in lines:
            head.append(line)
            if found := _LENGTH.match(line):
                length = int(found[1])
            if line in (b"\r\n", b"\n"):
                break
        body, size = [], 0
        while size < length + 4:
            line = next(lines, None)
            if line is None:
                break
            body.append(line)
            size += len(line)
        block = b"".join(body)
        if len(block) < length:
            raise ValueError("an archive ends within a record")
        yield b"".join(head) + block[:length] + b"\r\n\r\n"


def member(record: bytes) -> tuple[bytes, int]:
    """(piece, bytes in the file): a record as a gzip member without its last zero
    byte, which the writer puts; after a record of 16 MiB that byte is padding."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = deflate.compress(record) + deflate.flush()
    return (whole[:-1], len(whole)) if whole[-1] == 0 else (whole, len(whole) + 1)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the gzip archives below ``source`` as files of one member per record,
    one file under ``target/archive=<name>`` for each archive."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def by_archive() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        rows = by_archive()
        ahead = next(rows, None)
        while ahead is not None:
            name = ahead[0]

            def lines(name: str = name) -> Iterator[bytes]:
                nonlocal ahead
                while ahead is not None and ahead[0] == name:
                    line, ahead = ahead[1] + b"\n", next(rows, None)
                    yield line

            for n, record in enumerate(cut_records(lines())):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([member(record)[0]], pa.binary())],
                                                 ["archive", "n", "piece"])

    # the reader inflates a file once, from its start, and gives its lines in order to one task
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\..*$", "")
    lines = spark.read.option("lineSep", "\n").text(source).select(name.alias("archive"), F.col("value").cast("binary").alias("line"))
    pieces = lines.mapInArrow(rewrite, "archive string, n bigint, piece binary").sortWithinPartitions("archive", "n")
    write_pieces(pieces, "piece", target, b"\0", partition_by="archive")


def walk(content: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every gzip member of a file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        if content[at] == 0:  # padding
            at += 1
            continue
        inflate, out, end = zlib.decompressobj(31), [], at
        while not inflate.eof:
            if end >= len(content):
                raise ValueError("a member does not end")
            out.append(inflate.decompress(view[end:end + step]))
            end = min(end + step, len(content))
        end -= len(inflate.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict((k.strip().lower(), v.strip()) for k, _, v in (h.partition(":") for h in head.decode().split(CRLF)[1:]))
    return headers, rest[:int(headers["content-length"])]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


INDEX = ("archive string, offset bigint, length bigint, record_type string, target_uri string, page_id bigint, "
         "payload_bytes bigint, payload_digest string, refers_to bigint")


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """The offset index of normalised archives: a row per record, from the files as they are.

    Length and digest of a response's payload are computed from what is stored."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for offset, length, record in walk(batch.column(1)[i].as_py()):
                    headers, block = parse(record)
                    kind = headers["warc-type"]
                    size, digest = _number(headers.get("x-payload-length")), headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    rows.append((batch.column(0)[i].as_py(), offset, length, kind, headers.get("warc-target-uri"), _number(headers.get("x-page-id")),
                                 size, digest, _number(headers.get("x-refers-to-page-id"))))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                columns = list(zip(*rows)) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in INDEX.split(", ")])

    name = F.regexp_extract("path", r"/archive=([^/]+)/", 1)
    return read_files(spark, path).select(name.alias("archive"), "content").mapInArrow(index, INDEX)


def read_records(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """(archive, offset, record) of the records that rows of the index name; only these are inflated."""
    wanted = index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("at"))
    files = read_files(spark, path).select(F.regexp_extract("path", r"/archive=([^/]+)/", 1).alias("archive"), "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_py()
                for at in batch.column(2)[i].as_py():
                    record = zlib.decompress(content[at["offset"]:at["offset"] + at["length"]], 31)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([at["offset"]]), pa.array([record], pa.binary())],
                                                     ["archive", "offset", "record"])

    return files.join(wanted, "archive").select("archive", "content", "at").mapInArrow(read, "archive string, offset bigint, record binary")


def archive_report(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write, normalise and read back: page_id, payload_bytes, payload_digest,
    record_type and refers_to of every record."""
    spark = session(pages)
    whole, members = shared(spark, "warc-streams"), shared(spark, "warc")
    write_archives(pages, whole, min_bytes)
    normalise(spark, whole, members)
    index = written(index_archives(spark, members), "warc-index")
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
