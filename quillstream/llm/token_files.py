"""Operator 6: token ids in seekable zstandard files.

Documents are dealt by ranges of their id, so that the files in order of their
part numbers hold all documents in ascending order. A file is a chain of
independent zstandard frames with content checksums, a skippable frame with the
first and last id of each frame, and a seek table in the seekable format: sizes
and a checksum (low 32 bits of XXH64) of each frame. A reader inflates only the
frames whose id range holds a requested document.

A frame holds whole documents, about FRAME_IDS ids: the number of documents,
their ids, a byte each for "has an id", their counts, then all token ids; all
little-endian. Frames are written as they fill, so a task holds one frame.

Texts are shuffled once, before they are encoded: encoding first would need
every text encoded twice, as range partitioning samples its input.

Defined cases: a null text is empty and holds the end id alone; a null id sorts
first; rows of equal ids stand side by side in a fixed order; an empty table
gives no frames; a document beyond FRAME_IDS ids is a frame of its own; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.llm.bpe import Encoder, pieces, tokenizer_file
from quillstream.llm.byte_files import read_files, write_pieces
from quillstream.llm.common import session, shared, written

END_ID = 1
FRAME_IDS = 1 << 17
WORDS_A_CALL = 256
SKIP, INDEX, TABLE = 0x184D2A50, 0x184D2A51, 0x184D2A5E
TABLE_MAGIC = 0x8F92EAB1
#: Every piece of a file ends in the last byte of the seek table's magic number.
LAST = b"\x8f"
PAD = struct.pack("<II", SKIP, 1) + LAST
NO_ID = -(1 << 63)


class LibraryEncoder(Encoder):
    """The tokenizers library over the distinct words of texts, each encoded once."""

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        super().__init__(file)
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ends_word = np.array([t.endswith(self.suffix.encode()) for t in self.token])

    def encode_words(self, words: list[str]) -> list[bytes]:
        # many words a call, as the library cuts them at the spaces again
        lines = [words[i:i + WORDS_A_CALL] for i in range(0, len(words), WORDS_A_CALL)]
        out: list[bytes] = []
        for line, found in zip(lines, self.tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            bound = [0, *(4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()]
            if len(bound) != len(line) + 1:
                raise ValueError("the tokenizer did not end each word with a word-end token")
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip(bound, bound[1:])]
        return out


_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(file: bytes) -> LibraryEncoder:
    key = hashlib.sha256(file).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(file)
    return _ENCODERS[key]


def _frame(docs: list[tuple[int | None, bytes]]) -> bytes:
    ids = np.array([NO_ID if i is None else i for i, _ in docs], "<i8")
    has = np.array([i is not None for i, _ in docs], np.uint8)
    count = np.array([len(t) // 4 for _, t in docs], "<u4")
    return b"".join([struct.pack("<I", len(docs)), ids.tobytes(), has.tobytes(), count.tobytes(), *(t for _, t in docs)])


def file_pieces(docs: Iterable[tuple[int | None, bytes]]) -> Iterator[bytes]:
    """The pieces of one file, each without its LAST byte, from (id, token ids) in order."""
    compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    table: list[bytes] = []
    ranges: list[bytes] = []

    def flush(run: list[tuple[int | None, bytes]]) -> bytes:
        raw = _frame(run)
        frame = compressor.compress(raw)
        table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        table.append(struct.pack("<III", len(PAD), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        low, high = (NO_ID if i is None else i for i in (run[0][0], run[-1][0]))
        ranges.append(struct.pack("<qq", low, high))
        return (frame + PAD)[:-1]

    run: list[tuple[int | None, bytes]] = []
    size = 0
    for doc in docs:
        if run and size + len(doc[1]) > 4 * FRAME_IDS:
            yield flush(run)
            run, size = [], 0
        run.append(doc)
        size += len(doc[1])
    if run:
        yield flush(run)
    if not table:
        return
    index = b"".join(ranges)
    piece = struct.pack("<II", INDEX, len(index) + 1) + index + LAST
    table.append(struct.pack("<III", len(piece), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
    yield piece[:-1]
    body = b"".join(table) + struct.pack("<IBI", len(table), 0x80, TABLE_MAGIC)
    yield (struct.pack("<II", TABLE, len(body)) + body)[:-1]


def documents(content: bytes, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of a file's documents in order, of ``wanted`` ids only if
    given; frames without such a document are not inflated."""
    if not content:
        return
    count, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != TABLE_MAGIC or flags != 0x80:
        raise ValueError("no seek table with checksums at the end of the file")
    table = np.frombuffer(content, "<u4", 3 * count, len(content) - 9 - 12 * count).reshape(-1, 3).astype(np.int64)
    offset = np.cumsum(table[:, 0]) - table[:, 0]
    index = np.frombuffer(content, "<i8", 2 * int((table[:, 1] > 0).sum()), int(offset[-1]) + 8).reshape(-1, 2)
    keys = None if wanted is None else np.array(sorted(NO_ID if i is None else i for i in wanted), np.int64)
    inflate = zstandard.ZstdDecompressor()
    for (length, size, check), at, (low, high) in zip(table[table[:, 1] > 0].tolist(), offset[table[:, 1] > 0].tolist(), index.tolist()):
        if keys is not None and np.searchsorted(keys, low) == np.searchsorted(keys, high, "right"):
            continue
        raw = inflate.decompress(content[at:at + length])
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError("a frame does not match its seek table entry")
        (n,) = struct.unpack_from("<I", raw)
        ids = np.frombuffer(raw, "<i8", n, 4).tolist()
        has = np.frombuffer(raw, np.uint8, n, 4 + 8 * n).tolist()
        counts = np.frombuffer(raw, "<u4", n, 4 + 9 * n).astype(np.int64)
        tokens = np.frombuffer(raw, "<u4", int(counts.sum()), 4 + 13 * n)
        for i, own, end, c in zip(ids, has, np.cumsum(counts).tolist(), counts.tolist()):
            doc = i if own else None
            if wanted is None or doc in wanted:
                yield doc, tokens[end - c:end]


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, text: str = "text") -> None:
    """Write the documents' ids, with END_ID after each, in ascending order of doc_id."""
    spark = session(docs)
    file = tokenizer_file(spark, tokenizer)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = _encoder(file.value), np.array([END_ID], "<u4").tobytes()

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                ids, at = batch.column(0).to_pylist(), 0
                for run in pieces(batch.column(1).to_pylist()):
                    for tokens in enc.encode(run):
                        yield ids[at], tokens + end
                        at += 1

        for piece in file_pieces(rows()):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], ["piece"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = source.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    write_pieces(dealt.mapInArrow(encode, "piece binary"), "piece", path, LAST)


def read_token_files(spark: SparkSession, path: str, wanted: set[int | None] | None = None) -> DataFrame:
    """(part, place, doc_id, ids as binary) of the documents in the files, in
    file order within a part; ``wanted`` is a stated set of ids."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _files(batches):
            for place, (doc, ids) in enumerate(documents(content, wanted)):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([place], pa.int64()), pa.array([doc], pa.int64()),
                                                  pa.array([ids.tobytes()], pa.binary())], ["part", "place", "doc_id", "ids"])

    return read_files(spark, path).select("path", "content").mapInArrow(read, "part string, place bigint, doc_id bigint, ids binary")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py()


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _files(batches):
            rows, before = [], 0
            for doc, ids in documents(content):
                rows.append((doc, before, len(ids), zlib.crc32(ids)))
                before += len(ids)
            doc, start, n, crc = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *(pa.array(x, pa.int64()) for x in (doc, start, n, crc))],
                                             ["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    rows = written(read_files(spark, path).select("path", "content").mapInArrow(
        read, "part string, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"), "token-report")
    number = F.regexp_extract("part", r"part-(\d+)", 1).cast("long")
    # one row per file; the running sum is over files, not documents
    before = (rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return rows.join(before.select("part", "before"), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to a new place in the shared folder, read the files back and report."""
    spark = session(docs)
    path = shared(spark, "token-files")
    write_token_files(docs, path, tokenizer)
    return file_report(spark, path)
