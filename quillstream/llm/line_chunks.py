"""Operator 8: line dedup by content-defined chunks of lines.

A rolling hash over each line and the one before it is taken; a chunk begins
where that hash is smaller than on both neighbouring lines. Boundaries so depend
on four lines only: lines put in or taken out elsewhere shift no chunk, chunks
inside a document have at least two lines and three on average. Chunks with two
or more non-blank lines that occur again anywhere are removed after their bytes
are compared with those of the first occurrence (smallest id, then place), which
stays. With ``copies`` a whole text of two or more non-blank lines counts as a
chunk too (number WHOLE), so a copy loses the lines that lie in smaller chunks.

Shuffled are, first, chunk hashes only; then texts to the numbers of their repeated
chunks; then texts to their verdicts. Both go by key at every size of the tables, and
the first shuffle's files are freed before the second. A chunk that a third of all
documents share is one row per task in the count, and joins carry it with the
unique first occurrence on the other side, so that Spark can split it.

Defined cases: a null text stays null and has no lines; an empty text is one
blank line; rows equal in id and text are one document given several times and
keep the same chunks; a null id sorts first; other columns pass unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import digest, session, written

#: Non-blank lines that a chunk needs to be removed.
MIN_LINES = 2
#: Number of the chunk that is a whole text; a text of one chunk has no other.
WHOLE = -1


def cut_chunks(data: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first, lines): byte bounds of chunks, the number of chunks
    before each row, and the non-blank lines of each chunk."""
    start, end, first = W.lines(data, offset)
    line = W.byte_hashes(data, start, end)
    head = np.zeros(len(line), bool)
    head[first[:-1]] = True
    rolling = W.mix(line + W.U(0x9E3779B97F4A7C15))
    rolling[1:] = np.where(head[1:], rolling[1:], W.mix(line[:-1] * W.U(0xD6E8FEB86659FD93) + line[1:]))
    begins = head.copy()
    inner = ~head[1:-1] & ~head[2:] & (rolling[1:-1] < rolling[:-2]) & (rolling[1:-1] < rolling[2:])
    begins[1:-1] |= inner
    at = np.flatnonzero(begins)
    chunk_first = np.searchsorted(at, first)
    chunk_start = start[at]
    chunk_end = np.append(chunk_start[1:], len(data))
    chunk_end[chunk_first[1:] - 1] = offset[1:]  # a row's last chunk ends with the row
    words = np.concatenate([[0], np.cumsum(W.NOT_SPACE[data])])
    filled = np.concatenate([[0], np.cumsum(words[end] > words[start])])
    return chunk_start, chunk_end, chunk_first, filled[np.append(at[1:], len(start))] - filled[at]


CHUNK = T.StructType([T.StructField("no", T.IntegerType(), False), T.StructField("k1", T.LongType(), False), T.StructField("k2", T.LongType(), False)])


def _pieces(column: pa.Array):
    data, offset = W.buffers(column)
    for low, high in W.slices(offset):
        part = offset[low:high + 1]
        own, bounds = data[part[0]:part[-1]], part - part[0]
        yield low, high, own, bounds, cut_chunks(own, bounds)


def _bare_end(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ends of chunks without a last newline, so that a chunk at the end of a text equals one inside."""
    return end - ((end > start) & (data[np.maximum(end, 1) - 1] == 10) if len(data) else 0)


def _keys(text: pa.Array, copies: bool) -> pa.Array:
    no, k1, k2, count = [], [], [], []
    for _, _, data, bounds, (start, end, first, filled) in _pieces(text):
        bare = _bare_end(data, start, end)
        ok = np.flatnonzero(filled >= MIN_LINES)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        number, low, high, of = (np.arange(len(start)) - first[row])[ok], start[ok], bare[ok], row[ok]
        if copies:
            whole = np.flatnonzero((np.diff(first) > 1) & (np.add.reduceat(filled, first[:-1]) >= MIN_LINES))
            order = np.argsort(np.concatenate([of, whole]), kind="stable")
            number, low, high, of = (np.concatenate(x)[order] for x in (
                (number, np.full(len(whole), WHOLE)), (low, bounds[whole]), (high, _bare_end(data, bounds[whole], bounds[whole + 1])), (of, whole)))
        no.append(number)
        k1.append(W.byte_hashes(data, low, high).view(np.int64))
        k2.append(W.byte_hashes(data, low, high, other=True).view(np.int64))
        count.append(np.bincount(of, minlength=len(first) - 1))
    join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
    offsets = np.zeros(len(text) + 1, np.int32)
    np.cumsum(join(count, np.int64), out=offsets[1:])
    values = pa.StructArray.from_arrays([pa.array(join(no, np.int32)), pa.array(join(k1, np.int64)), pa.array(join(k2, np.int64))], names=CHUNK.fieldNames())
    return pa.ListArray.from_arrays(pa.array(offsets), values)


@F.arrow_udf(returnType=T.ArrayType(CHUNK, False))
def chunk_keys(text: pa.Array) -> pa.Array:
    """Number and 128-bit hash of the removable chunks of each whole text."""
    return _keys(text, False)


@F.arrow_udf(returnType=T.ArrayType(CHUNK, False))
def chunk_and_text_keys(text: pa.Array) -> pa.Array:
    """The same, and those of each whole text that has several chunks."""
    return _keys(text, True)


@F.arrow_udf(returnType=T.ArrayType(T.BinaryType(), False))
def chunk_bytes(text: pa.Array, numbers: pa.Array) -> pa.Array:
    """Bytes of the chunks with the given numbers."""
    wanted, out = numbers.to_pylist(), []
    for low, high, data, bounds, (start, end, first, _) in _pieces(text):
        bare, whole = _bare_end(data, start, end), _bare_end(data, bounds[:-1], bounds[1:])
        for row in range(high - low):
            at = int(first[row])
            out.append([data[bounds[row]:whole[row]].tobytes() if n == WHOLE else data[start[at + n]:bare[at + n]].tobytes() for n in wanted[low + row]])
    return pa.array(out, pa.list_(pa.binary()))


CLEANED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType(), False),
                        T.StructField("n_removed", T.LongType(), False)])


@F.arrow_udf(returnType=CLEANED)
def without_chunks(text: pa.Array, numbers: pa.Array) -> pa.Array:
    """Text without the chunks of the given numbers, its lines and the removed ones."""
    removed, null = numbers.to_pylist(), text.is_null().to_pylist()
    texts, total, gone = [], [], []
    for low, high, data, bounds, (start, end, first, _) in _pieces(text):
        line_start, _, line_first = W.lines(data, bounds)
        for row in range(high - low):
            a, b = int(line_first[row]), int(line_first[row + 1])
            drop, raw = set(removed[low + row] or ()), data[bounds[row]:bounds[row + 1]].tobytes()
            if null[low + row]:
                texts.append(None)
                total.append(0)
                gone.append(0)
                continue
            lost = 0
            if WHOLE in drop:
                raw, lost = b"", b - a
            elif drop:
                kept = []
                for no, i in enumerate(range(int(first[row]), int(first[row + 1]))):
                    if no in drop:
                        last = i + 1 == int(first[row + 1])
                        upto = b if last else int(np.searchsorted(line_start[a:b], end[i])) + a
                        lost += upto - (int(np.searchsorted(line_start[a:b], start[i])) + a)
                    else:
                        kept.append(data[start[i]:end[i]].tobytes())
                raw = b"".join(kept)
                if int(first[row + 1] - first[row]) - 1 in drop and raw.endswith(b"\n"):
                    raw = raw[:-1]  # of the line before a removed last chunk
            texts.append(raw.decode())
            total.append(b - a)
            gone.append(lost)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=CLEANED.fieldNames())


def removals(docs: DataFrame, copies: bool = False) -> DataFrame:
    """(uid, numbers): chunks to remove from each document that has some; a uid is
    a document's id and a hash of its text."""
    uid = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"))
    source = docs.select(uid.alias("uid"), "text").filter("text is not null")
    found = written(source.select("uid", F.explode((chunk_and_text_keys if copies else chunk_keys)("text")).alias("c")).select("uid", "c.*"), "chunks")
    again = (found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "no")).alias("first"))
             .filter("n > 1").drop("n"))
    hits = written(found.join(again, ["k1", "k2"]), "repeated", release=True)
    # own place and place of the first occurrence are needed with their bytes
    listed = hits.groupBy("uid").agg(F.collect_set(F.struct("no", "k1", "k2", (F.struct("uid", "no") == F.col("first")).alias("keeps"))).alias("at"))
    with_bytes = (source.join(listed.hint("merge"), "uid")
                  .select("uid", "at", chunk_bytes("text", F.col("at.no")).alias("raw"))
                  .select("uid", F.explode(F.arrays_zip("at", "raw")).alias("z"))
                  .select("uid", "z.at.*", "z.raw"))
    with_bytes = written(with_bytes, "bytes", release=True)
    first = with_bytes.filter("keeps").select("k1", "k2", F.col("raw").alias("kept")).groupBy("k1", "k2").agg(F.first("kept").alias("kept"))
    same = with_bytes.filter("not keeps").join(first, ["k1", "k2"]).filter("raw = kept")
    return same.groupBy("uid").agg(F.collect_set("no").alias("numbers"))


def dedup_lines(docs: DataFrame, copies: bool = False) -> DataFrame:
    """``docs`` with text replaced and n_chars (where there is one) set to its new
    length; column ``__lines`` holds the numbers of lines and of removed lines.
    With ``copies`` a copy of a whole text loses all its lines."""
    session(docs)
    gone = written(removals(docs, copies), "removals")
    uid = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"))
    keyed = docs.withColumn("__uid", uid).join(gone.select(F.col("uid").alias("__uid"), F.col("numbers").alias("__numbers")).hint("merge"), "__uid", "left")
    cleaned = keyed.withColumn("__lines", without_chunks("text", "__numbers")).drop("__uid", "__numbers")
    names = [F.col("__lines.text").alias(c) if c == "text" else F.length("__lines.text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
             else F.col(f"`{c}`") for c in docs.columns]
    return cleaned.select(*names, "__lines")


def line_report(docs: DataFrame, copies: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed_lines, kept_chars and kept_sha256 of every document."""
    out = dedup_lines(docs.select("doc_id", "text"), copies)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.col("__lines.n_lines").alias("n_lines"), F.col("__lines.n_removed").alias("n_removed_lines"),
                      F.length(text).cast("long").alias("kept_chars"), digest(text).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without repeated chunks and texts; one that loses all its words goes,
    one that had none before stays."""
    out = dedup_lines(docs, copies=True)
    had = F.col("__lines.n_removed") > 0
    return out.filter(~had | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*[F.col(f"`{c}`") for c in docs.columns])
