"""Operator 9: substring dedup with an FM-index per shard.

A window is 35 consecutive words; each word inside a window whose words also
start anywhere else is removed. Equal windows hold equal words, so they agree on
the smallest hash of their 6-word runs, the window's anchor. Consecutive windows
of a document with one anchor form a segment; anchors that occur once in the
corpus cannot hold a repeated window. The segments of all other anchors are
dealt to shards by anchor. A shard's segments are put into a compressed FM-index
(``fm_index``) and streamed against it: backward search gives each position's
matching statistic, capped at 35 words, and positions with two or more
occurrences start a repeated window.

An anchor with more than HOT segments is dealt to several shards, and a shard
holds at most SHARD_WORDS words. For such split anchors one shard may miss an
occurrence in another: their windows that stayed single are counted once more by
their 128-bit hash over all shards of the anchor, with one row standing for all
occurrences that a shard has found already. The work is linear in the segments,
whatever the size of a group.

Shuffled are anchors (numbers), the texts of documents with a repeated anchor,
their segments, and the results; texts meet their results in a second join.

Defined cases: null or empty texts have no words; rows equal in id and text are
copies of each other like any others; a null id is an id of its own; windows are
judged on the input; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import session, written
from quillstream.llm.fm_index import FMIndex

WINDOW, ANCHOR = 35, 6
#: Segments of an anchor per shard, and words per index.
HOT, SHARD_WORDS = 2000, 400_000
#: Windows that one lane of the search covers.
LANE = 64


def segments(flat: W.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, first window, last window, anchor's occurrences) of maximal
    runs of windows of one row with one anchor; windows count from the row's start."""
    at, _ = W.windows(flat, WINDOW)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none.astype(W.U), none, none, none
    n = len(flat.hash)
    runs = np.zeros(n, W.U)
    where, key = W.windows(flat, ANCHOR)
    runs[where] = key
    # smallest of the WINDOW - ANCHOR + 1 runs of each window: of two overlapping powers of two
    span, size, least = WINDOW - ANCHOR + 1, 1, runs
    while 2 * size <= span:
        least = np.minimum(least[:len(least) - size], least[size:])
        size *= 2
    anchor = np.minimum(least[at], least[at + span - size])
    row = flat.row()[at]
    begins = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))
    ends = np.append(begins[1:], len(at))
    first, last = at[begins], at[ends - 1]
    # a segment can hold a repeated window by itself only where its anchor occurs twice in it
    key_of = anchor[begins]
    inside = (runs[at] == anchor).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(inside)])
    times = sums[ends] - sums[begins]
    tail = last[:, None] + np.arange(1, span)  # runs of the last window after its first one
    times += (runs[tail] == key_of[:, None]).sum(1)
    base = flat.first[row[begins]]
    return row[begins], key_of, first - base, last - base, times


SEGMENT = T.StructType([T.StructField("anchor", T.LongType(), False), T.StructField("first", T.IntegerType(), False),
                        T.StructField("last", T.IntegerType(), False), T.StructField("times", T.IntegerType(), False)])


@F.arrow_udf(returnType=T.ArrayType(SEGMENT, False))
def segment_keys(text: pa.Array) -> pa.Array:
    """Anchor, window range and occurrences of the anchor for each segment of each whole text."""
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    for low, high, flat in W.texts(text):
        found = segments(flat)
        for part, values in zip(parts, (found[1].view(np.int64), *found[2:], np.bincount(found[0], minlength=high - low))):
            part.append(values)
    join = lambda i, kind: np.concatenate([*parts[i], np.zeros(0, kind)]).astype(kind)
    offsets = np.zeros(len(text) + 1, np.int32)
    np.cumsum(join(4, np.int64), out=offsets[1:])
    values = pa.StructArray.from_arrays([pa.array(join(0, np.int64)), *(pa.array(join(i, np.int32)) for i in (1, 2, 3))], names=SEGMENT.fieldNames())
    return pa.ListArray.from_arrays(pa.array(offsets), values)


@F.arrow_udf(returnType=T.ArrayType(T.BinaryType(), False))
def segment_bytes(text: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
    """Bytes from the first word of a window to the last word of another, for listed pairs."""
    data, offset = W.buffers(text)
    firsts, lasts, out = first.to_pylist(), last.to_pylist(), []
    for low, high in W.slices(offset):
        part = offset[low:high + 1]
        flat = W.cut(data[part[0]:part[-1]], part - part[0], hashed=False)
        raw = flat.data.tobytes()
        for row in range(high - low):
            base = int(flat.first[row])
            a = np.array(firsts[low + row], np.int64) + base
            b = np.array(lasts[low + row], np.int64) + base + WINDOW - 1
            out.append([raw[i:j] for i, j in zip(flat.start[a].tolist(), flat.end[b].tolist())])
    return pa.array(out, pa.list_(pa.binary()))


#: Word spans to remove, or (with ``n``) windows of split anchors to count again.
FOUND = "doc_id bigint, text bigint, start int, end int, h1 bigint, h2 bigint, n int"


def _shard(rows: pa.Table, split: np.ndarray) -> pa.RecordBatch:
    """Repeated windows of one shard's segments; ``split`` marks segments whose
    anchor has segments in other shards."""
    data, offset = W.buffers(rows.column("bytes"))
    flat = W.cut(data, offset)
    count = np.diff(flat.first)
    # word numbers from one, and a separator after each segment
    symbol = W.byte_numbers(flat.data, flat.start, flat.end)  # equal words by their bytes
    start = flat.first[:-1] + np.arange(len(count))
    sequence = np.zeros(len(symbol) + len(count), np.int64)
    place = np.arange(len(symbol)) + np.repeat(np.arange(len(count)), count)
    sequence[place] = symbol + 1
    lanes = np.maximum(1, -(-(count - WINDOW + 1) // LANE))
    lane = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    low = np.repeat(start, lanes) + lane * LANE
    high = np.minimum(low + LANE + WINDOW - 1, np.repeat(start + count, lanes))
    times = FMIndex(sequence, WINDOW).occurrences(sequence, low, high)

    repeated = np.flatnonzero(times >= 2)
    seg = np.searchsorted(start, repeated, "right") - 1
    word = repeated - start[seg] + rows.column("first").to_numpy()[seg]
    new = np.append(True, (seg[1:] != seg[:-1]) | (word[1:] != word[:-1] + 1)) if len(seg) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    span_seg, span_start = seg[at], word[at]
    span_end = word[np.append(at[1:], len(seg)) - 1] + WINDOW if len(seg) else word
    doc, text = rows.column("doc_id"), rows.column("text")
    parts = [(doc.take(pa.array(span_seg)), text.take(pa.array(span_seg)), span_start, span_end, None, None, None)]

    of = np.repeat(split, count)
    single = np.flatnonzero((times[place] == 1) & of)
    known = np.flatnonzero((times[place] >= 2) & of)
    if len(single) or len(known):
        other = W.byte_hashes(flat.data, flat.start, flat.end, other=True)
        h1, h2 = (W.span_hashes(h, np.arange(len(h) - WINDOW + 1), np.arange(WINDOW, len(h) + 1)).view(np.int64) for h in (flat.hash, other))
        seg = np.repeat(np.arange(len(count)), count)[single]
        word = single - flat.first[seg] + rows.column("first").to_numpy()[seg]
        parts.append((doc.take(pa.array(seg)), text.take(pa.array(seg)), word, word + WINDOW, h1[single], h2[single], np.ones(len(single))))
        known = known[np.unique(np.stack([h1[known], h2[known]], 1), axis=0, return_index=True)[1]]
        null = pa.nulls(len(known), pa.int64())
        parts.append((null, null, pa.nulls(len(known), pa.int32()), pa.nulls(len(known), pa.int32()), h1[known], h2[known], np.full(len(known), 2)))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    columns = []
    for i, kind in enumerate(kinds):
        arrays = [pa.nulls(len(p[2]), kind) if p[i] is None else p[i].combine_chunks() if isinstance(p[i], pa.ChunkedArray) else p[i]
                  if isinstance(p[i], pa.Array) else pa.array(p[i].astype(np.int64)).cast(kind) for p in parts]
        columns.append(pa.concat_arrays([a.cast(kind) for a in arrays]))
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FOUND.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    """Indexes of at most about ``shard_words`` words over rows ordered by (anchor, part)."""
    held: list[pa.RecordBatch] = []
    words, open_key = 0, None

    def flush(next_key) -> pa.RecordBatch:
        nonlocal held, words, open_key
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = np.stack([rows.column("anchor").to_numpy(), rows.column("part").to_numpy()], 1)
        split = rows.column("parts").to_numpy() > 1
        for key in (open_key, next_key):  # groups that the limit cut
            if key is not None:
                split |= (keys == key).all(1)
        last = tuple(keys[-1])
        open_key = last if next_key is not None and last == tuple(next_key) else None
        held, words = [], 0
        return _shard(rows, split)

    for batch in batches:
        n = batch.column("words").to_numpy()
        keys = np.stack([batch.column("anchor").to_numpy(), batch.column("part").to_numpy()], 1)
        low = 0
        while low < batch.num_rows:
            room = np.searchsorted(np.cumsum(n[low:]), max(shard_words - words, 1), "right")
            high = low + max(1 if not held else 0, int(room))
            if high > low:
                held.append(batch.slice(low, high - low))
                words += int(n[low:high].sum())
                low = high
            if low < batch.num_rows:
                yield flush(keys[low])
    if held:
        yield flush(None)


def _uid() -> Column:
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"))


def repeated_spans(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(uid, start, end): word spans of repeated windows; a uid is a document's id
    and a hash of its text."""
    source = docs.select(_uid().alias("uid"), "text")
    found = written(source.select("uid", F.explode(segment_keys("text")).alias("s")).select("uid", "s.*"), "segments")
    again = found.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1")
    # written, so that the shuffles of all anchors are gone before texts are shuffled
    listed = written(found.join(again, "anchor").groupBy("uid").agg(F.collect_set(F.struct("anchor", "n", "first", "last")).alias("s")), "listed", release=True)
    own = (source.join(listed, "uid").select("uid", "s", segment_bytes("text", F.col("s.first"), F.col("s.last")).alias("raw"))
           .select("uid", F.explode(F.arrays_zip("s", "raw")).alias("z")).select("uid", "z.s.*", F.col("z.raw").alias("bytes")))
    parts = F.ceil(F.col("n") / hot).cast("int")
    dealt = (own.select("anchor", F.pmod(F.xxhash64("uid", "first"), parts).cast("int").alias("part"), parts.alias("parts"), "uid.doc_id", "uid.text",
                        "first", (F.col("last") - F.col("first") + WINDOW).alias("words"), "bytes")
             .repartition("anchor", "part").sortWithinPartitions("anchor", "part"))
    result = written(dealt.mapInArrow(lambda batches: _shards(batches, shard_words), FOUND), "found", release=True)
    left = result.filter("n is not null")
    twice = left.groupBy("h1", "h2").agg(F.sum("n").alias("all")).filter("all > 1").select("h1", "h2")
    late = left.filter("n = 1").join(twice, ["h1", "h2"])
    spans = result.filter("n is null").select("doc_id", "text", "start", "end").unionByName(late.select("doc_id", "text", "start", "end"))
    return spans.select(F.struct("doc_id", "text").alias("uid"), "start", "end")


CLEANED = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("n_removed", T.LongType(), False), T.StructField("kept", T.BinaryType(), False)])


def _without(text: pa.Array, start: pa.Array, end: pa.Array) -> Iterator[tuple[int, int, bytes]]:
    """(words, removed words, kept words joined by a space) of each row."""
    data, offset = W.buffers(text)
    starts, ends = start.to_pylist(), end.to_pylist()
    for low, high in W.slices(offset):
        part = offset[low:high + 1]
        flat = W.cut(data[part[0]:part[-1]], part - part[0], hashed=False)
        n = len(flat.start)
        at = [np.array(x[low + r] or (), np.int64) + flat.first[r] for x in (starts, ends) for r in range(high - low)]
        rows = high - low
        kept = ~W.covered(n, np.concatenate([*at[:rows], np.zeros(0, np.int64)]), np.concatenate([*at[rows:], np.zeros(0, np.int64)]))
        # bytes of kept words, and the byte after each but a row's last one as its space
        row = flat.row()[kept]
        s, e = flat.start[kept], flat.end[kept]
        final = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
        out = np.append(flat.data, 0).astype(np.uint8)
        out[e[~final]] = 0x20
        mask = W.covered(len(out), s, e + ~final)
        counts = np.concatenate([[0], np.cumsum(mask)])
        raw = out[mask].tobytes()
        bound = counts[flat.offset]
        removed = np.diff(np.concatenate([[0], np.cumsum(~kept)])[flat.first])
        for r in range(rows):
            yield int(flat.first[r + 1] - flat.first[r]), int(removed[r]), raw[bound[r]:bound[r + 1]]


@F.arrow_udf(returnType=CLEANED)
def without_spans(text: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    rows = list(_without(text, start, end))
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=CLEANED.fieldNames())


@F.arrow_udf(returnType=T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
                                      T.StructField("kept_sha256", T.StringType(), False)]))
def span_digests(text: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    rows = [(n, gone, hashlib.sha256(kept).hexdigest()) for n, gone, kept in _without(text, start, end)]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                      names=["n_words", "n_removed", "kept_sha256"])


def _with_spans(docs: DataFrame, hot: int, shard_words: int) -> DataFrame:
    session(docs)
    spans = repeated_spans(docs, hot, shard_words).distinct().groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("at"))
    return docs.select("doc_id", "text", _uid().alias("uid")).join(spans, "uid", "left")


def dedup_substrings(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of every document, joined by one space."""
    cleaned = _with_spans(docs, hot, shard_words).select("doc_id", without_spans("text", F.col("at.start"), F.col("at.end")).alias("c"))
    return cleaned.select("doc_id", "c.n_words", "c.n_removed", F.col("c.kept").cast("string").alias("text"))


def substring_report(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    cleaned = _with_spans(docs, hot, shard_words).select("doc_id", span_digests("text", F.col("at.start"), F.col("at.end")).alias("c"))
    return cleaned.select("doc_id", "c.*")
