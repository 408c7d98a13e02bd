"""Operator 5: benchmark decontamination by Wu-Manber multi-pattern search.

The symbols are words, so a pattern is a window of ten consecutive item words
(or the whole of a shorter item) and a block is a pair of adjacent words. The
shift table, indexed by the block that ends at a position, says how far every
pattern must lie ahead; positions in between are never looked at. Many
stretches of text advance together, one numpy step for all of them. Where the
shift is zero, the suffix bucket names the test strings and their bytes are
compared with the text's.

Patterns come from the benchmark in blocks of at most ``BLOCK_BYTES`` of item
text, and each block is broadcast by itself: a stated query set against all
rows. The documents are scanned in one pass, without a shuffle.

Defined cases: a null or empty document has no words and is clean; an item
without words matches nothing; an item without id counts for hits but not among
the items; equal items and repeated rows are allowed; an empty benchmark leaves
every document clean.
"""

from __future__ import annotations

import hashlib
import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import session

WINDOW = 10
#: Item text per broadcast; its tables take about 30 times as much.
BLOCK_BYTES = 4 << 20
#: End positions that one lane of the search advances through.
LANE = 192
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MULTIPLY = W.U(0xD6E8FEB86659FD93)


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


class Machine(NamedTuple):
    """Search tables for patterns of one length, ordered by suffix bucket and hash."""

    length: int
    block: int
    shift: np.ndarray
    bucket: np.ndarray
    whole: np.ndarray
    strings: list[bytes]
    items: list[tuple[str, ...]]


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block that ends at each word; the first words of a batch have none."""
    if size == 1:
        return hashes
    out = np.zeros(len(hashes), W.U)
    out[1:] = W.mix(hashes[:-1] * _MULTIPLY + hashes[1:])
    return out


def machines(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Machine]:
    """One machine per pattern length, from (item id, text) rows."""
    patterns: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = item_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            ids = patterns.setdefault(tuple(words[i:i + window]), set())
            if item is not None:
                ids.add(item)
    out = []
    for length in sorted({len(p) for p in patterns}):
        own = [p for p in patterns if len(p) == length]
        flat = W.cut(*_joined([b" ".join(p) for p in own]), W.ALNUM)
        hashes = flat.hash.reshape(len(own), length)
        block = min(2, length)
        blocks = np.stack([_blocks(row, block) for row in hashes])
        bits = max(16, math.ceil(math.log2(len(own) * length + 1)) + 4)
        shift = np.full(1 << bits, length - block + 1, np.uint8)
        for end in range(block - 1, length):  # the nearer to the end, the smaller: ends with the minimum
            np.minimum.at(shift, blocks[:, end] & W.U((1 << bits) - 1), np.uint8(length - 1 - end))
        first = np.arange(len(own)) * length
        whole = W.span_hashes(flat.hash, first, first + length)
        order = np.lexsort((whole, blocks[:, -1]))
        out.append(Machine(length, block, shift, blocks[order, -1], whole[order], [b" ".join(own[i]) for i in order],
                           [tuple(sorted(patterns[own[i]])) for i in order]))
    return out


def _joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offset = np.zeros(len(strings) + 1, np.int64)
    np.cumsum([len(s) for s in strings], out=offset[1:])
    return np.frombuffer(b"".join(strings), np.uint8), offset


def _zero_shifts(machine: Machine, blocks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """End positions with shift zero, visiting only positions that the shifts allow."""
    low, high = first[:-1] + machine.length - 1, first[1:]  # ends of windows inside each row
    count = np.maximum(0, -(-(high - low) // LANE))
    lane = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(low, count) + lane * LANE
    stop = np.minimum(at + LANE, np.repeat(high, count))
    mask, found = W.U(len(machine.shift) - 1), []
    while len(at):
        shift = machine.shift[blocks[at] & mask]
        found.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        live = at < stop
        at, stop = at[live], stop[live]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def occurrences(machine: Machine, flat: W.Flat) -> list[tuple[int, int]]:
    """(first word, pattern number) of every occurrence, in order of place."""
    end = _zero_shifts(machine, _blocks(flat.hash, machine.block), flat.first)
    block = _blocks(flat.hash, machine.block)[end]
    low, high = np.searchsorted(machine.bucket, block, "left"), np.searchsorted(machine.bucket, block, "right")
    end, low, high = end[low < high], low[low < high], high[low < high]
    first = end - machine.length + 1
    whole = W.span_hashes(flat.hash, first, end + 1)
    out = []
    # a bucket's test strings are ordered by hash: those that can match are compared byte by byte
    for word, a, b, key in zip(first.tolist(), low.tolist(), high.tolist(), whole):
        at = a + int(np.searchsorted(machine.whole[a:b], key))
        while at < b and machine.whole[at] == key:
            words = zip(flat.start[word:word + machine.length].tolist(), flat.end[word:word + machine.length].tolist())
            if b" ".join(flat.data[s:e].tobytes() for s, e in words) == machine.strings[at]:
                out.append((word, at))
            at += 1
    return out


HITS = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("start", T.ArrayType(T.LongType(), False), False),
                     T.StructField("end", T.ArrayType(T.LongType(), False), False), T.StructField("items", T.ArrayType(T.StringType(), False), False)])


def _search_column(column: pa.Array, tables: list[Machine]) -> pa.Array:
    n_words: list[int] = []
    spans: list[list[tuple[int, int]]] = []
    items: list[list[str]] = []
    for _, _, flat in W.texts(column, W.ALNUM, fold=True):
        row_spans: list[list[tuple[int, int]]] = [[] for _ in flat.first[1:]]
        row_items: list[set[str]] = [set() for _ in flat.first[1:]]
        for machine in tables:
            found = occurrences(machine, flat)
            rows = np.searchsorted(flat.first, [w for w, _ in found], "right") - 1
            for (word, pattern), row in zip(found, rows.tolist()):
                at = word - int(flat.first[row])
                if row_spans[row] and row_spans[row][-1][0] <= at <= row_spans[row][-1][1]:
                    row_spans[row][-1] = (row_spans[row][-1][0], max(row_spans[row][-1][1], at + machine.length))
                else:
                    row_spans[row].append((at, at + machine.length))
                row_items[row].update(machine.items[pattern])
        n_words += np.diff(flat.first).tolist()
        spans += row_spans
        items += [sorted(x) for x in row_items]
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
         pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
        names=HITS.fieldNames())


def _search_with(tables):
    @F.arrow_udf(returnType=HITS)
    def hits(text: pa.Array) -> pa.Array:
        return _search_column(text, tables.value)
    return hits


def hit_udfs(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list:
    """UDFs from text to HITS, one for each block of the benchmark."""
    spark = session(benchmark)
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()  # copies of an item are one pattern
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(2 * total / block_bytes))
    block_of = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    out = []
    for block in range(count):
        own = [tuple(r) for r in rows.filter(block_of == block).collect()]  # about block_bytes / 2 of text
        out.append(_search_with(spark.sparkContext.broadcast(machines(own, window))))
    return out


REPORT = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("n_hit", T.LongType(), False),
                       T.StructField("n_items", T.LongType(), False), T.StructField("items_sha256", T.StringType(), False),
                       T.StructField("contaminated", T.BooleanType(), False)])


def _report(*blocks: pa.Array) -> pa.Array:
    rows = []
    for parts in zip(*(b.to_pylist() for b in blocks)):
        covered = end = 0
        for a, b in sorted((a, b) for p in parts for a, b in zip(p["start"], p["end"])):
            covered += max(0, b - max(a, end))
            end = max(end, b)
        items = sorted({i for p in parts for i in p["items"]})
        rows.append({"n_words": parts[0]["n_words"], "n_hit": covered, "n_items": len(items),
                     "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(), "contaminated": covered > 0})
    return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                                     ("items_sha256", pa.string()), ("contaminated", pa.bool_())]))


def report_column(benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Column:
    """Column of REPORT structs: hit words, items and verdict of each document."""
    found = [hits(F.col(text)) for hits in hit_udfs(benchmark, window, block_bytes)]

    # the number of columns is the number of blocks
    if len(found) == 1:
        @F.arrow_udf(returnType=REPORT)
        def report(a: pa.Array) -> pa.Array:
            return _report(a)
        return report(*found)
    packed, count = F.array(*found), len(found)

    @F.arrow_udf(returnType=REPORT)
    def report_blocks(a: pa.Array) -> pa.Array:
        rows = a.to_pylist()
        return _report(*(pa.array([r[i] for r in rows]) for i in range(count))) if rows else _report(pa.array([]))
    return report_blocks(packed)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    session(docs)
    return docs.select("doc_id", report_column(benchmark, "text", window, block_bytes).alias("r")).select("doc_id", "r.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, all columns as they were."""
    session(docs)
    names = [F.col(f"`{c}`") for c in docs.columns]
    flagged = docs.withColumn("__leaks", report_column(benchmark, "text", window))
    return flagged.filter(~F.col("__leaks.contaminated")).select(*names)
