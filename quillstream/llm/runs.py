"""Operator 12: periodic runs of words by descending LCP.

A run is a maximal stretch of words with smallest period q that is at least
``least`` words and ``exponent`` periods long. Per text, over exact word numbers:

1. A suffix array by prefix doubling and the LCP of neighbours in it, from the
   doubling's own ranks. Only rows in which some window of the shortest useful
   LCP occurs twice get that far; the others hold no run.
2. Kruskal: the suffix classes are united by decreasing LCP with union-find;
   each class keeps its positions in order. When two classes unite at LCP l,
   positions that become neighbours agree for exactly l words. At a distance d
   of at most l / (exponent - 1) they seed a run: text[i : i + d + l] has
   period d. No position of the class lies between them, so d is its smallest
   period (two periods of a stretch this long have their divisor as a period).
3. A seed whose left neighbours differ starts a run; every run has one such
   seed, its first position and the one a period later.

Texts are worked on in pieces of about a megabyte, many rows at once; a longer
text is a piece of its own. Nothing is shuffled.

``planted`` makes the words of a tenth of the documents periodic by a fixed rule
over the id, so that runs of every length are there to be found.

Defined cases: a null text is empty and has no runs; a null id plants nothing;
each row gives one row, whatever its id; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import session

LEAST = 6
EXPONENT = 4
PIECE_BYTES = 1 << 20


class Runs(NamedTuple):
    """Runs by row, start and period; positions count from the row's first word."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def shortest_lcp(least: int, exponent: int) -> int:
    """LCP of the first position of a run and the one a period later, at least."""
    return min(max(least, exponent * q) - q for q in range(1, least + 1))


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words, by their bytes."""
    return pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each key, number of its members)."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return inverse, counts[inverse]


def _repeating_rows(symbol: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """True for rows in which a window of k words occurs twice."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.zeros(len(first) - 1, bool)
    at = np.arange(len(symbol))
    kind, members = _classes(row * (int(symbol.max(initial=0)) + 1) + symbol)
    length = 1
    while True:
        # places whose window of this length occurs twice in their row; longer ones do so only there
        at, kind = at[members > 1], kind[members > 1]
        if length == k:
            break
        step = min(length, k - length)
        dense = np.full(len(symbol) + step, -1, np.int64)
        dense[at] = kind
        nxt = dense[at + step]
        ok = (nxt >= 0) & (at + step + length <= first[row[at] + 1])
        at, pair = at[ok], kind[ok] * (len(symbol) + 1) + nxt[ok]
        kind, members = _classes(pair)
        length += step
    out[row[at]] = True
    return out


def _suffixes(symbol: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and LCP of each entry with the next. ``symbol`` differs
    between rows; ``end``: end of each position's row."""
    n = len(symbol)
    rank = np.unique(symbol, return_inverse=True)[1]
    levels, k = [], 1
    while int(rank.max()) + 1 < n:
        levels.append(rank.astype(np.int32))
        after = np.zeros(n, np.int64)
        after[:n - k] = rank[k:] + 1
        after[np.arange(n) + k >= end] = 0  # the text ends first
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        k *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    i, j = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for level in reversed(levels):
        k //= 2
        a, b = i + lcp, j + lcp
        inside = (a < end[i]) & (b < end[j])
        same = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        lcp += np.where(same, k, 0)
    return order, lcp


def _seeds(left: list[int], right: list[int], lcp: list[int], size: int, share: int) -> tuple[list[int], list[int], list[int]]:
    """(i, j, l) of positions that become neighbours of one class at LCP l with
    (j - i) * share <= l, from suffix array neighbours by decreasing LCP."""
    parent = list(range(size))
    members: dict[int, list[int]] = {}
    out_i: list[int] = []
    out_j: list[int] = []
    out_l: list[int] = []

    def seed(i: int, j: int, l: int) -> None:  # noqa: E741
        if (j - i) * share <= l:
            out_i.append(i)
            out_j.append(j)
            out_l.append(l)

    for a, b, l in zip(left, right, lcp):  # noqa: E741
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        big, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(big) < len(small):
            a, b, big, small = b, a, small, big
        parent[b] = a
        at, before, last = 0, -1, len(small) - 1
        for t, x in enumerate(small):
            at = bisect_left(big, x, at)
            if at and big[at - 1] != before:
                seed(big[at - 1], x, l)
            if at < len(big) and (t == last or small[t + 1] > big[at]):
                seed(x, big[at], l)
            big.insert(at, x)
            before = x
        members[a] = big
    return out_i, out_j, out_l


def find_runs(symbol: np.ndarray, first: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> Runs:
    """All runs of rows of numbered words; row r is ``symbol[first[r]:first[r + 1]]``."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    none = np.zeros(0, np.int64)
    low = shortest_lcp(least, exponent)
    hot = np.flatnonzero(_repeating_rows(symbol, first, low))
    if not len(hot):
        return Runs(none, none, none, none)
    # the words of these rows alone, with numbers that differ between rows
    size = (first[1:] - first[:-1])[hot]
    bound = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(hot)), size)
    own = symbol[np.arange(bound[-1]) - bound[row] + first[hot[row]]] + row * (int(symbol.max()) + 1)
    order, lcp = _suffixes(own, bound[row + 1])
    edge = np.flatnonzero(lcp >= low)
    edge = edge[np.argsort(-lcp[edge], kind="stable")]
    i, j, l = (np.array(x, np.int64) for x in _seeds(  # noqa: E741
        order[edge].tolist(), order[edge + 1].tolist(), lcp[edge].tolist(), len(own), exponent - 1))
    if not len(i):
        return Runs(none, none, none, none)
    starts = (i == bound[row[i]]) | (own[i - 1] != own[j - 1])
    i, period, length = i[starts], (j - i)[starts], (j - i + l)[starts]
    long_enough = length >= np.maximum(least, exponent * period)
    i, period, length = i[long_enough], period[long_enough], length[long_enough]
    place = np.lexsort((period, i))
    i, period, length = i[place], period[place], length[place]
    return Runs(hot[row[i]], i - bound[row[i]], length, period)


def repeated_words(runs: Runs, first: np.ndarray) -> np.ndarray:
    """True for each word that a run holds after its first period."""
    step = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(step, first[runs.row] + runs.start + runs.period, 1)
    np.add.at(step, first[runs.row] + runs.start + runs.length, -1)
    return np.cumsum(step[:-1]) > 0


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, made periodic from a place on in a tenth of the documents."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


class TextRuns(NamedTuple):
    """Words of one text with its runs (start, length, period) and the words that stay."""

    words: list[bytes]
    runs: list[tuple[int, int, int]]
    kept: list[bytes]


def text_runs(rows: list[tuple[int | None, list[bytes]]], least: int = LEAST, exponent: int = EXPONENT) -> Iterator[TextRuns]:
    """Runs of each of several rows (id, words), found together."""
    lists = [words for _, words in rows]
    first = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int64)
    every = [w for words in lists for w in words]
    runs = find_runs(numbered(every), first, least, exponent)
    keep = ~repeated_words(runs, first)
    bound = np.searchsorted(runs.row, np.arange(len(rows) + 1))
    triples = list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist()))
    for r, words in enumerate(lists):
        own = triples[bound[r]:bound[r + 1]]
        stay = [words[i] for i in np.flatnonzero(keep[first[r]:first[r + 1]]).tolist()] if own else words
        yield TextRuns(words, own, stay)


def _pieces(ids: list[int | None], texts: list[str | None], plant: bool) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Rows (id, words) of about PIECE_BYTES of text at a time."""
    piece: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for doc, text in zip(ids, texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if piece and size + len(raw) > PIECE_BYTES:
            yield piece
            piece, size = [], 0
        found = raw.split()  # ASCII white space, as bytes.split takes it
        piece.append((doc, planted(doc, found) if plant else found))
        size += len(raw)
    if piece:
        yield piece


RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("runs", T.ArrayType(RUN, False), False), T.StructField("text", T.StringType(), False)])


def collapsed(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, text: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period) and ``text``: the words
    that no run holds after its first period, joined by one space."""
    session(docs)

    @F.arrow_udf(returnType=FOUND)
    def find(ids: pa.Array, column: pa.Array) -> pa.Array:
        runs, kept = [], []
        for piece in _pieces(ids.to_pylist(), column.to_pylist(), plant):
            for found in text_runs(piece, least, exponent):
                runs.append([dict(zip(RUN.fieldNames(), r)) for r in found.runs])
                kept.append(b" ".join(found.kept).decode("utf-8", "surrogatepass"))
        run = pa.struct([(name, pa.int64()) for name in RUN.fieldNames()])
        return pa.StructArray.from_arrays([pa.array(runs, pa.list_(run)), pa.array(kept, pa.string())], names=FOUND.fieldNames())

    found = docs.select("doc_id", find(F.col("doc_id").cast("long"), F.col(text)).alias("f"))
    return found.select("doc_id", "f.runs", "f.text")


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and digests of all runs and of the collapsed
    text of every document, with the words that the fixed rule plants."""
    rows = collapsed(docs, plant=True)
    # greatest length, then smallest start, then smallest period
    best = F.try_element_at(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(1))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                             r["period"].cast("string")), F.lit("\n"))), "")
    rows = rows.select("doc_id", "runs", F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"), best.alias("b"),
                       F.sha2(listed.cast("binary"), 256).alias("runs_sha256"))
    length = -F.col("b.l")
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.start").alias("start"), length.alias("length"),
                       F.col("b.period").alias("period"), F.floor(1000 * length / F.col("b.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

