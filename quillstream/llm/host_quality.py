"""Operator 3: quality rules with host-level verdicts.

Every document is measured in one pass over its whole text (Arrow batches,
numpy). Failures of the document rules are summed per host (partial sums before
the shuffle, so a host with a third of all rows is one small group), each
host's failure rate is shrunk towards a beta prior fitted to the rates of all
hosts, and the verdict is joined back to the documents.

Verdict: a document that fails a base rule is rejected. On a host whose shrunk
failure rate is at least ``bad_rate`` the soft rules become binding too. Clean
documents of a bad host stay.

Defined cases: a null or empty text has no words and fails the base rule; a
null host is a host of its own; repeated rows count and are returned once each;
an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import session, written

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = T.StructType([T.StructField(name, T.LongType(), False) for name in
                         ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeat_words(flat: W.Flat) -> np.ndarray:
    """Words per row inside a 3-word window that the row holds at least twice."""
    row, number = flat.row(), W.byte_numbers(flat.data, flat.start, flat.end)
    at = np.flatnonzero(np.arange(2, len(number) + 2) < np.repeat(flat.first[1:], np.diff(flat.first)))
    # words, pairs and windows by exact numbers
    pair = np.unique(number[at] * (len(number) + 1) + number[at + 1], return_inverse=True)[1]
    key = np.unique(pair * (len(number) + 1) + number[at + 2], return_inverse=True)[1]
    _, inverse, times = np.unique(row[at] * (len(number) + 1) + key, return_inverse=True, return_counts=True)
    hit = at[times[inverse] > 1]
    return W.per_row(flat, W.covered(len(flat.start), hit, hit + 3))


def _dup_lines(flat: W.Flat) -> np.ndarray:
    """Per row, lines that hold a word and equal an earlier line of the row."""
    start, end, first = W.lines(flat.data, flat.offset)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    with_word = np.searchsorted(flat.start, end) > np.searchsorted(flat.start, start)
    row, key = row[with_word], W.byte_numbers(flat.data, start[with_word], end[with_word])
    order = np.lexsort((key, row))
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order[1:][same]], minlength=len(first) - 1).astype(np.int64)


def _measure_column(column: pa.Array) -> pa.Array:
    parts: list[list[np.ndarray]] = [[] for _ in MEASURES.fields]
    for _, _, flat in W.texts(column, hashed=False):
        points = _sums((flat.data & 0xC0) != 0x80)  # first bytes of code points
        symbols = _sums(SYMBOLS[flat.data])
        for part, values in zip(parts, (
                np.diff(flat.first), W.per_row(flat, points[flat.end] - points[flat.start]),
                np.diff(symbols[flat.offset]), _dup_lines(flat), _repeat_words(flat))):
            part.append(values)
    joined = [np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64) for p in parts]
    return pa.StructArray.from_arrays([pa.array(x) for x in joined], names=MEASURES.fieldNames())


@F.arrow_udf(returnType=MEASURES)
def measures(text: pa.Array) -> pa.Array:
    """Struct of the five base measures of each whole text."""
    return _measure_column(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def soft_failed(m: Column) -> Column:
    """Rules that only bind on a bad host: symbols, repeated lines, word length."""
    return ((10 * m["n_symbols"] > m["n_words"]) | (10 * m["n_dup_lines"] > m["n_words"])
            | (m["word_chars"] < 3 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"]))


#: A host's documents are dealt over so many join keys, as one host may hold a third of all rows.
SALTS = 32


def host_verdicts(measured: DataFrame, bad_rate: float = 0.5) -> DataFrame:
    """One row per host of (host, m): documents, failures, shrunk rate, verdict ``bad``.

    The prior is a beta distribution with the mean and variance of the host
    rates (method of moments). Its weight is at least that of one document, also
    where the rates have no variance or more than a beta distribution can have."""
    m = F.col("m")
    hosts = written(measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), F.sum((base_failed(m) | soft_failed(m)).cast("long")).alias("failures")), "hosts")
    rate = F.col("failures") / F.col("docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # one row
    mean, var = mean or 0.0, var or 0.0
    weight = max(1.0, mean * (1 - mean) / var - 1) if var > 0 else 1.0
    shrunk = (F.col("failures") + mean * weight) / (F.col("docs") + weight)
    return hosts.select("host", "docs", "failures", shrunk.alias("rate"), (shrunk >= bad_rate).alias("bad"))


def with_verdicts(measured: DataFrame, verdicts: DataFrame, host: str, m: str, key: str, kept: str) -> DataFrame:
    """``measured`` with boolean ``kept``: its own rules, and the soft rules on a bad host."""
    bad = verdicts.filter("bad").select(F.col("host").alias("__host"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    on = measured[host].eqNullSafe(bad["__host"]) & (F.pmod(F.xxhash64(measured[key]), F.lit(SALTS)).cast("int") == bad["__salt"])
    joined = measured.join(bad, on, "left")
    binding = F.col("__salt").isNotNull() & soft_failed(F.col(m))
    return joined.withColumn(kept, ~base_failed(F.col(m)) & ~binding).drop("__host", "__salt")


def quality_rules(docs: DataFrame, bad_rate: float = 0.5) -> DataFrame:
    """doc_id, the five measures, ``base_failed`` and ``kept`` of every document."""
    session(docs)
    measured = written(docs.select("doc_id", F.col("source").alias("host"), measures(F.col("text")).alias("m")), "measures")
    judged = with_verdicts(measured, host_verdicts(measured, bad_rate), "host", "m", "doc_id", "kept")
    return judged.select("doc_id", "m.*", base_failed(F.col("m")).alias("base_failed"), "kept")


def filter_documents(docs: DataFrame, bad_rate: float = 0.5) -> DataFrame:
    """The documents that the rules and their host's verdict keep, all columns as they were.

    The texts are measured twice, for the hosts and for the documents: that is
    cheaper than to shuffle whole texts to their verdicts."""
    session(docs)
    names = [F.col(f"`{c}`") for c in docs.columns]
    verdicts = host_verdicts(docs.select(F.col("source").alias("host"), measures(F.col("text")).alias("m")), bad_rate)
    measured = docs.withColumn("__m", measures(F.col("text")))
    return with_verdicts(measured, verdicts, "source", "__m", "doc_id", "__kept").filter("__kept").select(*names)
