"""Operator 1: secret scans with sliding-window entropy, in SQL functions only.

Base spans come from three patterns. On top of them, candidate strings (long
runs of a character class) are slid over with a window: counts of the window's
characters are kept up to date, one in and one out at each step, and with them
the sum of c * log2(c), from which the window's Shannon entropy follows. Windows
at or above the class's threshold are merged into spans of kind ``entropy_<class>``.
A candidate that the allow list matches adds no span; base spans always stay.

Positions are sums of the lengths of what lies between matches and of the
matches, as ``split`` and ``regexp_extract_all`` find the same ones. Sums run in
blocks of BLOCK matches, so that a text with very many matches costs little more
than its length. Nothing is shuffled and no Python runs on the executors.

Defined cases: null is the empty text; texts are scanned whole; each row gives
one row, whatever its id; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base patterns, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
# shorter matches are dropped anyway and take no character of a longer one
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

BLOCK = 256


class EntropyClass(NamedTuple):
    """Characters of a class, the candidates cut from them, window and threshold in bits."""

    name: str
    alphabet: str
    candidate: str
    window: int
    bits: float


CLASSES = (
    EntropyClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.9),
    EntropyClass("upper_hex", "0123456789ABCDEF", r"(?<![0-9A-Za-z])[0-9A-F]{20,}(?![0-9A-Za-z])", 20, 3.0),
)
#: Candidates that match any of these are no secrets. No pattern repeats a group without
#: bound: Java matches such a group by recursion, which a long candidate overflows.
ALLOW = (r"(?i)example|sample|dummy|placeholder|changeme|your[_-]", r"(?i)abcdefgh|01234567|12345678", r"(.)\1{7}",
         r"^[A-Za-z]([A-Za-z_/=+-]*[A-Za-z])?=*$")


def located(text: Column, pattern: str, matches: Column) -> Column:
    """Array of (start, end, match) of all matches, in code points."""
    lengths = F.transform(F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("match")),
                          lambda z: F.struct(F.length(z["gap"]).alias("gap"), z["match"].alias("match")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    spans = "array<struct<start:int,end:int,match:string>>"

    def add(state: Column, z: Column) -> Column:
        start = state["at"] + z["gap"]
        end = start + F.length(z["match"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), end.alias("end"), z["match"].alias("match")))).alias("out"))

    def sums(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out")), add)

    done = F.transform(blocks, sums)

    def shift(state: Column, block: Column) -> Column:
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(F.transform(
            block["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end"), s["match"].alias("match"))))).alias("out"))

    placed = F.aggregate(done, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("out")), shift)
    return F.when(F.size(matches) > 0, F.flatten(placed["out"])).otherwise(F.array().cast(spans))


def _plus(count: Column) -> Column:
    """c * log2(c), zero for no character."""
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


SPANS = "array<struct<start:int,end:int>>"


def _steps(chars: Column, letters: Column, window: int) -> Column:
    """For each character: its place from one, its number among the candidate's
    distinct characters, and the number of the one that leaves the window (0: none)."""
    number = F.transform(chars, lambda c: F.array_position(letters, c).cast("int"))
    gone = F.concat(F.array_repeat(F.lit(0), window), number)
    return F.transform(F.arrays_zip(number.alias("into"), F.slice(gone, F.lit(1), F.size(chars)).alias("out")),
                       lambda z, i: F.struct((i + 1).alias("i"), z["into"].alias("into"), z["out"].alias("out")))


def _slide(state: Column, z: Column, start: Column, cls: EntropyClass) -> Column:
    """One step of the window. State: counts, their sum of c * log2(c), spans so far."""
    into, out = z["into"], z["out"]
    c_in, c_out = F.get(state["counts"], into - 1), F.get(state["counts"], out - 1)
    grown = state["sum"] + _plus(c_in + 1) - _plus(c_in)
    total = F.when(into == out, state["sum"]).when(out > 0, grown + _plus(c_out - 1) - _plus(c_out)).otherwise(grown)
    counts = F.when(into == out, state["counts"]).otherwise(F.transform(state["counts"], lambda c, k: (
        F.when(k == into - 1, c + 1).when(k == out - 1, c - 1).otherwise(c))))
    # H = log2(w) - sum / w for w characters
    most = cls.window * (math.log2(cls.window) - cls.bits) + 1e-9
    low, high, last = start + z["i"] - cls.window, start + z["i"], F.element_at(state["out"], -1)
    joined = (F.size(state["out"]) > 0) & (F.try_element_at(state["out"], F.lit(-1))["end"] >= low)
    spans = (F.when((z["i"] < cls.window) | (total > most), state["out"])
             .when(joined, F.concat(F.slice(state["out"], F.lit(1), F.size(state["out"]) - 1),
                                    F.array(F.struct(last["start"].alias("start"), high.alias("end")))))
             .otherwise(F.concat(state["out"], F.array(F.struct(low.alias("start"), high.alias("end"))))))
    return F.struct(counts.alias("counts"), total.alias("sum"), spans.alias("out"))


def entropy_spans(candidates: Column, cls: EntropyClass) -> Column:
    """Merged (start, end) of the windows of all candidates that reach the threshold."""
    # one transform after the other: what a lambda only refers to is evaluated once a candidate, not once a character
    cut = F.transform(candidates, lambda c: F.struct(c["start"].alias("start"), F.split(c["match"], "").alias("chars")))
    known = F.transform(cut, lambda c: F.struct(c["start"].alias("start"), c["chars"].alias("chars"), F.array_distinct(c["chars"]).alias("letters")))
    prepared = F.transform(known, lambda c: F.struct(
        c["start"].alias("start"), F.size(c["letters"]).alias("letters"), _steps(c["chars"], c["letters"], cls.window).alias("steps")))

    def one(c: Column) -> Column:
        begin = F.struct(F.array_repeat(F.lit(0), c["letters"]).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(c["steps"], begin, lambda state, z: _slide(state, z, c["start"], cls), lambda state: state["out"])

    return F.flatten(F.transform(prepared, one))


def _allowed(match: Column, allow: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for pattern in allow:
        out = out | match.rlike(pattern)
    return out


def _found(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _tagged(spans: Column, order: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """doc_id and ``base`` and ``added``: arrays of (start, order, end, kind), each by start, then kind."""
    base = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)]
    patterns = [*base, *((f"entropy_{c.name}", c.candidate) for c in classes)]
    whole = F.coalesce(F.col("t"), F.lit(""))
    rows = docs.select("doc_id", F.col(text).alias("t")).withColumn("t", whole)
    # one column after the other, so that each expensive expression is evaluated once
    rows = rows.select("doc_id", "t", *[_found(F.col("t"), p).alias(f"m_{k}") for k, p in patterns])
    rows = rows.select("doc_id", *[F.when(F.size(f"m_{k}") > 0, located(F.col("t"), p, F.col(f"m_{k}")))
                                   .otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>")).alias(f"s_{k}") for k, p in patterns])
    kept = {"assign": F.filter("s_assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_MIN),
            "access": F.col("s_access"), "hex": F.col("s_hex")}
    spans = [_tagged(kept[k], n, k) for n, (k, _) in enumerate(base)]
    added = [_tagged(entropy_spans(F.filter(f"s_entropy_{c.name}", lambda s: ~_allowed(s["match"], allow)), c), len(base) + n, f"entropy_{c.name}")
             for n, c in enumerate(classes)]
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("base"), F.array_sort(F.concat(*added)).alias("added"))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_entropy of every document."""
    found = scan(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_entropy"))
