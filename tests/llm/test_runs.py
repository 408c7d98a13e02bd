import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quillstream.llm import runs as P
from tests.llm.conftest import rows_of


def brute_runs(w, least=6, exponent=4):
    """(start, length, period) by every period: maximal stretches where words q apart are equal."""
    n, found = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            # the smallest period of a stretch is found first; a multiple of it spans the same words
            if length >= max(least, exponent * q) and not any(s == i and n_ == length and q % p == 0 for (s, n_, p) in found):
                found[i, length, q] = True
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc, w):
    if doc is None or not w or zlib.crc32(str(doc).encode()) % 10:
        return w
    g, n = zlib.crc32(str(doc).encode()) // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute(doc, text):
    w = planted(doc, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    one = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *one, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def found(rows, least=6, exponent=4):
    symbols = np.array([x for w in rows for x in w], np.int64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in rows])]).astype(np.int64)
    runs = P.find_runs(symbols, first, least, exponent)
    out = [[] for _ in rows]
    for r, s, n, q in zip(*(x.tolist() for x in runs)):
        out[r].append((s, n, q))
    return out


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (10, 3)])
def test_random_rows(least, exponent):
    """Few letters, nested and overlapping periods, many rows at once."""
    rng = random.Random(5)
    rows = [[rng.randrange(rng.choice([1, 2, 2, 3])) for _ in range(rng.randrange(60))] for _ in range(400)]
    rows += [([rng.randrange(3) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 12))[:rng.randrange(1, 90)] + [9] * rng.randrange(12) for _ in range(400)]
    fib = [[0], [0, 1]]
    for _ in range(8):
        fib.append(fib[-1] + fib[-2])
    rows += fib + [[], [1], [1, 1], [5] * 300, ([1] * 9 + [2]) * 20, [0, 1] * 3 + [0], list(range(50)) * 4]
    assert found(rows, least, exponent) == [brute_runs(w, least, exponent) for w in rows]


def test_thue_morse_has_no_run():
    w = [bin(i).count("1") % 2 for i in range(4096)]
    assert found([w, w + [0] * 40]) == [[], brute_runs(w + [0] * 40)]


def test_report_equals_brute_force(docs, texts):
    # the brute force tries all periods; the longest row is checked by itself below
    short = [(i, t) for i, t in texts if len(t or "") < 30_000]
    got = {}
    for row in P.run_report(docs).collect():
        got.setdefault(row.doc_id, []).append((row.doc_id, row.n_runs, row.start, row.length, row.period, row.exponent_milli, row.runs_sha256, row.collapsed_sha256))
    for doc, text in short:
        assert brute(doc, text) in got[doc]
    assert sum(len(v) for v in got.values()) == len(texts)
    assert any(v[0][1] for v in got.values())


def test_very_long_periodic_rows(spark):
    """One word, and a passage of a thousand words, over 300,000 words; words equal by bytes only."""
    passage = " ".join(f"p{i}" for i in range(1000))
    rows = [(2, "la " * 300_000), (3, f"{passage} " * 300 + "tail"), (4, "a b " * 12), (5, "A a " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.runs, r.text) for r in P.collapsed(df).collect()}
    runs = {k: [tuple(x) for x in v[0]] for k, v in got.items()}
    assert runs == {2: [(0, 300_000, 1)], 3: [(0, 300_000, 1000)], 4: [(0, 12, 1)], 5: [(0, 10, 2)]}
    assert got[2][1] == "la" and got[3][1] == passage + " tail" and got[5][1] == "A a"


def test_rules_on_edges(spark, no_docs):
    assert P.run_report(no_docs).count() == 0
    with pytest.raises(ValueError):
        P.find_runs(np.zeros(3, np.int64), np.array([0, 3]), 2, 1)
    rows = [(None, "x " * 9), (None, None), (0, ""), (0, "  \n")]
    got = rows_of(P.run_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted((brute(*r) for r in rows), key=repr)
