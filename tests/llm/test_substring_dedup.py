import hashlib
from collections import Counter

import numpy as np
import pytest

from quillstream.llm import substring_dedup as S
from quillstream.llm.fm_index import BitVector, FMIndex, WaveletMatrix
from tests.llm.conftest import rows_of


def brute(rows):
    words = [(doc, (text or "").encode().replace(b"\x1c", b"\xff").split()) for doc, text in rows]
    count = Counter(tuple(w[i:i + 35]) for _, w in words for i in range(len(w) - 34))
    out = []
    for doc, w in words:
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i:i + 35])] > 1 for j in range(i, i + 35)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).replace(b"\xff", b"\x1c")
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_documents_equal_brute_force(docs, texts):
    want = brute(texts)
    assert rows_of(S.substring_report(docs)) == want and sum(r[2] for r in want)


def test_split_anchors_and_small_shards(spark, texts):
    few = spark.createDataFrame(texts[-60:], "doc_id long, text string")
    assert rows_of(S.substring_report(few, hot=1, shard_words=60)) == brute(texts[-60:])


def test_passage_of_many_documents(spark):
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(50))
    word = lambda n: " ".join(f"u{x}" for x in rng.integers(0, 10**6, n))
    rows = [(i, f"{word(rng.integers(0, 40))} {passage} {word(rng.integers(0, 40))}") for i in range(150)]
    rows += [(200, " ".join(f"p{i}" for i in range(34))), (201, word(100))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(S.substring_report(df, hot=20, shard_words=1000)) == brute(rows)


def test_kept_text(spark, no_docs):
    rows = [(1, "  a\tb\n" + "w " * 40), (2, "")]
    out = {r.doc_id: r.text for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "a b", 2: ""}
    assert S.substring_report(no_docs).count() == 0


@pytest.mark.parametrize("letters, size, depth", [(2, 300, 35), (3, 2000, 5), (50, 3000, 3), (2, 3000, 35), (4, 100, 1), (5, 2000, 32), (5, 2000, 33)])
def test_matching_statistics(letters, size, depth):
    rng = np.random.default_rng(size + depth)
    parts = []
    while sum(map(len, parts)) < size:
        part = rng.integers(1, letters + 1, rng.integers(1, 120))
        if parts and rng.random() < 0.5:
            old = parts[rng.integers(len(parts))]
            part = np.concatenate([old[:rng.integers(len(old) + 1)], part[:20]])
        if len(part):
            parts.append(part)
    sequence = np.concatenate([np.append(p, 0) for p in parts])
    length = np.array([len(p) for p in parts])
    start = np.cumsum(length + 1) - length - 1
    got = FMIndex(sequence, depth).occurrences(sequence, start, start + length)
    count = Counter(tuple(p[i:i + depth]) for p in parts for i in range(len(p) - depth + 1))
    want = np.zeros(len(sequence), np.int64)
    for p, at in zip(parts, start):
        for i in range(len(p) - depth + 1):
            want[at + i] = count[tuple(p[i:i + depth])]
    assert (got == want).all()


def test_ranks():
    rng = np.random.default_rng(1)
    bits = rng.random(1000) < 0.3
    at = np.arange(1001)
    assert (BitVector(bits).ones(at) == np.concatenate([[0], np.cumsum(bits)])).all()
    sequence = rng.integers(0, 37, 500)
    wavelet = WaveletMatrix(sequence, 40)
    for symbol in (0, 1, 36, 39):
        assert (wavelet.rank(np.full(501, symbol), np.arange(501)) == np.concatenate([[0], np.cumsum(sequence == symbol)])).all()
