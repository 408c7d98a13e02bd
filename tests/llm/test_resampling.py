import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from quillstream.llm import resampling as R
from quillstream.llm.common import table
from tests.llm.conftest import SF001, rows_of


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10000


def brute(docs, target):
    s, t = (Counter(bucket(g) for text in texts for g in features(text)[1]) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * (s_all + 10000)) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    rows, order = [], []
    for doc, text in docs:
        words, grams = features(text)
        weight = sum(gain[bucket(g)] for g in grams)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(grams), weight, score))
        if len(words) >= 20:
            order.append((-score, doc is not None, doc or 0))
    drawn = Counter()
    ranks = {}
    for rank, (minus, has, doc) in enumerate(sorted(order)[:5 * len(order) // 100], 1):
        ranks.setdefault((doc if has else None, -minus), []).append(rank)
    out = []
    for doc, n, weight, score in rows:
        own = ranks.get((doc, score), [])
        k = drawn[doc, score]
        drawn[doc, score] += 1
        out.append((doc, n, weight, score, own[k] if k < len(own) else None))
    return sorted(out, key=repr)


def test_rows_equal_brute_force(spark, docs, texts):
    target = table(spark, SF001, "benchmark")
    got = rows_of(R.resampled(docs, target))
    assert got == brute(texts, [r.text for r in target.collect()])
    assert sum(r[-1] is not None for r in got) > 5


def test_ties_repeated_rows_and_ranks(spark):
    """Forty rows of one id and text tie in score and id; ranks have no gap."""
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 40 + [(i, text) for i in range(100, 160)] + [(None, text), (8, "too short"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("w1 w2 w3 w4",), (None,)], "text string")
    got = rows_of(R.resampled(df, target))
    assert got == brute(rows, ["w1 w2 w3 w4", None])
    assert sorted(r[-1] for r in got if r[-1]) == list(range(1, 6))


def test_table_folds_and_blanks():
    assert [w.decode() for w in R.words("Ab-C9\x00é{z}İ A_B `x`")] == ["ab", "c9", "é", "z", "İ", "a", "b", "x"]
    assert R.words(None) == R.words(" \t.,") == []
    assert len(R.TABLE) == 256 and all(R.TABLE[b] in (b, b | 0x20, 0x20) for b in range(256))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50])
def test_chained_checksums(n):
    words = [f"wört{i}".encode() for i in range(n)]
    want = [zlib.crc32(b" ".join(words[i:i + k])) for k in (1, 2, 3) for i in range(n - k + 1)]
    assert sorted(R.checksums(words)) == sorted(want) and R.n_features(n) == len(want)


def test_noise_draws_in_proportion():
    """Two documents of weights 0 and 1000 ln 3: the heavier comes first three times in four."""
    heavy = math.floor(1000 * math.log(3))
    first = sum(heavy + R.noise(2 * i) > R.noise(2 * i + 1) for i in range(20_000))
    assert abs(Fraction(first, 20_000) - Fraction(3, 4)) < Fraction(1, 80)


def test_empty_tables(spark, no_docs, docs):
    target = table(spark, SF001, "benchmark")
    assert R.resampled(no_docs, target).count() == 0
    rows = R.resampled(docs, target.limit(0))
    assert rows.count() == docs.count() and rows.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_sample_keeps_columns(spark, tmp_path, docs):
    out = R.sample(docs, table(spark, SF001, "benchmark"), f"{tmp_path}/drawn")
    assert out.columns == docs.columns and 5 < out.count() < docs.count() // 10
