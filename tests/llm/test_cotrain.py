import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillstream.llm import cotrain as C
from quillstream.llm import words as W


def planted(n, seed, labelled=True):
    """Toxic pages hold two insults of a list, poor ones are symbol junk; words are shared."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(40, 200))]
        toxic, poor = rng.random() < 0.2, rng.random() < 0.25
        if toxic:
            for x in rng.integers(0, 8, 3):
                words[rng.integers(len(words))] = f"insult{x}"
        if poor:
            words = [w + "%%%" if rng.random() < 0.8 else w for w in words]
        doc = seed * 100_000 + i
        rows.append((doc, " ".join(words), "en", f"src{rng.integers(5)}"))
        labels.append((doc, int(not poor), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = planted(700, 1)
    test_rows, test_labels = planted(300, 2)
    docs = spark.createDataFrame(rows + test_rows, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in C.classified(docs, known).collect()}
    toxic = np.array([[got[i].toxic >= 0.4, t] for i, _, t in test_labels], bool)
    assert (toxic[:, 0] == toxic[:, 1]).mean() > 0.95
    clean = [got[i].kept for i, q, t in test_labels if q and not t]
    assert np.mean(clean) > 0.97
    assert np.mean([not got[i].kept for i, _, t in test_labels if t]) > 0.9


def brute_models(rows, labels, per_round, rounds=C.ROUNDS):
    """Co-training in memory: every document's features at once, every unlabelled one in the pool."""
    text, lang, source = (pa.array([r[i] for r in rows]) for i in (1, 2, 3))
    parts = []
    for a, b, row, bucket, times, meta in C.view_features(text, lang, source):
        parts.append(C.Rows(row, bucket, times, meta))
    every = parts[0]
    for part in parts[1:]:
        every = C._concatenated(every, part)
    doc = [r[0] for r in rows]
    known = {d: (q, t) for d, q, t in labels}
    fold = W.mix(np.array(doc, np.int64).view(np.uint64)) % np.uint64(5)
    models = []
    for n in (0, 1):
        label = np.array([np.nan if d not in known else float(known[d][n]) for d in doc])
        train, held = C._parts(label, fold)
        extra = [{}, {}]
        for round_ in range(rounds + 1):
            views = C._views(every, label, train, extra)
            if round_ == rounds:
                break
            scores, before = C._view_scores(views, *every), [dict(e) for e in extra]
            for view in (0, 1):
                p = C._sigmoid(scores[view])
                for sign in (1.0, 0.0):
                    sure = [i for i in range(len(doc)) if doc[i] not in known and (p[i] >= C.SURE[1] if sign else p[i] <= C.SURE[0]) and i not in before[1 - view]]
                    for i in sorted(sure, key=lambda i: (-p[i] if sign else p[i], doc[i]))[:per_round]:
                        extra[1 - view].setdefault(i, sign)
        models.append((C._model(every, label, held, views), extra))
    return models


def test_models_equal_brute_force(spark):
    """The co-trained models are those of an in-memory co-training over all rows, pool documents far apart included."""
    rows, labels = planted(500, 5)
    more, _ = planted(900, 6)
    docs = spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string").repartition(7)
    known = spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int")
    got = C.fitted(docs, known, per_round=25)
    for model, (want, extra) in zip(got, brute_models(rows + more, labels[:300], 25)):
        assert sum(map(len, extra)) > 60      # the exchange took place, over the whole pool
        assert max(i for e in extra for i in e) > 700
        assert np.allclose(model.words.weight, want.words.weight, atol=1e-6) and np.allclose(model.meta.weight, want.meta.weight, atol=1e-6)
        assert np.allclose([*model.words[1:], *model.meta[1:]], [*want.words[1:], *want.meta[1:]], atol=1e-6)


def test_counts_are_not_clipped():
    for _, _, row, bucket, times, _ in C.view_features(pa.array(["spam " * 5000]), pa.array(["en"]), pa.array(["s"])):
        assert times.tolist() == [5000]


def test_repeated_ids_have_one_text(spark):
    """Of several texts of one id the same one is fitted in any order of the rows."""
    rows, labels = planted(260, 7)
    twice = rows + [(d, "other text of it " * 30, "de", "src9") for d, *_ in rows[:80]]
    known = spark.createDataFrame(labels[:150], "doc_id long, quality int, toxic int")
    frame = lambda r, n: spark.createDataFrame(r, "doc_id long, text string, lang string, source string").repartition(n)
    a, b = (C.fitted(d, known) for d in (frame(twice, 3), frame(twice[::-1], 5)))
    assert all(np.array_equal(x.words.weight, y.words.weight) and np.array_equal(x.meta.weight, y.meta.weight) for x, y in zip(a, b))


def test_edge_rows_and_missing_labels(spark, docs, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 1), (1, None, None), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    out = C.classified(docs, labels.unionByName(odd.select(F.col("doc_id"), F.col("quality").cast("int"), F.col("toxic").cast("int"))))
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.quality <= 1 and 0 <= r.toxic <= 1 for r in rows)
    alone = C.classified(docs, labels.limit(0)).collect()
    assert len(alone) == len(rows) and {r.quality for r in alone} == {0.5}
    assert C.classified(no_docs, labels).count() == 0


def test_sample_is_bounded(spark):
    rows, labels = planted(300, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame(labels[:200], "doc_id long, quality int, toxic int")
    own, label, _, doc = C._labelled(docs, known, C.TARGETS, 50)
    assert len(doc) == len(label["toxic"]) == len(own.meta) == 50 and not np.isnan(label["toxic"]).any()
