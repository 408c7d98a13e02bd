"""Operator 10: document classifier by co-training of two views.

One view sees the text (how often its words, and stems of 5 and 7 bytes, occur,
hashed), the other the page's metadata (language, source, size, line and
character shape). Each is a logistic model; a word's count is scaled by how much
more frequent documents with it are on one side, so that words that tell nothing
get no weight however many there are. Both are fitted to labelled documents; in every round each
view labels the unlabelled pool documents it is surest of, and these go to the
other view's training rows. Then each view is calibrated on labelled documents
held out from training, and the calibrated log-odds are added (less the prior
counted twice) to score all documents. Targets are ``quality`` and ``toxic``.

Fitted to at most MAX_LABELLED labelled documents, those of the smallest hash of
their id. The pool is every document without a label, whatever the corpus: in
each round all of them are scored in Spark, and for each target, view and sign
the PER_ROUND surest become training rows of the other view. Only features of
documents that are fitted come to the driver, never texts. All documents are
scored with the final models (a weight per hashed word, of fixed size) broadcast;
what is shuffled are ids and probabilities.

Defined cases: a null or empty text has no words; null language or source is a
value of its own; conflicting labels of one id are averaged and count by their
majority, ties as negative; a null label is no label; a target with rows of
one kind only, or none, gets that kind's smoothed share (0.5 without rows) as
every document's score; rows are scored one by one, whatever their ids. Of rows
of one id with different texts, that of the smallest hash is the one fitted.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import session, written

TARGETS = ("quality", "toxic")
MAX_LABELLED = 6000
BUCKET_BITS = 18
ROUNDS = 2
#: Documents of each sign that a view labels in a round, and how sure it has to be.
PER_ROUND, SURE = 150, (0.005, 0.98)
CHUNK = 1 << 19
#: Words in fewer training documents, or whose shares on the two sides differ by
#: fewer standard errors, get no weight.
MIN_DOCS, MIN_SURPRISE = 3, 2.0
PENALTY = 2e-3
STEMS = (5, 7)
SOURCE_BUCKETS, LANG_BUCKETS = 32, 16
_SHAPE = ("log_bytes", "lines", "symbols", "digits", "upper", "punctuation", "non_ascii", "word_bytes", "short_words")
META = len(_SHAPE) + SOURCE_BUCKETS + LANG_BUCKETS


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOLS, _PUNCTUATION = _table(b"#*$%&|<>{}[]\\^~_="), _table(b".,;:!?\"'()-")
_DIGITS, _UPPER, _NON_ASCII = _table(bytes(range(48, 58))), _table(bytes(range(65, 91))), _table(bytes(range(128, 256)))


def _name_bucket(column: pa.Array, buckets: int, salt: int) -> np.ndarray:
    data, offset = W.buffers(column.cast(pa.string()))
    return (W.mix(W.byte_hashes(data, offset[:-1], offset[1:]) + W.U(salt)) % W.U(buckets)).astype(np.int64)


def _stems(flat: W.Flat) -> np.ndarray:
    """(row, bucket) keys of the words and of the stems of longer words."""
    rows = len(flat.first) - 1
    row = flat.row().astype(np.int32 if rows < 1 << 31 - BUCKET_BITS else np.int64)
    return np.concatenate([row[own] << BUCKET_BITS | (found >> W.U(64 - BUCKET_BITS)).astype(row.dtype)
                           for own, found in W.prefix_hashes(flat.data, flat.start, flat.end, STEMS)])


def view_features(text: pa.Array, lang: pa.Array, source: pa.Array):
    """(low, high, row, bucket, times, meta) over pieces of a batch: the distinct
    hashed words and stems of each row with their counts, and its metadata."""
    lang_at, source_at = _name_bucket(lang, LANG_BUCKETS, 1), _name_bucket(source, SOURCE_BUCKETS, 2)
    for (low, high, flat), (_, _, raw) in zip(W.texts(text, W.ALNUM, fold=True, hashed=False), W.texts(text, hashed=False)):
        key, times = np.unique(_stems(flat), return_counts=True)
        size = np.diff(raw.offset)

        def share(table: np.ndarray, raw=raw, size=size) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(table[raw.data])])
            return np.diff(sums[raw.offset]) / np.maximum(size, 1)

        newline = share(_table(b"\n"))
        n_words = np.diff(raw.first)
        length = raw.end - raw.start
        shape = np.stack([np.log1p(size) / 5, np.minimum(newline * 20, 5), np.minimum(share(_SYMBOLS) * 20, 5), share(_DIGITS) * 5, share(_UPPER) * 5,
                          share(_PUNCTUATION) * 5, share(_NON_ASCII) * 3, np.minimum(W.per_row(raw, length) / np.maximum(n_words, 1) / 5, 5),
                          W.per_row(raw, (length < 3).astype(np.int64)) / np.maximum(n_words, 1)], 1)
        meta = np.zeros((high - low, META), np.float32)
        meta[:, :len(_SHAPE)] = shape
        rows = np.arange(high - low)
        meta[rows, len(_SHAPE) + source_at[low:high]] = 1
        meta[rows, len(_SHAPE) + SOURCE_BUCKETS + lang_at[low:high]] = 1
        yield low, high, key >> BUCKET_BITS, key & ((1 << BUCKET_BITS) - 1), times.astype(np.int32), meta


class Rows(NamedTuple):
    """Training rows: distinct words in flat form and dense metadata."""

    row: np.ndarray
    bucket: np.ndarray
    times: np.ndarray
    meta: np.ndarray


class View(NamedTuple):
    """A logistic model of one view, with its calibration."""

    weight: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(forward, backward, size: int, y: np.ndarray, sample: np.ndarray, penalty: float, steps: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch AdaGrad steps; ``sample`` weights rows."""
    w, b = np.zeros(size), float(np.log((sample @ y + 1) / (sample @ (1 - y) + 1)))
    g2, gb2 = np.full(size, 1e-8), 1e-8
    total = sample.sum()
    for _ in range(steps):
        error = sample * (_sigmoid(forward(w) + b) - y) / total
        g, gb = backward(error) + penalty * w, error.sum()
        g2 += g * g
        gb2 += gb * gb
        w -= 0.5 * g / np.sqrt(g2)
        b -= 0.5 * gb / np.sqrt(gb2)
    return w, float(b)


def _fit_words(rows: Rows, use: np.ndarray, y: np.ndarray, sample: np.ndarray) -> View:
    """``use``: numbers of the training rows, with their targets and weights."""
    place = np.full(len(rows.meta), -1, np.int32)
    place[use] = np.arange(len(use))
    parts = [slice(low, low + CHUNK) for low in range(0, len(rows.row), CHUNK)]  # bounds what is held beside the rows
    # documents with the word on either side, smoothed: log of the ratio of their shares
    with_, against = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for part in parts:
        row = place[rows.row[part]]
        for sums, side in ((with_, y * sample), (against, (1 - y) * sample)):
            sums += np.bincount(rows.bucket[part], np.where(row >= 0, side[row], 0.0), 1 << BUCKET_BITS)
    positive, negative = sample @ y, sample @ (1 - y)
    share = (with_ + against) / (positive + negative)
    spread = np.sqrt(share * (1 - share) * (1 / max(positive, 1) + 1 / max(negative, 1))) + 1e-12
    surprise = np.abs(with_ / max(positive, 1) - against / max(negative, 1)) / spread
    known = np.flatnonzero((with_ + against >= MIN_DOCS) & (surprise >= MIN_SURPRISE))
    ratio = np.log((with_[known] + 1) / (positive + 2)) - np.log((against[known] + 1) / (negative + 2))
    of = np.full(1 << BUCKET_BITS, -1, np.int32)
    of[known] = np.arange(len(known))
    told = [[np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0)]]
    for part in parts:
        row, column = place[rows.row[part]], of[rows.bucket[part]]
        own = (row >= 0) & (column >= 0)
        for out, values in zip(told, (row[own], column[own], _value(rows.times[part][own]) * ratio[column[own]])):
            out.append(values)
    row, column, value = (np.concatenate(x) for x in told)
    del told
    w, b = _fit(lambda w: np.bincount(row, w[column] * value, len(use)), lambda e: np.bincount(column, e[row] * value, len(known)),
                len(known), y, sample, PENALTY)
    weight = np.zeros(1 << BUCKET_BITS, np.float32)
    weight[known] = w * ratio
    return View(weight, b)


def _fit_meta(rows: Rows, use: np.ndarray, y: np.ndarray, sample: np.ndarray) -> View:
    x = rows.meta[use].astype(np.float64)
    w, b = _fit(lambda w: x @ w, lambda e: e @ x, META, y, sample, 1e-5, 400)
    return View(w.astype(np.float32), b)


def _value(times: np.ndarray) -> np.ndarray:
    return np.log2(1.0 + times)


def _words_score(view: View, row: np.ndarray, bucket: np.ndarray, times: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, view.weight[bucket] * _value(times), rows) + view.bias


def _calibrated(view: View, score: np.ndarray, y: np.ndarray) -> View:
    """Platt scaling on held-out scores, with smoothed targets."""
    up = (y.sum() + 1) / (y.sum() + 2) if y.sum() else 0.5
    down = 1 / (len(y) - y.sum() + 2)
    goal, x = np.where(y > 0, up, down), score / (score.std() + 1e-9)
    w, b = _fit(lambda w: x * w[0], lambda e: np.array([e @ x]), 1, goal, np.ones(len(y)), 1e-6, 400)
    return view._replace(scale=max(0.0, float(w[0])) / (score.std() + 1e-9), shift=b)


class Model(NamedTuple):
    prior: float
    words: View | None = None
    meta: View | None = None

    def score(self, row: np.ndarray, bucket: np.ndarray, times: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Probability for each row."""
        odds = np.full(len(meta), np.log(self.prior / (1 - self.prior)))
        if self.words is not None:
            views = ((self.words, _words_score(self.words, row, bucket, times, len(meta))), (self.meta, meta @ self.meta.weight + self.meta.bias))
            odds = sum(v.scale * s + v.shift for v, s in views) - odds
        return _sigmoid(odds)


def _prior(label: np.ndarray) -> float:
    known = label[~np.isnan(label)]
    return float((known.sum() + 1) / (len(known) + 2))


def _parts(label: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows to fit and rows to calibrate on (``fold`` 0); None if one of them has too few of a kind."""
    known = ~np.isnan(label)
    train, held = np.flatnonzero(known & (fold != 0)), np.flatnonzero(known & (fold == 0))
    if min(label[train].sum(), (1 - label[train]).sum(), label[held].sum(), (1 - label[held]).sum()) < 2:
        return None
    return train, held


def _views(rows: Rows, label: np.ndarray, train: np.ndarray, extra: list[dict[int, float]]) -> list[View]:
    """Both views, fitted to the training rows and the rows ``extra`` that the other view labelled."""
    views = []
    for fit, own in zip((_fit_words, _fit_meta), extra):
        more = np.array(sorted(own), np.int64)
        y = np.concatenate([label[train], [own[i] for i in more]])
        views.append(fit(rows, np.concatenate([train, more]), y, np.concatenate([np.ones(len(train)), np.full(len(own), 0.5)])))
    return views


def _view_scores(views: list[View], row: np.ndarray, bucket: np.ndarray, times: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
    return [_words_score(views[0], row, bucket, times, len(meta)), meta @ views[1].weight + views[1].bias]


def _model(rows: Rows, label: np.ndarray, held: np.ndarray, views: list[View]) -> Model:
    """Both views calibrated on the held-out rows."""
    found = _view_scores(views, rows.row, rows.bucket, rows.times, rows.meta)
    return Model(_prior(label), *(_calibrated(v, x[held], label[held]) for v, x in zip(views, found)))


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _concatenated(a: Rows, b: Rows) -> Rows:
    return Rows(np.concatenate([a.row, b.row + np.int32(len(a.meta))]), *(np.concatenate([x, y]) for x, y in zip(a[1:], b[1:])))


FEATURE = T.StructType([T.StructField("words", T.BinaryType()), T.StructField("times", T.BinaryType()), T.StructField("meta", T.BinaryType())])


@F.arrow_udf(returnType=FEATURE)
def features(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Array:
    words, counts, metas = [], [], []
    for low, high, row, bucket, times, meta in view_features(text, lang, source):
        cut = np.searchsorted(row, np.arange(high - low + 1))
        words += [_binary(bucket[a:b].astype(np.int32)) for a, b in zip(cut[:-1], cut[1:])]
        counts += [_binary(times[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        metas += [_binary(m) for m in meta]
    return pa.StructArray.from_arrays([pa.array(x, pa.binary()) for x in (words, counts, metas)], names=["words", "times", "meta"])


def _version() -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64("text", "lang", "source")


def _collected(docs: DataFrame, wanted: DataFrame, most: int) -> tuple[Rows, pa.Table]:
    """Features of the wanted documents (doc_id and other columns), at most ``most``, by id."""
    own = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(wanted), "doc_id")  # at most ``most`` rows of numbers
    names = wanted.columns
    one = own.groupBy(*names).agg(F.min(F.struct(_version().alias("v"), "text", "lang", "source")).alias("d"))
    got = one.select(*names, features("d.text", "d.lang", "d.source").alias("f")).select(*names, "f.*").limit(most).orderBy("doc_id").toArrow()
    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(W.buffers(got.column(name))[0].tobytes(), kind)

    lengths = pc.binary_length(got.column("words")).to_numpy() // 4
    rows = Rows(np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), joined("words", np.int32), joined("times", np.int32),
                joined("meta", np.float32).reshape(-1, META))
    got = got.drop_columns(["words", "times", "meta"])
    pa.default_memory_pool().release_unused()
    return rows, got


def _labelled(docs: DataFrame, labels: DataFrame, targets: tuple[str, ...], max_labelled: int) -> tuple[Rows, dict[str, np.ndarray], np.ndarray, list[int]]:
    """Features, labels, folds and ids of the bounded sample of labelled documents."""
    by_id = labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.avg(F.col(t).cast("double")).alias(t) for t in targets])
    ids = docs.select("doc_id").filter("doc_id is not null")
    order = F.xxhash64("doc_id", F.lit(20240229))
    sample = by_id.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(max_labelled).select("doc_id", *targets)  # the documented bound
    rows, got = _collected(docs, sample, max_labelled)
    label = {t: np.array([np.nan if v is None else float(v > 0.5) for v in got.column(t).to_pylist()]) for t in targets}
    doc = got.column("doc_id").to_pylist()
    return rows, label, W.mix(np.array(doc, np.int64).view(W.U)) % W.U(5), doc


def _surest(docs: DataFrame, labels: DataFrame, views: dict[str, list[View]], taken: dict[tuple[str, int], set[int]], per_round: int) -> DataFrame:
    """(target, view, sign, doc_id) of the unlabelled documents that each view is surest of, over all documents.

    ``taken``: ids that already are training rows of a target's view."""
    shared = docs.sparkSession.sparkContext.broadcast(views)  # a float per hashed word, target and view
    kind = T.StructType([T.StructField(f"{t}_{v}", T.DoubleType(), False) for t in views for v in (0, 1)])

    @F.arrow_udf(returnType=kind)
    def sure(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Array:
        out: list[list[np.ndarray]] = [[] for _ in kind.fields]
        for _, _, row, bucket, times, meta in view_features(text, lang, source):
            found = [x for own in shared.value.values() for x in _view_scores(own, row, bucket, times, meta)]
            for part, x in zip(out, found):
                part.append(_sigmoid(x))
        return pa.StructArray.from_arrays([pa.array(np.concatenate([*part, np.zeros(0)])) for part in out], names=kind.fieldNames())

    scored = docs.filter("doc_id is not null").select("doc_id", sure("text", "lang", "source").alias("p"), _version().alias("v")).select("doc_id", "v", "p.*")
    scored = scored.filter(" or ".join(f"{c} >= {SURE[1]} or {c} <= {SURE[0]}" for c in kind.fieldNames()))
    own = scored.groupBy("doc_id").agg(F.min(F.struct("v", *kind.fieldNames())).alias("p")).select("doc_id", "p.*")
    known = labels.select("doc_id").filter("doc_id is not null").distinct()
    pool = written(own.join(known, "doc_id", "left_anti"), "pool")
    out = None
    for t in views:
        for view in (0, 1):
            p = F.col(f"{t}_{view}")
            free = pool.filter(~F.col("doc_id").isin(sorted(taken[t, 1 - view]))) if taken[t, 1 - view] else pool
            for sign, rows, order in ((1.0, free.filter(p >= SURE[1]), p.desc()), (0.0, free.filter(p <= SURE[0]), p.asc())):
                top = rows.orderBy(order, "doc_id").limit(per_round).select(F.lit(t).alias("target"), F.lit(view).alias("view"), F.lit(sign).alias("sign"), "doc_id")
                out = top if out is None else out.unionByName(top)
    return out


def fitted(docs: DataFrame, labels: DataFrame, targets: tuple[str, ...] = TARGETS, max_labelled: int = MAX_LABELLED,
           per_round: int = PER_ROUND, rounds: int = ROUNDS) -> list[Model]:
    """A model for each target, co-trained over all documents."""
    spark = session(docs)
    rows, label, fold, doc = _labelled(docs, labels, targets, max_labelled)
    place = {d: i for i, d in enumerate(doc)}
    parts = {t: _parts(label[t], fold) for t in targets}
    able = [t for t in targets if parts[t] is not None]
    extra: dict[str, list[dict[int, float]]] = {t: [{}, {}] for t in able}
    views = {t: _views(rows, label[t], parts[t][0], extra[t]) for t in able}
    for _ in range(rounds if able else 0):
        taken = {(t, v): {doc[i] for i in extra[t][v]} for t in able for v in (0, 1)}
        found = _surest(docs, labels, views, taken, per_round).collect()  # per_round rows a target, view and sign
        new = sorted({r["doc_id"] for r in found} - place.keys())
        if new:
            more, got = _collected(docs, spark.createDataFrame([(d,) for d in new], "doc_id long"), len(new))
            for d in got.column("doc_id").to_pylist():
                place[d] = len(doc)
                doc.append(d)
            rows = _concatenated(rows, more)
        for r in found:
            extra[r["target"]][1 - r["view"]].setdefault(place[r["doc_id"]], r["sign"])
        views = {t: _views(rows, label[t], parts[t][0], extra[t]) for t in able}
    return [_model(rows, label[t], parts[t][1], views[t]) if t in able else Model(_prior(label[t])) for t in targets]


def scores(docs: DataFrame, models: list[Model], targets: tuple[str, ...] = TARGETS) -> Column:
    """Column of the struct of all targets' probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # one float per hashed word and target

    @F.arrow_udf(returnType=T.StructType([T.StructField(t, T.DoubleType(), False) for t in targets]))
    def score(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Array:
        out = [[] for _ in targets]
        for _, _, row, bucket, times, meta in view_features(text, lang, source):
            for part, model in zip(out, shared.value):
                part.append(model.score(row, bucket, times, meta))
        return pa.StructArray.from_arrays([pa.array(np.concatenate([*part, np.zeros(0)])) for part in out], names=list(targets))

    return score("text", "lang", "source")


def classified(docs: DataFrame, labels: DataFrame, max_toxic: float = 0.4, min_quality: float = 0.3) -> DataFrame:
    """doc_id, quality, toxic (probabilities) and kept of every document."""
    models = fitted(docs, labels)
    out = docs.select("doc_id", scores(docs, models).alias("p")).select("doc_id", "p.*")
    return out.withColumn("kept", (F.col("toxic") < max_toxic) & (F.col("quality") >= min_quality))
