"""Operator 13: importance resampling towards a target distribution, by hashed n-grams.

A text's UTF-8 bytes go through one 256-byte table that lower-cases A-Z and
blanks every separator; ``bytes.split`` then yields the words. The features are
all runs of one to three words; the checksum of a longer run continues that of
the shorter one, as zlib.crc32 takes it as its seed. Counters reduce a batch's
checksums to counts per bucket.

Buckets are counted over all documents and over all target texts: a task emits
at most BUCKETS rows, whatever its input. The gains of the buckets (BUCKETS
numbers) are all that comes to the driver and is broadcast. A second reading of
the texts sums the gains of each document's features, and Gumbel noise from the
id makes the top scores a draw without replacement.

The draw is ranked by a range partitioning of (score, id) rows and the counts of
its parts, not in one task; nothing of a text is shuffled.

Defined cases: a null or empty text has no features and weight 0; a null id has
the noise of the empty string and comes before other ids of its score; repeated
rows count and are ranked once each; an empty target or table gives gains of the
smoothing alone, or no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import session, shared, written

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: checksums that a counter holds before they are reduced to buckets
HELD = 1 << 20

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: lower-cases A-Z, then blanks every byte that belongs to no word
TABLE = bytes(c if (c := b | 0x20 if 0x41 <= b <= 0x5A else b) in _WORD else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def checksums(found: list[bytes]) -> Iterator[int]:
    """Unsigned crc32 of every run of one to three words, joined by one space."""
    tails = [b" " + w for w in found[1:]]
    one = [crc32(w) for w in found]
    two = list(map(crc32, tails, one))
    return chain(one, two, map(crc32, tails[1:], two))


def n_features(n: int) -> int:
    return n + max(n - 1, 0) + max(n - 2, 0)


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n) over all features of all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        held: Counter[int] = Counter()

        def fold() -> None:
            np.add.at(sums, np.fromiter(held.keys(), np.int64, len(held)) % BUCKETS, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.update(checksums(words(value)))
                if len(held) > HELD:
                    fold()
        fold()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["bucket", "n"])

    rows = texts.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share of each bucket, smoothed by one, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of Gumbel noise that the id fixes, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all buckets; BUCKETS rows at most come to the driver."""
    out = np.zeros(BUCKETS, np.int64)
    for row in bucket_counts(texts, text).collect():
        out[row["bucket"]] = row["n"]
    return out


SCORED = T.StructType([T.StructField(name, T.LongType(), False) for name in ("n_words", "n_features", "weight", "score")])


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(gain.tolist())  # BUCKETS numbers

    @F.arrow_udf(returnType=SCORED)
    def score(ids: pa.Array, column: pa.Array) -> pa.Array:
        of = held.value
        out: list[tuple[int, int, int, int]] = []
        for doc, value in zip(ids.to_pylist(), column.to_pylist()):
            found = words(value)
            weight = sum(n * of[c % BUCKETS] for c, n in Counter(checksums(found)).items())
            out.append((len(found), n_features(len(found)), weight, weight + noise(doc, seed)))
        columns = list(zip(*out)) or [()] * len(SCORED.fields)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=SCORED.fieldNames())

    return docs.select("doc_id", score(F.col("doc_id").cast("long"), F.col(text)).alias("s")).select("doc_id", "s.*")


def ranked(rows: DataFrame, draw: int) -> DataFrame:
    """``rows`` with ``rank``: 1 to ``draw`` by falling score, then rising id; null beyond.

    Rows are dealt by ranges of (score, id), each part is written in its order,
    and a row's rank is its place in its file after the rows of the files before."""
    spark = rows.sparkSession
    source = written(rows, "scored")
    keyed = source.select("*", F.col("_metadata.file_path").alias("__from"), F.col("_metadata.row_index").alias("__row"))
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("__from"), F.col("__row")]  # equal rows are spread, too
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared(spark, "ranked")
    keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__from", "__row").write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(source.schema).parquet(path).select(
        "*", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("__part"), F.col("_metadata.row_index").alias("__at"))
    counts = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    # one row per file; the running sum is over files, not documents
    before = counts.select(F.col("__part").alias("p"), (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("__at") + 1
    return (stored.join(F.broadcast(before), F.col("__part") == F.col("p"))
            .select(*[F.col(f"`{c}`") for c in source.columns], F.when(rank <= draw, rank).alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; ``percent`` of
    the documents with ``least_words`` words are drawn."""
    session(docs)
    gain = gains(_counts(docs), _counts(target))
    rows = written(scored(docs, gain, seed), "weighted")
    enough = F.col("n_words") >= least_words
    draw = percent * rows.filter(enough).count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(rows.filter(enough).select(*names), draw)
    return drawn.unionByName(rows.filter(~enough).select(*names, F.lit(None).cast("long").alias("rank")))


def sample(docs: DataFrame, target: DataFrame, path: str, **options) -> DataFrame:
    """The drawn documents, all columns as they were and in any order, written to
    ``path``; one row per drawn id and row of that id."""
    drawn = resampled(docs, target, **options).filter("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    (docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["__drawn"]), "left_semi").write.option("compression", "zstd").parquet(path))
    return docs.sparkSession.read.schema(docs.schema).parquet(path)

