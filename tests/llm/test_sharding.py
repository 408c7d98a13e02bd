import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from quillstream.llm import sharding as S
from quillstream.llm.common import table, written
from tests.llm.conftest import SF001, rows_of


def whole_matrix(before, cells, seed):
    """All rows of the matrix at once, range by range."""
    out = np.zeros((len(before) - 1, len(cells)), np.int64)

    def fill(low, high, columns):
        if high - low == 1:
            out[low] = columns
            return
        middle = (low + high) // 2
        left = S.split(np.random.default_rng([seed, 0, low, high]), columns, int(before[middle] - before[low]))
        fill(low, middle, left)
        fill(middle, high, columns - left)

    fill(0, len(before) - 1, cells)
    return out


def test_matrix_rows_and_margins():
    sizes = np.array([5, 0, 17, 1, 40, 3, 3])
    before = np.concatenate([[0], np.cumsum(sizes)])
    cells = S.even_sizes(int(sizes.sum()), 9)
    matrix = whole_matrix(before, cells, 3)
    assert (matrix == [S.matrix_row(before, cells, b, 3) for b in range(len(sizes))]).all()
    assert (matrix.sum(1) == sizes).all() and (matrix.sum(0) == cells).all()
    assert Counter(S.block_cells(before, cells, 4, 3).tolist()) == Counter({c: n for c, n in enumerate(matrix[4].tolist()) if n})


def test_every_arrangement_is_equally_likely():
    """Four rows in blocks of 1 and 3, two cells of 2: each of six sets of rows in the first cell a sixth of the time."""
    before, cells = np.array([0, 1, 4]), np.array([2, 2])
    seen = Counter()
    for seed in range(6000):
        cell = np.concatenate([S.block_cells(before, cells, b, seed) for b in (0, 1)])
        seen[tuple(np.flatnonzero(cell == 0).tolist())] += 1
    assert len(seen) == 6 and all(abs(n - 1000) < 150 for n in seen.values())


def test_draws_from_large_populations(monkeypatch):
    """The own draw follows numpy's law, and holds beyond numpy's limit."""
    monkeypatch.setattr(S, "SMALL", 0)
    rng = np.random.default_rng(1)
    for good, bad, drawn in ((30, 70, 20), (3, 5, 7), (1000, 10, 500), (0, 9, 4), (9, 0, 4), (5, 5, 0)):
        own = np.array([S.hypergeometric(rng, good, bad, drawn) for _ in range(3000)])
        mean = drawn * good / (good + bad)
        var = mean * (bad / (good + bad)) * (good + bad - drawn) / max(1, good + bad - 1)
        assert own.min() >= max(0, drawn - bad) and own.max() <= min(good, drawn)
        assert abs(own.mean() - mean) <= 5 * math.sqrt(var / 3000) + 1e-9 and abs(own.var() - var) <= 0.15 * var + 1e-9
    big = np.full(50, 10**9, np.int64)
    part = S.split(rng, big, 25 * 10**9)
    assert part.sum() == 25 * 10**9 and abs(part - 5 * 10**8).max() < 10 * 2 * 10**4


def report_of(docs):
    return [(r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in S.shard_report(docs).collect()]


def check_law(got, rows):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter(r[:3] for r in got) == want and {r[3] for r in got} <= {"rows"} and all(r[6] is None for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r[4], []).append(r[5])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert set(slots) <= set(range(24)) and max(sizes) - min(sizes) <= 1


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 16)


def test_report_equals_brute_force(spark, small_blocks, tmp_path, docs, texts):
    """The same draws over plain lists: files in the order of their hash, blocks, cells, then slots by key."""
    path = f"{tmp_path}/docs"
    docs.repartition(5).write.parquet(path)
    stored = spark.read.parquet(path)
    got = report_of(stored)
    check_law(got, texts)
    files = stored.selectExpr("_metadata.file_path AS p", "xxhash64(_metadata.file_path) AS h").distinct().collect()
    tables = {r.h: pq.read_table(r.p.removeprefix("file:").replace("//", "/")).to_pylist() for r in files}
    order = sorted(tables)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard, first, size = S.cell_sizes(len(texts), 24, tasks)
    blocks = [(h, at, min(16, len(tables[h]) - at)) for h in order for at in range(0, len(tables[h]), 16)]
    matrix = whole_matrix(np.concatenate([[0], np.cumsum([n for *_, n in blocks])]), size, S.SEED)
    cells = {}
    for b, (h, at, n) in enumerate(blocks):
        dealt = np.random.default_rng([S.SEED, 1, b]).permutation(np.repeat(np.arange(len(size)), matrix[b])).tolist()
        assert len(dealt) == n
        for i, c in enumerate(dealt):
            cells.setdefault(c, []).append((h, at + i))
    keys = spark.createDataFrame([(c, h, i) for c, rows in cells.items() for h, i in rows], "c int, h long, i long")
    placed = keys.selectExpr("c", "h", "i", f"xxhash64({S.SEED}, c, h, i) AS k").collect()
    want = []
    for c in cells:
        for n, r in enumerate(sorted((x for x in placed if x.c == c), key=lambda x: (x.k, x.h, x.i))):
            want.append((tables[r.h][r.i]["doc_id"], int(shard[c]), int(first[c]) + n))
    assert sorted(((r[0], r[4], r[5]) for r in got), key=repr) == sorted(want, key=repr)


def test_same_result_for_other_splits(spark, small_blocks, tmp_path):
    docs = table(spark, SF001, "documents")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    first = rows_of(S.shard_report(docs))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        assert rows_of(S.shard_report(docs)) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_odd_tables(spark, tmp_path, no_docs):
    assert S.shard_report(written(no_docs, "no-docs")).count() == 0
    rows = [(1, "same text")] * 50 + [(None, None), (2, ""), (3, "x" * 300_000)]
    check_law(report_of(written(spark.createDataFrame(rows, "doc_id long, text string"), "odd")), rows)
    few = rows[-3:]
    check_law(report_of(written(spark.createDataFrame(few, "doc_id long, text string"), "few")), few)


def test_rows_of_any_source_keep_their_columns(spark, tmp_path, docs):
    S.shuffle(docs.filter("doc_id % 2 = 0"), f"{tmp_path}/out", shards=5, seed=2)
    back = S.read_shards(spark, f"{tmp_path}/out", docs.schema)
    assert rows_of(back.select("row.*")) == rows_of(docs.filter("doc_id % 2 = 0"))
    counts = sorted(r["count"] for r in back.groupBy("shard").count().collect())
    assert len(counts) == 5 and counts[-1] - counts[0] <= 1


def test_copies_are_spread(spark):
    """A group of 600 copies among 900 rows: each of 24 shards holds about 25 of them."""
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(900)]
    stored = written(spark.createDataFrame(rows, "doc_id long, text string"), "copies")
    sizes = Counter(r.shard for r in S.shard_report(stored).collect() if r["size"] == 12)
    assert len(sizes) == 24 and sum(sizes.values()) == 600 and all(12 <= n <= 36 for n in sizes.values())
