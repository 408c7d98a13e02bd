"""Operator 7: near duplicates with HyperMinHash registers.

A document's set holds its distinct 5-word shingles. Each shingle falls into
one of 96 buckets; of the smallest hash in a bucket only the position of its
leading one and ten mantissa bits are kept (two bytes). Bands of three
registers propose pairs, the collision-corrected Jaccard estimate from the
registers drops hopeless ones, and full sets of whole texts confirm the rest.

Rows per group stay linear. Equal sets are one node. In a band's bucket every
member is compared with the smallest one only; where that leaves several
components in a bucket, the members outside its largest component are compared
with the others inside tasks, in blocks of bounded size: by registers first,
then on full sets. Only links that join components leave a task. Large buckets
of unlinked documents (a shared passage) are first split by rare shingles: with
shingles in one order, the rarest first, two linked sets share one of those that
a set can miss and one more, whatever their length. A pair of similarity
0.75 shares no band with probability below 1e-7 if the texts are long, and about
1.5e-5 for sets of three or four shingles, which fill few registers.

Defined cases: null or empty texts have an empty set, no links and stay; rows
with equal ids are one document and stay together; a row without id has no
links, no component and stays; ties have no order, as components are sets;
empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm import words as W
from quillstream.llm.common import session, written
from quillstream.llm.components import components

SHINGLE = 5
BANDS, BAND_ROWS = 32, 3
REGISTERS = BANDS * BAND_ROWS
MANTISSA = 10
EMPTY = 0xFFFF
#: Link where PERCENT_OF * intersection >= PERCENT * union.
PERCENT, PERCENT_OF = 75, 100
#: Unlinked members of a bucket above which rare shingles split it; members and
#: shingles on a side of a block, which one task holds.
LARGE_BUCKET, BLOCK_SHINGLES = 4096, 4 << 20
#: Standard errors below the threshold at which an estimate rules a pair out.
SLACK = 5.5


def shingles(flat: W.Flat) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered by both; a row
    of fewer words than SHINGLE has its whole sequence as one."""
    at, key = W.windows(flat, SHINGLE)
    count = np.diff(flat.first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    row = np.concatenate([flat.row()[at], short])
    key = np.concatenate([key, W.span_hashes(flat.hash, flat.first[short], flat.first[short + 1])])
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


def registers(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """Compressed minima: bit length (six bits) and mantissa of each bucket's smallest hash."""
    bucket = ((key >> W.U(32)) * W.U(REGISTERS)) >> W.U(32)
    value = W.mix(key + W.U(0x632BE59BD9B4E019)) >> W.U(11)  # 53 bits, exact as a float
    length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    shift = length - 1 - MANTISSA
    v = value.astype(np.int64)
    part = np.where(shift >= 0, v >> np.maximum(shift, 0), v << np.maximum(-shift, 0)) & ((1 << MANTISSA) - 1)
    out = np.full(rows * REGISTERS, EMPTY, np.uint16)
    np.minimum.at(out, row * REGISTERS + bucket.astype(np.int64), (length << MANTISSA | part).astype(np.uint16))
    return out.reshape(rows, REGISTERS)


SIGNATURE = T.StructType([T.StructField("n_shingles", T.LongType(), False), T.StructField("k1", T.LongType(), False),
                          T.StructField("k2", T.LongType(), False), T.StructField("regs", T.BinaryType(), False)])


@F.arrow_udf(returnType=SIGNATURE)
def signature(text: pa.Array) -> pa.Array:
    """Set size, 128-bit set key and registers of each whole text."""
    size, k1, k2, regs = [], [], [], []
    for low, high, flat in W.texts(text, fold=True):
        row, key = shingles(flat)
        first = np.searchsorted(row, np.arange(high - low + 1))
        size.append(np.diff(first))
        for out, salt in ((k1, 0x2545F4914F6CDD1D), (k2, 0x9FB21C651E98DF25)):
            sums = np.zeros(len(key) + 1, W.U)
            np.cumsum(W.mix(key ^ W.U(salt)), out=sums[1:])
            out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
        regs.append(registers(row, key, high - low).view(np.uint8).reshape(high - low, -1))
    if not size:
        return pa.array([], pa.struct([("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("regs", pa.binary())]))
    flat_regs = np.concatenate(regs)
    offsets = pa.py_buffer((np.arange(len(flat_regs) + 1) * 2 * REGISTERS).astype(np.int32))
    binary = pa.Array.from_buffers(pa.binary(), len(flat_regs), [None, offsets, pa.py_buffer(np.ascontiguousarray(flat_regs))])
    return pa.StructArray.from_arrays([pa.array(np.concatenate(size)), pa.array(np.concatenate(k1)), pa.array(np.concatenate(k2)), binary],
                                      names=SIGNATURE.fieldNames())


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = W.buffers(column)
    return np.ascontiguousarray(data).view(np.uint16).reshape(-1, REGISTERS)


def promising(equal: np.ndarray, used: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether pairs can be links: their sizes allow it, and the Jaccard estimate,
    corrected for chance collisions of compressed registers, is not far below."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    ratio = large / np.maximum(small, 1)
    chance = 0.169919487159739 * REGISTERS * (4 * ratio / (1 + ratio) ** 2) / (1 << MANTISSA)
    used = np.maximum(used, 1)
    estimate = np.maximum(0, equal - np.minimum(chance, equal)) / used
    level = PERCENT / PERCENT_OF
    return (PERCENT_OF * small >= PERCENT * large) & (estimate + SLACK * np.sqrt(level * (1 - level) / used) >= level)


@F.arrow_udf(returnType=T.DoubleType())
def agreement(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
    """Share of equal registers of a promising pair, null for others."""
    if not len(a):
        return pa.array([], pa.float64())
    x, y = _matrix(a), _matrix(b)
    used = ((x != EMPTY) | (y != EMPTY)).sum(1)
    equal = ((x == y) & (x != EMPTY)).sum(1)
    ok = promising(equal, used, na.to_numpy(zero_copy_only=False), nb.to_numpy(zero_copy_only=False))
    return pa.array(equal / np.maximum(used, 1), mask=~ok)


@F.arrow_udf(returnType=T.BooleanType())
def linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact test on the full sets of two whole texts."""
    both = pa.concat_arrays([x.cast(pa.large_string()).fill_null("") for pair in zip(_each(a), _each(b)) for x in pair]) if len(a) else a
    sets = []
    for low, high, flat in W.texts(both, fold=True):
        row, key = shingles(flat)
        first = np.searchsorted(row, np.arange(high - low + 1))
        sets += [key[i:j] for i, j in zip(first[:-1], first[1:])]
    out = []
    for x, y in zip(sets[0::2], sets[1::2]):
        shared = len(np.intersect1d(x, y, assume_unique=True))
        out.append(shared > 0 and PERCENT_OF * shared >= PERCENT * (len(x) + len(y) - shared))
    return pa.array(out, pa.bool_())


@F.arrow_udf(returnType=T.ArrayType(T.LongType(), False))
def shingle_keys(text: pa.Array) -> pa.Array:
    """The distinct shingles of each whole text."""
    keys, size = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for low, high, flat in W.texts(text, fold=True):
        row, key = shingles(flat)
        keys.append(key.view(np.int64))
        size.append(np.bincount(row, minlength=high - low))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(size)).astype(np.int32)), pa.array(np.concatenate(keys)))


def _each(column: pa.Array) -> list[pa.Array]:
    return [column.slice(i, 1) for i in range(len(column))]


def band_keys(nodes: DataFrame) -> DataFrame:
    """(node, band, key) for every band of a node that holds a register."""
    width = 2 * BAND_ROWS
    part = lambda b: F.expr(f"substring(regs, 1 + {width} * {b}, {width})")
    return (nodes.select("node", "regs", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
            .withColumn("part", part("band")).filter(F.col("part") != F.lit(b"\xff" * width))
            .select("node", "band", F.xxhash64("band", "part").alias("key")))


def _with_signatures(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that can be links, with their estimate."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("regs").alias(f"r{s}"), F.col("n_shingles").alias(f"n{s}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b")
    return known.select("a", "b", agreement("ra", "rb", "na", "nb").alias("estimate")).filter("estimate is not null")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"t{s}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").filter(linked("ta", "tb")).select("a", "b")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far."""
    side = lambda s: found.select(F.col("node").alias(s), F.col("component").alias(f"c{s}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def _promising_pairs(x: np.ndarray, y: np.ndarray, na: np.ndarray, nb: np.ndarray, ca: np.ndarray, cb: np.ndarray):
    """(row of x, row of y, estimate) of the promising pairs of different components."""
    equal, used = np.zeros((len(x), len(y)), np.uint8), np.zeros((len(x), len(y)), np.uint8)
    if x.shape[0] * y.shape[0] <= 1 << 14:
        full = (x != EMPTY)[:, None, :] | (y != EMPTY)[None, :, :]
        used[:] = full.sum(2)
        equal[:] = ((x[:, None, :] == y[None, :, :]) & full).sum(2)
    else:
        for r in range(REGISTERS):
            p, q = x[:, r, None], y[None, :, r]
            equal += (p == q) & (p != EMPTY)
            used += (p != EMPTY) | (q != EMPTY)
    ok = promising(equal.astype(np.int64), used.astype(np.int64), na[:, None], nb[None, :]) & (ca[:, None] != cb[None, :])
    i, j = np.nonzero(ok)
    return i, j, equal[i, j] / np.maximum(used[i, j], 1)


#: Roles of a row in a block: compared with all (A), met by those of role A (B), or both.
ROLE_A, ROLE_B, ROLE_BOTH = 1, 2, 3


def _links_of_block(block: pa.Table) -> Iterator[tuple[int, int]]:
    """Links that join components of one block: pairs of different components
    that the registers allow, tested on their full sets, one per component pair."""
    role, node, comp, size = (block.column(c).to_numpy() for c in ("role", "node", "comp", "n_shingles"))
    regs = _matrix(block.column("regs").combine_chunks())
    a, b = np.flatnonzero(role & ROLE_A), np.flatnonzero(role & ROLE_B)
    sets, first = [], [np.zeros(1, np.int64)]
    for low, high, flat in W.texts(block.column("text"), fold=True):
        row, key = shingles(flat)
        sets.append(key)
        first.append(np.searchsorted(row, np.arange(1, high - low + 1)) + first[-1][-1])
    first = np.concatenate(first)
    distinct, number = np.unique(np.concatenate(sets), return_inverse=True)
    here = np.zeros(len(distinct), bool)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for low in range(0, len(a), 256):
        own = a[low:low + 256]
        i, j, _ = _promising_pairs(regs[own], regs[b], size[own], size[b], comp[own], comp[b])
        for at in np.unique(i):
            x, others = own[at], b[j[i == at]]
            here[number[first[x]:first[x + 1]]] = True
            length = first[others + 1] - first[others]
            places = np.repeat(first[others] - np.cumsum(length) + length, length) + np.arange(length.sum())
            shared = np.add.reduceat(here[number[places]].astype(np.int64), np.cumsum(length) - length)
            here[number[first[x]:first[x + 1]]] = False
            for y in others[PERCENT_OF * shared >= PERCENT * (first[x + 1] - first[x] + length - shared)].tolist():
                p, q = find(int(comp[x])), find(int(comp[y]))
                if p != q:
                    root[p] = q
                    yield int(node[x]), int(node[y])


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each block, from rows ordered by block."""
    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = list(_links_of_block(pa.Table.from_batches(parts).combine_chunks()))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    held: list[pa.RecordBatch] = []
    now = None
    for batch in rows:
        key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("top", "i", "j")], 1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)] if len(key) else [0]
        for low, high in zip(cuts[:-1], cuts[1:]):
            this = tuple(key[low])
            if this != now and held:
                yield links(held)
                held = []
            now = this
            held.append(batch.slice(low, high - low))
    if held:
        yield links(held)


def _mixed(members: DataFrame, compared: bool) -> DataFrame:
    """Members (key, node, comp, ...) of keys with members of several components,
    with the key's largest component ``top`` and ``n_outside`` it; if the first
    member was ``compared`` with the others, of keys with three or more."""
    sizes = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    keys = (sizes.groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("top"))
            .filter("comps > 1 and n > 2" if compared else "comps > 1").select("key", F.col("top.comp").alias("top"), (F.col("n") - F.col("top.n")).alias("n_outside")))
    return members.join(keys, "key")


def _rare_shingles(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, node, comp): of each member's n shingles, the rarest among members first,
    those up to the first that any link must share: n - ceil(n * PERCENT / PERCENT_OF) + 1."""
    own = texts.join(members, "node").select("node", "comp", F.xxhash64("text").alias("set"), F.explode(shingle_keys("text")).alias("key"))
    own = written(own, "shingles")
    often = own.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ordered = own.join(often, "key").groupBy("node", "comp", "set").agg(F.array_sort(F.collect_set(F.struct("n", "key"))).alias("s"))
    needed = F.size("s") - F.expr(f"(size(s) * {PERCENT} + {PERCENT_OF - 1}) div {PERCENT_OF}").cast("int") + 1
    return ordered.select("node", "comp", F.explode(F.slice("s", F.lit(1), needed)).alias("s")).filter("s.n > 1").select("s.key", "node", "comp").distinct()


def _remaining(bands: DataFrame, nodes: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) between components that share a bucket, beyond those of first members.

    Buckets with one largest component are taken together, as near copies of a
    text share many: its members there are met by all nodes outside it."""
    comp = found.select("node", F.col("component").alias("comp"))
    members = bands.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = written(_mixed(members.select("key", "band", "node", "comp"), True), "mixed")
    large = mixed.filter(F.col("n_outside") > LARGE_BUCKET).select("node", "comp").distinct()
    split = written(_rare_shingles(large, texts), "rare")
    whole = mixed.filter(F.col("n_outside") <= LARGE_BUCKET).select("top", "node", "comp")
    groups = (whole.union(_mixed(split, False).select("top", "node", "comp")).distinct()
              .join(nodes.select("node", "n_shingles", "regs"), "node").withColumn("outside", F.col("comp") != F.col("top")))
    groups = written(groups, "groups")
    # sides of blocks are bounded in members and in shingles
    out = F.col("outside")
    parts = lambda which: F.ceil(F.greatest(F.sum(which.cast("long")) / LARGE_BUCKET, F.sum(F.when(which, F.col("n_shingles")).otherwise(0)) / BLOCK_SHINGLES,
                                            F.lit(1.0))).cast("int")
    counts = groups.groupBy("top").agg(parts(out).alias("a_parts"), parts(F.lit(True)).alias("b_parts"))
    sized = groups.join(counts, "top")
    order, upto = F.xxhash64("node"), lambda n: F.sequence(F.lit(0), n - 1)
    names = ["top", "i", "j", "role", "comp", "node", "n_shingles", "regs"]
    zero = F.lit(0)
    one = sized.filter("a_parts = 1 and b_parts = 1").withColumns({"i": zero, "j": zero, "role": F.when(out, ROLE_BOTH).otherwise(ROLE_B)})
    many = sized.filter("a_parts > 1 or b_parts > 1")
    a_side = many.filter(out).withColumns({"i": F.pmod(order, "a_parts").cast("int"), "j": F.explode(upto(F.col("b_parts"))), "role": F.lit(ROLE_A)})
    b_side = many.withColumns({"j": F.pmod(order, "b_parts").cast("int"), "i": F.explode(upto(F.col("a_parts"))), "role": F.lit(ROLE_B)})
    rows = one.select(*names).union(a_side.select(*names)).union(b_side.select(*names))
    dealt = rows.join(texts, "node").repartition("top", "i", "j").sortWithinPartitions("top", "i", "j")
    return dealt.mapInArrow(_blocks, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    session(docs)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = written(source.select("doc_id", signature("text").alias("s")).select("doc_id", "s.*"), "signatures")
    known = signed.filter("n_shingles > 0 and doc_id is not null")
    # equal sets are one node, named by their smallest id
    sets = written(known.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "sets")
    nodes = (known.join(sets.withColumnRenamed("node", "doc_id"), ["k1", "k2", "doc_id"])
             .select(F.col("doc_id").alias("node"), "n_shingles", "regs").dropDuplicates())
    nodes = written(nodes, "nodes")
    bands = band_keys(nodes)
    leaders = bands.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = written(bands.select("key", F.col("node").alias("b")).join(leaders, "key").filter("a != b").select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = written(source.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"), "texts")
    promising_pairs = written(_with_signatures(pairs, nodes), "promising")
    # rows of one id with several sets make these sets one node
    own = known.join(sets, ["k1", "k2"]).groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b")
    links = written(own.select("a", "b").union(known.join(sets, ["k1", "k2"]).join(own.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))), "links")

    best = promising_pairs.groupBy("b").agg(F.max_by("a", "estimate").alias("a")).select("a", "b")
    links = written(links.union(_confirmed(best, texts)), "links")
    found = components(links, "a", "b")
    rest = _apart(promising_pairs, found).join(best, ["a", "b"], "left_anti")
    links = written(links.union(_confirmed(rest, texts)), "links")
    found = components(links, "a", "b")
    links = written(links.union(_remaining(bands, nodes, texts, found)), "links")
    found = components(links, "a", "b")

    of_set = sets.join(found, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    out = signed.join(of_set, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return (out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents without those that repeat a document of smaller id, all columns as they were."""
    dropped = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__dropped"], "left_anti")
