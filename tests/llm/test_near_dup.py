import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from quillstream.llm import near_dup as N
from quillstream.llm.components import components
from tests.llm.conftest import rows_of


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [(doc, shingles(text)) for doc, text in rows]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    holders = {}
    for n, (doc, own) in enumerate(sets):
        for s in own if doc is not None else ():
            holders.setdefault(s, []).append(n)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    for a, b in pairs:
        shared = len(sets[a][1] & sets[b][1])
        if 100 * shared >= 75 * (len(sets[a][1]) + len(sets[b][1]) - shared):
            x, y = sorted((find(sets[a][0]), find(sets[b][0])))
            root[y] = x
    out = []
    for doc, own in sets:
        group = None if doc is None else find(doc) if own else doc
        out.append((doc, len(own), group, doc is None or group == doc))
    return sorted(out, key=repr)


def test_documents_equal_brute_force(docs, texts):
    assert rows_of(N.near_duplicates(docs)) == brute(texts)


def test_chains_and_threshold(spark):
    """Copies changed word by word: neighbours link, the ends of the chain do not."""
    rng = random.Random(7)
    rows, n = [], 0
    for _ in range(12):
        words = [f"w{rng.randrange(9999)}" for _ in range(rng.choice([5, 8, 30, 60, 200]))]
        for _ in range(10):
            rows.append((n, " ".join(words)))
            n += 1
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
    rng.shuffle(rows)
    assert rows_of(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_large_group_and_shared_passage(spark, monkeypatch):
    """A passage in many documents that are no copies, and a large group of near
    copies of one text, with buckets beyond the limits at which they are split."""
    monkeypatch.setattr(N, "LARGE_BUCKET", 8)
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    base = [f"b{i}" for i in range(80)]
    rows = [(i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for i in range(120)]
    for i in range(120, 240):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(80)] = f"c{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert rows_of(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_one_id_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (9, b), (None, a), (7, None), (7, "")]
    got = rows_of(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [r[2] for r in got if r[0] in (1, 5, 9)] == [1, 1, 1, 1]
    assert all(r[2] == 7 and r[3] for r in got if r[0] == 7)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 6000).astype(np.uint64) * np.uint64(2)
    for share in (0.5, 0.75, 0.9):
        n = round(2000 * 2 * share / (1 + share))  # members that both sets hold
        sets = [keys[:2000], np.concatenate([keys[:n], keys[2000:4000 - n]])]
        row = np.repeat([0, 1], [2000, 2000])
        regs = N.registers(row, np.concatenate(sets), 2)
        assert abs((regs[0] == regs[1]).mean() - share) < 0.17


def test_links_are_exact():
    words = [f"w{i}" for i in range(104)]
    text = " ".join(words)
    near = " ".join(words[:100])  # 96 of 100 shingles
    far = " ".join(words[:78])  # 74 of 100
    got = N.linked.func(pa.array([text, text, None, "a"]), pa.array([near, far, None, "A"]))
    assert got.to_pylist() == [True, False, False, True]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 300), (300, 200), (250, 300), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 200, 250: 200, 300: 200}


def test_first_of_each_group(docs, texts, no_docs):
    kept = N.first_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in brute(texts) if r[3]), key=repr)
    assert N.near_duplicates(no_docs).count() == 0


def test_two_members_that_were_never_compared(spark):
    members = spark.createDataFrame([(1, 10, 10), (1, 11, 11), (2, 12, 12), (2, 13, 12)], "key long, node long, comp long")
    assert {r.node for r in N._mixed(members, False).collect()} == {10, 11}
    assert N._mixed(members, True).count() == 0


def test_large_buckets_of_short_texts(spark, monkeypatch):
    """Texts of 7 to 10 words that share a frequent phrase, all of whose buckets are split."""
    monkeypatch.setattr(N, "LARGE_BUCKET", 2)
    rng = random.Random(9)
    rows = []
    for i in range(600):
        phrase = [f"p{rng.randrange(3)}", "a", "b", "c", "d"]
        rows.append((i, " ".join(phrase + [f"w{rng.randrange(9)}" for _ in range(rng.randint(2, 5))])))
    assert rows_of(N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
