import hashlib
import random

from quillstream.llm import decontaminate as D
from tests.llm.conftest import SF001, rows_of


def brute(rows, items):
    patterns = {}
    for item, text in items:
        words = D.item_words(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            patterns.setdefault(tuple(words[i:i + 10]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in rows:
        words, hit, found = D.item_words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(words) - size + 1):
                if (own := patterns.get(tuple(words[i:i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= own
        names = ",".join(sorted(found))
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_equals_brute_force_in_one_block_and_many(spark, docs, texts):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = brute(texts, items)
    assert rows_of(D.contamination(docs, bench)) == want and any(r[-1] for r in want)
    assert rows_of(D.contamination(docs, bench, block_bytes=4000)) == want


def test_short_items_ties_and_nulls(spark):
    rng = random.Random(4)
    words = ["aa", "bb", "Cc", "é", "7"]
    rows = [(i, " ,".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(200)] + [(500, None), (501, "")]
    items = [(1, "aa bb"), (2, "AA! BB?"), (None, "cc cc cc"), (3, None), (4, "..."), (5, "7"), (6, " ".join(rng.choices(words, k=12))),
             (7, " ".join(rng.choices(words, k=5))), (7, "é é é é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(D.contamination(docs, bench)) == brute(rows, items)
    assert rows_of(D.contamination(docs, bench.limit(0))) == brute(rows, [])


def test_clean_documents(spark, docs, no_docs):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    clean = D.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    bad = {r.doc_id for r in D.contamination(docs, bench).filter("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - bad
    assert D.contamination(no_docs, bench).count() == 0
