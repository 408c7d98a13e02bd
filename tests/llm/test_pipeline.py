import __spark_entry__
import corpus_pipeline
from quillstream.llm import decontaminate
from tests.llm.conftest import SF001, rows_of
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_host_quality import brute as quality
from tests.llm.test_line_chunks import brute as lines
from tests.llm.test_near_dup import brute as near


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = docs.columns
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF001), name)
        tables[name] = (docs.collect(), out.collect())
        if name != "bpe":
            assert out.columns == names
        docs = out
    ids = lambda rows: sorted(r.doc_id for r in rows)
    before, after = tables["quality_rules"]
    assert ids(after) == sorted(r[0] for r in quality([(r.doc_id, r.text, r.source) for r in before])[0] if r[-1])
    before, after = tables["line_dedup"]
    want = {r[0]: r for r in lines([(r.doc_id, r.text) for r in before])}
    assert all(r.n_chars == len(r.text) == want[r.doc_id][3] for r in after)
    assert {r.doc_id for r in before} - {r.doc_id for r in after} <= {i for i, r in want.items() if r[2]}
    before, after = tables["near_dedup"]
    assert ids(after) == sorted(r[0] for r in near([(r.doc_id, r.text) for r in before]) if r[3])
    before, after = tables["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert ids(after) == sorted(r[0] for r in leaks([(r.doc_id, r.text) for r in before], items) if not r[-1])
    before, after = tables["bpe"]
    assert ids(after) == ids(before)
    assert rows_of(corpus_pipeline.run(spark, SF001)) == sorted((tuple(r) for r in after), key=repr)


def test_every_stage_takes_odd_rows(spark, docs, no_docs):
    """Null, blank, very long, periodic and repeated texts, null and repeated ids, and columns
    with the stages' own names, alone and one stage after the other."""
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    chained = docs
    for name, stage in corpus_pipeline.STAGES:
        alone = stage(spark, docs, SF001)
        chained = corpus_pipeline.written(stage(spark, chained, SF001), name)
        nothing = stage(spark, no_docs, SF001)
        if name != "bpe":
            assert alone.columns == chained.columns == nothing.columns == docs.columns
        assert nothing.count() == 0
        assert {r.doc_id for r in alone.select("doc_id").collect()} <= ids
    left = [r.doc_id for r in chained.collect()]
    # the 120-word text and its near copies are one document; texts without 50 words are gone
    assert len({10_006, 10_007, 10_008, 10_009} & set(left)) == 1 and not {10_000, 10_001, 10_002, 10_003} & set(left)


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert decontaminate.WINDOW == 10
