"""The stages, one after another, against brute force on a small table."""

import corpus_pipeline
from shelfmark.llm import quality_rules
from shelfmark.llm.frames import documents, written
from tests.llm.test_groups import brute
from tests.llm.test_native import expected_hits, expected_lines


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    wanted = {r["doc_id"] for r in quality_rules.judged(docs).where("_kept").collect()}
    before = None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf), "stage")
        if name != "packing":
            assert docs.columns == documents(spark, sf).columns
        if name == "quality_rules":
            assert {i for i, _ in pairs(docs)} == wanted
        elif name == "line_dedup":
            assert sorted(pairs(docs)) == sorted((i, t) for i, t, _, _ in expected_lines(pairs(before)))
            assert docs.where("n_chars <> char_length(text)").count() == 0
        elif name == "near_dedup":
            rows = pairs(before)
            assert {i for i, _ in pairs(docs)} == {i for i, n, c in brute(rows) if i == c}
        elif name == "decontamination":
            assert {i for i, _ in pairs(docs)} == {i for i, t in pairs(before) if not expected_hits(t, items)[1]}
        else:
            assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in pairs(before)}


def test_pipeline_takes_awkward_and_empty_tables(spark, awkward, nothing):
    sf = "/root/testdata/sf0.001"
    for docs, some in ((awkward, True), (nothing, False)):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf), "stage")
        assert docs.isEmpty() != some


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
