"""The caller's columns stay as they are, whatever they are called; ids and words that could be mixed up are not."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import (best_fit, byte_words as bw, decontaminate, lang_id, licenses, line_dedup, lm_score, near_dup, packing,
                           quality_rules, sharding, toxicity)
from shelfmark.llm.queries_rows import tokenizer_path
from tests.llm.conftest import passage

CLASHING = ["_id", "_th", "_w", "_q", "_l", "_n", "_kept", "_root", "_text", "_row", "score", "lang_pred", "c0", "_slot", "learn", "_score",
            "_component", "_n_lines", "_gone"]


@pytest.fixture()
def docs(spark):
    rows = [(k, passage(k, 40 + k) + " the and of", f"mongo-{k}") for k in range(12)] + [(20, passage(3, 43) + " the and of", "mongo-20"), (21, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _id string")
    return frame.select("doc_id", "text", *[F.concat(F.lit(c), F.col("_id")).alias(c) for c in CLASHING])


def unchanged(out, docs):
    """Every caller's column but the text is there with its value."""
    before = {r["doc_id"]: r for r in docs.collect()}
    rows = out.collect()
    for r in rows:
        for c in CLASHING:
            assert r[c] == before[r["doc_id"]][c]
    return rows


def test_columns_of_row_operators(spark, docs):
    bench = spark.createDataFrame([(1, passage(5, 20))], "item_id bigint, text string")
    model = lang_id.Model()
    assert len(unchanged(lang_id.identify(docs, model), docs)) == 14
    assert "score_new" in toxicity.score(docs, toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0, 0.1)).columns
    assert "_kept_new" in quality_rules.judged(docs).columns
    unchanged(quality_rules.keep_good(docs), docs)
    unchanged(near_dup.keep_one(docs), docs)
    unchanged(near_dup.with_groups(docs), docs)
    unchanged(decontaminate.remove_contaminated(docs, bench), docs)
    unchanged(line_dedup.dedupe_lines(docs), docs)
    unchanged(sharding.with_shard(docs), docs)
    scored = unchanged(lm_score.scored(docs, F.col("_id").isNotNull()), docs)
    assert len(scored) == 14 and all(r["_score_new"] < 0 for r in scored)
    assert licenses.scan(docs).count() == packing.pack(docs, tokenizer_path()).select("doc_id").distinct().count() == 14
    assert best_fit.pack(docs, tokenizer_path()).select("doc_id").distinct().count() == 14


def test_columns_of_pipeline_stages(spark, docs, sf_small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns
        unchanged(out, docs)


def test_text_ids_are_refused_with_a_reason(spark):
    docs = spark.createDataFrame([("a-1", "one two three four five")], "doc_id string, text string")
    for operator in (line_dedup.dedupe_lines, near_dup.keep_one):
        with pytest.raises(PySparkException, match="document ids must be whole numbers"):
            operator(docs).collect()
    assert near_dup.keep_one(docs.withColumn("doc_id", F.lit("12"))).first()["doc_id"] == "12"


def test_long_words_of_two_letters_are_different_words(spark):
    """A polynomial modulo 2^64 gives these two one hash, whatever its base."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id bigint, text string")
    assert sorted(r["_component"] for r in near_dup.with_groups(docs).collect()) == [1, 2]
    known = {r["doc_id"]: r["_n_known"] for r in lm_score.scored(docs, F.col("doc_id") == 1).collect()}
    assert known == {1: 2, 2: 1}


def test_word_hashes_name_words(spark):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 3, n)) for n in rng.integers(1, 40, 4000)]
    piece = next(bw.pieces(pa.array([" ".join(words)])))
    named = dict(zip(words, bw.words(piece).hashes.tolist()))
    assert all(named[w] == h for w, h in zip(words, bw.words(piece).hashes.tolist()))
    assert len(set(named.values())) == len(named)


def test_sets_of_one_node_hash_stay_apart(spark):
    rows = [(1, 0, 5, 70, 3), (2, 0, 5, 71, 3), (3, 0, 5, 70, 3), (4, 0, 5, 70, 4), (5, 0, 9, 70, 3), (6, 0, 0, 0, 0), (7, 0, 0, 0, 0)]
    frame = spark.createDataFrame(rows, "_id bigint, _th bigint, _node bigint, _check bigint, _n bigint")
    node = {r["_id"]: r["_node"] for r in near_dup._parted(frame).collect()}
    assert len({node[1], node[2], node[4], node[5]}) == 4 and node[1] == node[3] == 5 and node[5] == 9


def test_quality_of_a_text_in_another_script(spark):
    clean = " ".join(f"слово{chr(0x430 + k % 32)}{chr(0x430 + k // 4)}" for k in range(105))
    latin = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 5)}" for k in range(105))
    out = {r["doc_id"]: (r["_base_failed"], r["_kept"]) for r in quality_rules.judged(
        spark.createDataFrame([(1, clean), (2, latin)], "doc_id bigint, text string")).collect()}
    assert out == {1: (False, True), 2: (False, False)}
    own = tuple(r for r in quality_rules.RULES if r.name != "stop_words")
    assert quality_rules.keep_good(spark.createDataFrame([(2, latin)], "doc_id bigint, text string"), rules=own).count() == 1


def test_spread_is_a_parameter(spark):
    words = "redistribution and use in source and binary forms with or without modification are permitted".split()
    text = " ".join(f"{w} x y z q" for w in words)
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    notice = {"own": " ".join(words)}
    assert licenses.scan(docs, notice).first()["license"] is None
    assert licenses.scan(docs, notice, spread=6).first()["license"] == "own"
