"""Operators 1, 2 and 8: held-out figures, awkward rows, exact counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfmark.llm import byte_words as bw, lang_id, lm_score, queries_models, toxicity
from shelfmark.llm.frames import held_out


def test_held_out_matches_crc32(spark):
    ids = [0, 1, 17, 123456789, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", held_out("doc_id", 5, 1).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 1) for r in got)


def test_language_held_out_accuracy(spark, sf_small):
    out = queries_models.op1_language_id(spark, sf_small)
    truth = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    right = out.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("truth") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_of_awkward_rows(spark, awkward, nothing, sf_small):
    model = lang_id.train(spark.read.parquet(f"{sf_small}/documents.parquet"), F.lit(True))
    assert set(model.languages) == {"germanic", "romance"} and len(model.pairs["romance"]) == 1
    rows = awkward
    out = lang_id.identify(rows, model)
    got = out.collect()
    assert out.columns == [*[c for c in rows.columns if c != "text"], "lang_pred", "score_new"] and len(got) == rows.count()
    for r in got:
        assert r["score"] == "x"  # the caller's own column
        if r["doc_id"] in (6, 7, 8, 9):
            assert (r["lang_pred"], r["score_new"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] != "und"
    assert lang_id.identify(nothing, model).count() == 0
    empty = lang_id.train(nothing, F.lit(True))
    assert {r["lang_pred"] for r in lang_id.identify(rows, empty).collect()} == {"und"}


def test_language_sample_is_bounded(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    sizes = [r["count"] for r in lang_id.training_sample(docs, F.lit(True), "lang", "text", 80).groupBy("lang").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 20


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = queries_models.op2_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = out.select("score", "toxic", "predicted").collect()
    pos, neg = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.8 and np.mean([n >= 0.5 for n in neg]) < 0.03
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    docs = awkward.unionByName(spark.createDataFrame(
        [(500 + k, f"filler{k} some words " + ("vile" if k % 3 == 0 else "mild"), "en", "s", 1, "x", "k", 0) for k in range(60)],
        awkward.schema))
    labels = spark.createDataFrame([(500 + k, int(k % 3 == 0)) for k in range(45)] + [(None, 1), (502, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    got = {r["doc_id"]: r["score_new"] for r in toxicity.score(docs, model).collect()}
    assert got[500 + 57] > 0.5 > got[500 + 58] and all(0 <= s <= 1 for s in got.values())
    assert got[6] == got[7] == got[8]
    none = toxicity.train(nothing, labels, F.lit(True))
    assert {(r["score"], r["score_new"]) for r in toxicity.score(docs, none).collect()} == {("x", 0.0)}
    assert toxicity.score(nothing, model).count() == 0


def test_negative_part_is_kept_from_below_zero():
    """Unlabelled rows half of which are positives: the estimator must still call them positive."""
    rows = np.repeat(np.arange(200), 1)
    buckets = np.where(np.arange(200) % 2 == 0, 5, 9)
    positive = np.zeros(200, bool)
    positive[:60:2] = True
    model = toxicity.fit(rows, buckets, positive, 0.45, np.array([5, 7]), np.array([0.9, 0.8]))
    assert model.weights[5] + model.bias > 0 > model.bias
    assert abs(1 / (1 + np.exp(-model.weights[7] - model.bias)) - 0.8) < 1e-9  # not in the sample: by its counts


def test_toxic_words_are_counted_over_all_rows(spark, monkeypatch):
    """Hundreds of telling words, most of them outside the sample of the gradient steps."""
    monkeypatch.setattr(toxicity, "POSITIVES", 40)
    monkeypatch.setattr(toxicity, "UNLABELLED", 200)
    rows = [(k, f"vile{k % 100} plain{k % 7} words{k % 11} here") for k in range(4000)]
    rows += [(10_000 + k, f"plain{k % 7} words{k % 11} here there") for k in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 10_000)) for i, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    asked = spark.createDataFrame([(k, f"plain1 vile{k} here") for k in range(100)] + [(900, "plain1 words2 here")], "doc_id bigint, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.score(asked, model).collect()}
    assert min(score[k] for k in range(100)) > 0.5 > score[900]
    # the same counts by hand
    found, purity = toxicity.telling_words(docs.withColumnsRenamed({"doc_id": "_key", "text": "_text"}), labels.where("toxic = 1").select(F.col("doc_id").alias("_key")), 1 / 6)
    word = lambda t: int(bw.words(next(bw.pieces(pa.array([t])))).hashes[0]) & (toxicity.BUCKETS - 1)
    assert set(found) == {word(f"vile{k}") for k in range(100)}
    assert np.allclose(purity, (1 / 6) * (40 / 4000) / (40 / 24_000))


def base_by_hand(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)), None]
    count = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            count.update(split(t))
    total, size = sum(count.values()), len(count)
    mass = math.log10(total + 0.5 * (size + 1))
    return [(len(split(t)), sum(count[w] > 0 for w in split(t)), total,
             sum(math.log10(count[w] + 0.5) - mass for w in split(t))) for _, t in rows]


def test_lm_base_and_counts(spark, awkward, monkeypatch):
    monkeypatch.setattr(lm_score, "KNOWN", 40)  # most words come by the join
    out = lm_score.scored(awkward, ~held_out("doc_id", 5, 1))
    assert set(awkward.columns) < set(out.columns)
    got = out.collect()
    want = base_by_hand([(r["doc_id"], r["text"]) for r in got])
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert len(got) == len(rows)
    for r, w in zip(got, base_by_hand([(r["doc_id"], r["text"]) for r in got])):
        assert (r["_n_tokens"], r["_n_known"], r["_train_tokens"]) == w[:3]
        assert abs(r["_base"] - w[3]) < 1e-9 * max(1, abs(w[3])) and r["_score"] < 0
    assert want


def test_lm_beats_the_base(spark, sf_small):
    out = queries_models.op8_lm_score(spark, sf_small)
    held = out.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1] * 0.99


def test_lm_of_nothing(nothing):
    assert lm_score.scored(nothing, F.lit(True)).count() == 0


def test_lm_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b a c", "b c d", "a a d e f"])], "doc_id bigint, text string")
    from shelfmark.llm.frames import identified
    counts = lm_score.word_counts(identified(docs))
    model = lm_score.trained(lm_score.counted_model(counts), identified(docs))
    t = lm_score.tokens(next(bw.pieces(pa.array(["a b c"]))))
    rows = lm_score.features(t, model.classes(t))
    vocabulary = counts.collect()
    for k in range(len(rows)):
        z, e, total = lm_score._odds(model, rows[k:k + 1], model.weights)
        p_class = (e / total[:, None])[0]
        words = lm_score.Tokens(np.array([r["_word"] for r in vocabulary], np.int64).view(np.uint64),
                                np.array([r["_suffix"] for r in vocabulary]), np.array([0, len(vocabulary)]))
        inside = np.array([r["_c"] + 0.5 for r in vocabulary]) / 10 ** model.log_mass[model.classes(words)]
        unknown = (p_class * 0.5 / 10 ** model.log_mass).sum()
        assert abs((p_class[model.classes(words)] * inside).sum() + unknown - 1) < 1e-5


def test_gradient_rows_are_summed_whole():
    rng = np.random.default_rng(5)
    keys = np.concatenate([rng.integers(0, 40, 300), np.full(lm_score.LONG_RUN, 50), np.full(lm_score.LONG_RUN + 1, 51), [99]])
    grad = rng.normal(size=(len(keys), 3)).astype(np.float32)
    at, times, summed = lm_score._row_sums(grad, keys)
    assert sorted(at) == sorted(set(keys))
    for key, n, row in zip(at, times, summed):
        assert n == (keys == key).sum()
        assert np.allclose(row, grad[keys == key].sum(axis=0), atol=1e-4)


def test_most_frequent_words_are_taken_from_the_top(spark):
    rng = np.random.default_rng(9)
    words = rng.integers(-2**62, 2**62, 5000)
    counts = rng.zipf(1.3, 5000).clip(max=10**6)
    table = spark.createDataFrame(list(zip(words.tolist(), counts.tolist())), "_word bigint, _c bigint")
    got = {r["_word"]: r["_c"] for r in lm_score.most_frequent(table, 500).collect()}
    assert 400 <= len(got) <= 600
    missed = [c for w, c in zip(words.tolist(), counts.tolist()) if w not in got]
    assert max(missed) <= 2 ** 0.125 * min(got.values()) + 1
    assert lm_score.most_frequent(table, 10**6).count() == 5000
    assert lm_score.most_frequent(table.limit(0), 10).count() == 0


def test_language_sample_holds_different_texts(spark):
    texts = spark.range(200).select(F.concat(F.lit("text number "), "id").alias("text"))
    first = texts.orderBy(F.pmod(F.xxhash64("text"), F.lit(1_000_003))).first()["text"]  # drawn at any fraction
    copies = spark.range(3000).select(F.lit(first).alias("text"))
    docs = texts.unionByName(copies).withColumn("lang", F.lit("en"))
    sample = lang_id.training_sample(docs, F.lit(True), "lang", "text", 100)
    assert sample.count() == 100 and sample.distinct().count() == 100
