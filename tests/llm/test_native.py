"""Operators 4, 7 and 9 against plain Python on awkward rows."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, line_dedup, quality_rules

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOP = 2**63 - 1


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def expected_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owner[key(line)] = min(owner.get(key(line), TOP), TOP if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if owner.get(key(x), TOP) >= (TOP if i is None else i)]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (4, 3)])
def test_line_dedup(awkward, batches, fanout):
    got = line_dedup.dedupe_lines(awkward, batches=batches, fanout=fanout)
    assert set(awkward.columns) < set(got.columns)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    have = sorted(((r["doc_id"], r["_kept"], r["_n_lines"], r["_n_dropped"]) for r in got.collect()), key=repr)
    assert have == expected_lines(rows)


def test_line_dedup_is_native_and_takes_no_rows(nothing, awkward):
    no_python(line_dedup.dedupe_lines(awkward))
    assert line_dedup.dedupe_lines(nothing).count() == 0


def test_runs_are_compacted(spark, awkward):
    runs = line_dedup.LineRuns(spark, fanout=2)
    from shelfmark.llm.frames import identified
    lines = line_dedup.line_keys(identified(awkward), 10)
    for k in range(5):
        runs.add(lines.where(F.col("_id") % 5 == k))
    assert [len(x) for x in runs.levels] == [1, 0, 1]  # 5 = 101 in binary
    runs.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def expected_hits(text, items):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD)) if w]
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(10, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(map(str, found - {None}))


def test_decontamination(spark, awkward):
    texts = {r["doc_id"]: r["text"] for r in awkward.collect()}
    long = texts[10].split()
    items = [(1, " ".join(long[100:130])), (2, "one two"), (3, "Naïve"), (4, None), (5, "--"), (6, " ".join(long[-9:])),
             (7, " ".join(long[500:510]).upper()), (7, " ".join(long[500:510])), (8, " ".join(long[:9])), (9, texts[1] + " tail")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = decontaminate.contaminated(awkward.select("doc_id", "text"), bench)
    no_python(out)
    have = Counter((r["_id"], r["_n_words"], r["_n_hit"], tuple(r["_items"])) for r in out.collect())
    want = set()
    for r in awkward.collect():
        n, hit, found = expected_hits(r["text"], items)
        want.add((TOP if r["doc_id"] is None else r["doc_id"], n, hit, tuple(found)))
    assert set(have) == want
    clean = decontaminate.remove_contaminated(awkward, bench)
    assert clean.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(
        str(r["doc_id"]) for r in awkward.collect() if not expected_hits(r["text"], items)[1])


def test_every_shared_span_is_found(spark):
    from tests.llm.conftest import passage
    text = passage(9, 400).split()
    bench = spark.createDataFrame([(k, " ".join(text[k:k + 10])) for k in range(0, 390, 13)], "item_id int, text string")
    docs = spark.createDataFrame([(k, "before " * (k % 7) + " ".join(text[k:k + 10]) + " after" * (k % 5)) for k in range(0, 390, 13)],
                                 "doc_id bigint, text string")
    hits = decontaminate.contaminated(docs, bench).select("_n_hit").collect()
    assert all(r["_n_hit"] >= 10 for r in hits) and len(hits) == 30


def test_decontamination_of_nothing(spark, nothing, awkward):
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contaminated(nothing, none).count() == 0
    assert decontaminate.remove_contaminated(awkward, none).count() == awkward.count()


def expected_quality(text):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]
    at = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if at[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, awkward):
    more = ["a b c d e f g h " * 3, "x " * 40, "one line\none line\nother | # line", "a b c d e f g h i j a b c d e f g h z"]
    extra = spark.createDataFrame([(100 + k, t) for k, t in enumerate(more)], "doc_id bigint, text string")
    docs = awkward.select("doc_id", "text").unionByName(extra)
    out = quality_rules.judged(docs)
    no_python(out)
    for r in out.collect():
        q = r["_q"]
        want = expected_quality(r["text"])
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["_base_failed"] == failed and not (failed and r["_kept"])


def test_quality_keeps_clean_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").select("doc_id", "quality")
    good = quality_rules.judged(docs).join(labels, "doc_id").where("not _base_failed").groupBy("quality", "_kept").count().collect()
    count = {(r["quality"], r["_kept"]): r["count"] for r in good}
    assert count.get((1, False), 0) == 0 and count.get((0, True), 0) <= 3


def test_quality_of_nothing(nothing, awkward):
    assert quality_rules.keep_good(nothing).count() == 0
    assert quality_rules.keep_good(awkward).columns == awkward.columns


def test_kept_hash(spark):
    docs = spark.createDataFrame([(1, "a line that is long\nx"), (2, "A LINE that is long")], "doc_id bigint, text string")
    got = {r["doc_id"]: hashlib.sha256(r["_kept"].encode()).hexdigest() for r in line_dedup.dedupe_lines(docs).collect()}
    assert got[2] == hashlib.sha256(b"").hexdigest()


def test_runs_are_merged_in_their_stored_order(spark):
    """Neither the anti-join with a run nor the merge of runs shuffles or sorts what is stored."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", line_dedup.SCAN_ORDER)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs = line_dedup.LineRuns(spark)
    try:
        lines = spark.range(4000).select(F.xxhash64("id").alias("_h1"), F.hash("id").cast("long").alias("_h2"), F.col("id").alias("_id"))
        batch = lambda low, high: lines.where(f"_id >= {low} and _id < {high}").groupBy(*line_dedup.KEY).agg(F.min("_id").alias("_owner"))
        first, second = runs._store(batch(0, 1500)), runs._store(batch(1500, 3000))
        merged = runs.merged([first, second])
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan, plan
        fresh = batch(2000, 4000).join(spark.table(first).select(*line_dedup.KEY), line_dedup.KEY, "left_anti")
        fresh = fresh.join(spark.table(second).select(*line_dedup.KEY), line_dedup.KEY, "left_anti")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1, plan  # the new batch, once
        both = runs._store(merged)
        assert spark.table(both).count() == 3000 and len(spark.table(both).inputFiles()) <= runs.buckets
        assert sorted(r["_owner"] for r in fresh.collect()) == list(range(3000, 4000))
        for t in (first, second, both):
            runs._forget(t)
        assert not runs.paths
    finally:
        runs.drop()
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert spark.conf.get(line_dedup.SCAN_ORDER, None) == before[line_dedup.SCAN_ORDER]
