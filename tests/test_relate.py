"""Join, dedupe and key operators: invariants and equivalences."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark.operators import keys, relate


def test_or_join_rewrite_equals_plain_or(spark):
    left = spark.createDataFrame([(i, str(k)) for i, k in enumerate([1, 2, 3, None, 5, 5])], "id int, k string")
    right = spark.createDataFrame([(10, "1", "5"), (11, "2", "2"), (12, None, "3"), (13, "9", None)],
                                  "rid int, a string, b string")
    plain = left.join(right, (left.k == right.a) | (left.k == right.b)).select("id", "rid")
    fast = relate.join_any_key(left, right, "k", ["a", "b"]).select("id", "rid")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, fast.collect()))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dedupe_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "z", 5)], "k int, v string, o int")
    first = relate.dedupe_by_key(df, ["k"], ["o"]).orderBy("k").collect()
    assert [(r.k, r.v, r.o) for r in first] == [(1, "c", 1), (2, "z", 5)]
    last = relate.dedupe_by_key(df.repartition(3), ["k"], ["o"], descending=True).orderBy("k").collect()
    assert [(r.k, r.v, r.o) for r in last] == [(1, "b", 2), (2, "z", 5)]


def test_dense_ids_match_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k")).repartition(7)
    got = keys.dense_ids(df, ["k"], num_partitions=5)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k")) - 1)
    assert got.join(want, "k").filter(F.col("id") != F.col("rn")).count() == 0
    assert got.count() == 5000


def test_append_new_keys_keeps_old_ids(spark):
    old = keys.dense_ids(spark.createDataFrame([("b",), ("d",)], "k string"), ["k"])
    cand = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("c",)], "k string")
    added, full = keys.append_new_keys(old, cand, "k")
    got = {r.k: r.id for r in full.collect()}
    assert got == {"b": 0, "d": 1, "a": 2, "c": 3}


def test_left_enrich_never_fans_out(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    right = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 1)], "rid int, v string, o int")
    out = relate.left_enrich(left, right, "id", "rid", {"v": "v"}, order_by=["o"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "y"), (2, "z"), (3, None)]


def test_append_new_keys_keeps_a_null_key_once(spark):
    old = spark.createDataFrame([("a", 0), (None, 1)], "k string, id long")
    cand = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "k string")
    added, full = keys.append_new_keys(old, cand, "k")
    assert [(r.k, r.id) for r in added.collect()] == [("b", 2)]
    assert sorted((str(r.k), r.id) for r in full.collect()) == [("None", 1), ("a", 0), ("b", 2)]


def test_lookup_filter_join_is_semi(spark):
    big = spark.range(100).select(F.col("id"), (F.col("id") % 4).cast("string").alias("code"))
    lk = spark.createDataFrame([("0", "ItemType", "Print"), ("1", "ItemType", "Media"), ("2", "Other", "Print")],
                               "Code string, t string, g string")
    out = relate.lookup_filter_join(big, lk, "code", "Code", {"t": "ItemType", "g": "Print"})
    assert out.count() == 25 and out.columns == ["id", "code"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "GlobalLimit" not in plan


def test_date_parts_join_and_two_hop(spark):
    fact = spark.createDataFrame([("1", "2017-01-01 10:00:00"), ("2", "2017-01-02 11:00:00")], "b string, t string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    w = spark.createDataFrame([(1, 1, 2017, 10.0)], "month int, day int, year int, temperature double")
    j = relate.join_on_date_parts(fact, "t", w, columns=["temperature"])
    assert sorted((r.b, r.temperature) for r in j.collect()) == [("1", 10.0), ("2", None)]
    lookup = spark.createDataFrame([("1", "k1")], "b string, key string")
    dim = spark.createDataFrame([("k1", 7)], "key string, id long")
    out = relate.two_hop_left_join(fact, lookup, dim, "b", "b", "key", "key", {"id": "pid"})
    assert sorted((r.b, r.pid) for r in out.collect()) == [("1", 7), ("2", None)]
