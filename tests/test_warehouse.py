"""Whole loads: all eight tables or none, dealt and sorted for the fact's join."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import catalog as C
from shelfmark.plans.star import warehouse_tables
from shelfmark.sources import warehouse as W

SF = "/root/testdata/sf0.001"
YEARS = (1900, 2100)


@pytest.fixture(scope="module")
def star(spark):
    return warehouse_tables(C.star(spark, SF))


def test_a_bucket_is_one_sorted_file_and_the_join_needs_neither_exchange_nor_sort(spark, star, tmp):
    W.load_star(spark, tmp, star, buckets=3, year_range=YEARS)
    W.attach(spark, tmp, "bucketed")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = W.fact_with_time(spark, "bucketed")
        n = joined.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan, plan
        for name in (W.FACT, "dim_checkout_time"):
            path = W.current(spark, tmp).parts[name][0].path
            assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 3
        assert n == star[W.FACT].count()
        assert sorted(map(str, spark.table(f"bucketed.{W.FACT}").collect())) == sorted(map(str, star[W.FACT].collect()))
        assert {t.name for t in spark.catalog.listTables("bucketed")} == set(star)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE bucketed CASCADE")


def counts(spark, root):
    return {n: df.count() for n, df in W.read_star(spark, root).items()}


BAD = {
    "barcode of fourteen": (W.FACT, lambda df: df.withColumn("item_barcode", F.lit("0" * 14)), "barcode_length|max_bytes"),
    "key twice": ("dim_subject", lambda df: df.withColumn("id", F.lit(0).cast("long")), "unique_key"),
    "no name": ("dim_author", lambda df: df.withColumn("name", F.lit(None).cast("string")), "not_null"),
    "no parent": ("dim_subject", lambda df: df.where("id > 2"), "foreign_key"),
    "empty": ("dim_book", lambda df: df.where("false"), "non_empty"),
    "no number": ("dim_publisher", lambda df: df.withColumn("id", F.lit("x")), "not a bigint"),
    "hot": (W.FACT, lambda df: df.withColumn("temperature", F.lit(500.0)), "max_temperature"),
}


def test_a_failed_load_leaves_the_tables_before_it(spark, star, tmp):
    first = {n: df.where("id < 1000000") if "id" in df.columns and n == "dim_author" else df for n, df in star.items()}
    W.load_star(spark, tmp, first, buckets=2, year_range=YEARS)
    kept, at = counts(spark, tmp), W.current(spark, tmp)
    opened = W.read_star(spark, tmp)
    parts = lambda: {n: sorted(os.listdir(os.path.join(tmp, "parts", n))) for n in star}
    before = parts()
    for name, spoil, check in BAD.values():
        with pytest.raises(W.FailedLoad, match=check):
            W.load_star(spark, tmp, {**star, name: spoil(star[name])}, buckets=2, year_range=YEARS)
        assert W.current(spark, tmp) == at and parts() == before
    assert counts(spark, tmp) == kept
    with pytest.raises(W.FailedLoad, match="missing"):
        W.load_star(spark, tmp, {n: df for n, df in star.items() if n != "dim_book"})
    # a good load replaces all eight, and who had opened the old ones still reads them
    fewer = {**star, W.FACT: star[W.FACT].where("month(checkout_datetime) = 1")}
    W.load_star(spark, tmp, fewer, buckets=2, year_range=YEARS)
    assert W.current(spark, tmp).number == 2 and counts(spark, tmp)[W.FACT] < kept[W.FACT] == opened[W.FACT].count()


def test_a_version_is_published_once(spark, tmp):
    W.publish(spark, tmp, W.Version(1))
    with pytest.raises(W.FailedLoad, match="another load"):
        W.publish(spark, tmp, W.Version(1, batches={"books": 3}))
    assert W.current(spark, tmp) == W.Version(1) and W.versions(spark, tmp) == [1]


def test_an_empty_warehouse_reads_as_empty_tables(spark, tmp):
    assert set(counts(spark, tmp).values()) == {0}
    W.attach(spark, tmp, "nothing")
    assert spark.table(f"nothing.{W.FACT}").count() == 0
    spark.sql("DROP DATABASE nothing CASCADE")


def test_buckets_follow_the_rows_of_the_fact(spark, star, tmp, monkeypatch):
    n = star[W.FACT].count()
    assert W.bucket_count(star[W.FACT]) == 8
    monkeypatch.setattr(W, "BUCKET_ROWS", 400)
    at = W.load_star(spark, tmp, star, year_range=YEARS)
    assert at.parts[W.FACT][0].buckets == at.parts["dim_checkout_time"][0].buckets == -(-n // 400) > 8
    rows = spark.read.parquet(at.parts[W.FACT][0].path).groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert rows[0] < 800 and rows[1] == n
