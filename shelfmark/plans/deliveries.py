"""The driver tables delivered in three overlapping parts (B13), and the whole warehouse round trip.

Books come by size of the part, checkouts by year, and every delivery holds all
rows of the one before it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.quality import fk_violations
from shelfmark.plans import catalog as C
from shelfmark.plans.star import warehouse_tables
from shelfmark.session import remove_at_exit, scratch_path, stored
from shelfmark.sources import warehouse as W
from shelfmark.sources.sinks import STAR
from shelfmark.sources.tables import table
from shelfmark.streaming.incremental import Sides, add_books, add_checkouts

BOOK_SIZES = (20, 35)
CHECKOUT_YEARS = (1995, 1997)
_LOADED: dict[tuple[str, str], str] = {}


def delivered(spark: SparkSession, d: str) -> str:
    """The warehouse folder after all deliveries, loaded once per application and input folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _LOADED:
        root = scratch_path(spark, "warehouse")
        remove_at_exit(spark, root)
        sides = Sides(C.code_dictionary(spark, d), stored(C.weather(spark, d), "weather"), C.external_books(spark, d))
        sizes = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("bib_num"), "p_size")
        books = C.inventory(spark, d).join(sizes, "bib_num")
        checkouts = C.checkouts(spark, d)
        for n, most in enumerate([*BOOK_SIZES, None]):
            add_books(spark, root, (books if most is None else books.where(F.col("p_size") <= most)).drop("p_size"), n, sides)
        for n, before in enumerate([*CHECKOUT_YEARS, None]):
            part = checkouts if before is None else checkouts.where(F.year("checkout_datetime") < before)
            add_checkouts(spark, root, part, n, sides)
        _LOADED[key] = root
    return _LOADED[key]


def delivered_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """(table_name, id, name) of the dimensions with given ids."""
    star = W.read_star(spark, delivered(spark, d))
    out = None
    for name in ("dim_author", "dim_subject", "dim_publisher"):
        part = star[name].select(F.lit(name).alias("table_name"), "id", "name")
        out = part if out is None else out.unionByName(part)
    return out


def delivered_bridges(spark: SparkSession, d: str) -> DataFrame:
    star = W.read_star(spark, delivered(spark, d))
    side = lambda t, c: star[t].select("bib_num", F.lit(t).alias("table_name"), F.col(c).alias("id"))
    return side("br_book_author", "author_id").unionByName(side("br_book_subject", "subject_id"))


def delivered_fact(spark: SparkSession, d: str) -> DataFrame:
    return W.read_star(spark, delivered(spark, d))[W.FACT]


# fixed by the deliveries above: the ids that every key gets, by first delivery and then in key order
_FIRST = (f"CASE WHEN p_size <= {BOOK_SIZES[0]} THEN 0 WHEN p_size <= {BOOK_SIZES[1]} THEN 1 ELSE 2 END")


def given_ids_sql(clean_publisher: str) -> str:
    """CTEs given_author, given_subject and given_publisher (id, name, key)."""
    def given(name: str, rows: str, kept: str) -> str:
        return (f"given_{name} AS (SELECT row_number() OVER (ORDER BY f, key NULLS FIRST) - 1 AS id, {kept} AS name, key FROM ("
                f"SELECT key, f, min(name) AS name FROM (SELECT r.key, r.name, g.n AS g, min(g.n) OVER (PARTITION BY r.key) AS f "
                f"FROM {rows} r JOIN given_first g ON g.bib_num = r.bib_num) WHERE g = f GROUP BY key, f))")
    subjects = "(SELECT bib_num, name, name AS key FROM (SELECT bib_num, unnest(string_split(raw_subjects, ', ')) AS name FROM books))"
    return ", ".join([f"given_first AS (SELECT CAST(p_partkey AS VARCHAR) AS bib_num, {_FIRST} AS n FROM part)",
                      given("author", "author_keys", "name"), given("subject", subjects, "name"),
                      given("publisher", "(SELECT bib_num, publisher AS name, key FROM pub_lookup)", clean_publisher)])


# ---- whole load --------------------------------------------------------------

def warehouse_report(spark: SparkSession, d: str, buckets: int | None = None) -> DataFrame:
    """Load the eight tables as one version, attach them as tables and read back of each: rows, distinct primary keys
    (null without one), rows without a parent, and of the fact the rows that meet the time dimension bucket by bucket."""
    root = scratch_path(spark, "warehouse")
    remove_at_exit(spark, root)
    database = f"star_{uuid.uuid4().hex[:12]}"
    W.load_star(spark, root, warehouse_tables(C.star(spark, d)), buckets, year_range=(1900, 2100))
    W.attach(spark, root, database)
    try:
        tables = {n: spark.table(f"{database}.{n}") for n in STAR}
        out = None
        for n, t in STAR.items():
            keys = F.count_distinct(*t.primary_key) if t.primary_key else F.lit(None)
            row = tables[n].agg(F.count(F.lit(1)).alias("n_rows"), keys.cast("long").alias("n_keys")).withColumn("table_name", F.lit(n))
            out = row if out is None else out.unionByName(row)
        orphans = fk_violations(tables).groupBy("table_name").agg(F.sum("observed").cast("long").alias("n_orphans"))
        met = W.fact_with_time(spark, database).agg(F.count(F.lit(1)).alias("n_with_time"), F.sum("weekday").alias("sum_weekday"))
        met = met.withColumn("table_name", F.lit(W.FACT))
        return stored(out.join(orphans, "table_name", "left").join(met, "table_name", "left"), "warehouse-report")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
