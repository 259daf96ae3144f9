"""The library roles played by the driver tables, in Spark and in SQL.

| role                  | driver tables                                  |
| --------------------- | ---------------------------------------------- |
| inventory (books)     | part (key list, title/author/year/publisher/subjects text built from part columns) |
| external book feed    | supplier + nation (keys: supplier key or nation key) |
| checkouts             | lineitem (part key, ship date)                 |
| daily weather         | orders: per order date, average total price / 5000 |
| code dictionary       | nation + region                                |

Each Spark derivation has a SQL twin (``SQL_*``) used by the DuckDB oracle;
the two are kept next to each other so they cannot drift apart.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.star import StarOptions, build_star_from_books, late_columns, link_external_books, warehouse_tables
from shelfmark.session import remove_at_exit, scratch_path
from shelfmark.sources.sinks import STAR, write_star
from shelfmark.sources.tables import table


def _cap(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def inventory(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    size = F.col("p_size")
    author = F.concat_ws(", ", F.col("p_brand"), _cap(F.col("p_type")))
    return p.select(
        F.col("p_partkey").cast("string").alias("bib_num"),
        F.concat_ws(", ", size.cast("string"), F.regexp_extract("p_brand", r"(\d+)", 1)).alias("isbns"),
        F.concat(F.col("p_name"), F.lit(" / "), F.col("p_brand"), F.lit(".")).alias("raw_title"),
        F.when(size > 25, F.concat(author, F.lit(", "), (size + 1900).cast("string"), F.lit("-")))
         .otherwise(author).alias("raw_author"),
        F.concat((size + 1950).cast("string"), F.lit(", c"), (size + 1949).cast("string"), F.lit(".")
                 ).alias("raw_publication_year"),
        F.concat(F.col("p_brand"), F.lit(",")).alias("raw_publisher"),
        F.array_join(F.split(F.col("p_name"), " "), ", ").alias("raw_subjects"))


SQL_INVENTORY = r"""
SELECT CAST(p_partkey AS VARCHAR) AS bib_num,
       concat_ws(', ', CAST(p_size AS VARCHAR), regexp_extract(p_brand, '(\d+)', 1)) AS isbns,
       p_name || ' / ' || p_brand || '.' AS raw_title,
       CASE WHEN p_size > 25
            THEN p_brand || ', ' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ', '
                 || CAST(p_size + 1900 AS VARCHAR) || '-'
            ELSE p_brand || ', ' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) END AS raw_author,
       CAST(p_size + 1950 AS VARCHAR) || ', c' || CAST(p_size + 1949 AS VARCHAR) || '.' AS raw_publication_year,
       p_brand || ',' AS raw_publisher,
       array_to_string(string_split(p_name, ' '), ', ') AS raw_subjects
FROM part"""


def external_books(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    nk = F.col("s_nationkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("bookID"),
        F.when(nk % 5 == 0, F.lit("")).otherwise(F.col("s_name")).alias("title"),
        F.concat(F.col("s_name"), F.lit("/"), F.col("n_name")).alias("authors"),
        ((F.col("s_acctbal") + 1000) / 2200).alias("average_rating"),
        F.col("s_suppkey").cast("string").alias("isbn"),
        nk.cast("string").alias("isbn13"),
        nk.cast("int").alias("ratings_count"),
        F.col("n_regionkey").cast("int").alias("text_reviews_count"),
        F.when(nk % 3 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.make_timestamp_ntz(nk + 1980, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
         .alias("publication_date"))


SQL_EXTERNAL = r"""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS bookID,
       CASE WHEN s_nationkey % 5 = 0 THEN '' ELSE s_name END AS title,
       s_name || '/' || n_name AS authors,
       (s_acctbal + 1000) / 2200 AS average_rating,
       CAST(s_suppkey AS VARCHAR) AS isbn,
       CAST(s_nationkey AS VARCHAR) AS isbn13,
       s_nationkey AS ratings_count,
       n_regionkey AS text_reviews_count,
       CASE WHEN s_nationkey % 3 = 0 THEN NULL
            ELSE make_timestamp(s_nationkey + 1980, 1, 1, 0, 0, 0) END AS publication_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def checkouts(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("bib_num"),
                     F.concat(F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
                              F.lpad(F.col("l_linenumber").cast("string"), 3, "0")).alias("item_barcode"),
                     _time_of_day().alias("checkout_datetime"))


def _time_of_day():
    """The ship date has no time of day; one is derived from the order key."""
    seconds = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 10473) % 86400
    return F.timestamp_add("SECOND", seconds.cast("int"), F.col("l_shipdate"))


SQL_CHECKOUTS = r"""
SELECT CAST(l_partkey AS VARCHAR) AS bib_num,
       lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS item_barcode,
       l_shipdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 10473) % 86400 AS INTEGER)) AS checkout_datetime
FROM lineitem"""


def weather(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    daily = o.groupBy("o_orderdate").agg(F.avg("o_totalprice").alias("_p"))
    day = F.col("o_orderdate")
    return daily.select(F.month(day).alias("month"), F.dayofmonth(day).alias("day"), F.year(day).alias("year"),
                        F.round(F.col("_p") / 5000, 3).alias("temperature"))


SQL_WEATHER = r"""
SELECT month(o_orderdate) AS month, day(o_orderdate) AS day, year(o_orderdate) AS year,
       round(avg(o_totalprice) / 5000, 3) AS temperature
FROM orders GROUP BY o_orderdate"""


def code_dictionary(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


_STAR_CACHE: dict[tuple[str, str, StarOptions], dict[str, DataFrame]] = {}


def linked_books(spark: SparkSession, d: str) -> DataFrame:
    return link_external_books(inventory(spark, d), external_books(spark, d))


def star(spark: SparkSession, d: str, opts: StarOptions = StarOptions()) -> dict[str, DataFrame]:
    """The eight star tables over the driver tables, built once per application,
    folder and options and written as parquet to the shared folder (the fact
    partitioned by checkout year and month); questions read the written
    tables, so they get partition and column pruning instead of recomputing
    the ETL."""
    key = (spark.sparkContext.applicationId, d, opts)
    if key not in _STAR_CACHE:
        built = build_star_from_books(linked_books(spark, d), checkouts(spark, d), weather(spark, d), None, opts)
        root = scratch_path(spark, "star")
        write_star(warehouse_tables(built), root, late=late_columns())
        remove_at_exit(spark, root)
        out = {k: v for k, v in built.items() if k.startswith("_")}
        for name in warehouse_tables(built):
            out[name] = spark.read.parquet(os.path.join(root, name)).select(*STAR[name].names)
        _STAR_CACHE[key] = out
    return _STAR_CACHE[key]
