"""Readers for the raw library feeds.

All readers use explicit schemas (no inference pass over the data) and lenient
``try_*`` parsing, so a malformed value becomes NULL instead of failing a job
on a 100 TB input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.temporal import CHECKOUT_DATETIME_FORMAT, EXTERNAL_DATE_FORMAT, parse_timestamp
from shelfmark.functions.text import first_list_item_links

# Column layouts of the feeds.
INVENTORY_COLUMNS = ["BibNum", "Title", "Author", "ISBN", "PublicationYear", "Publisher", "Subjects",
                     "ItemType", "ItemCollection", "FloatingItem", "ItemLocation", "ReportDate", "ItemCount"]
CHECKOUT_COLUMNS = ["BibNumber", "ItemBarcode", "ItemType", "Collection", "CallNumber", "CheckoutDateTime"]
EXTERNAL_BOOK_SCHEMA = T.StructType([
    T.StructField("bookID", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("average_rating", T.FloatType()),
    T.StructField("isbn", T.StringType()),
    T.StructField("isbn13", T.StringType()),
    T.StructField("language_code", T.StringType()),
    T.StructField("  num_pages", T.IntegerType()),  # the feed pads this header with two blanks
    T.StructField("ratings_count", T.IntegerType()),
    T.StructField("text_reviews_count", T.IntegerType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("publisher", T.StringType()),
])


#: Quotes inside quoted fields are doubled, as library exports write them.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def read_header_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """S1. Header CSV, every column a string.  ``path`` may be a glob (one file
    per year).  With ``columns`` the schema is fixed up front, so no header
    sampling job runs.  ``multi_line`` is for files whose quoted fields hold line
    breaks; such a file is read by one task."""
    reader = spark.read.options(**CSV_OPTIONS).option("header", "true").option("mode", "PERMISSIVE").option("multiLine", str(multi_line).lower())
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def load_external_books(spark: SparkSession, path: str) -> DataFrame:
    """S2. External book feed: 12 typed fields, padded header renamed,
    ``M/d/yyyy`` date parsed to a timestamp (NULL when malformed)."""
    df = spark.read.options(**CSV_OPTIONS).schema(EXTERNAL_BOOK_SCHEMA).option("header", "true").csv(path)
    return (df.withColumn("publication_date", parse_timestamp("publication_date", EXTERNAL_DATE_FORMAT))
              .withColumnRenamed("  num_pages", "num_pages"))


def load_name_map(spark: SparkSession, path: str, raw: str = "publisher",
                  official: str = "official_publisher") -> DataFrame:
    """S3. Headerless two-column CSV (raw name, official name)."""
    schema = T.StructType([T.StructField(raw, T.StringType()), T.StructField(official, T.StringType())])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """S4. Blank-separated text: month, day, year, temperature per line; any
    run of blanks separates fields; blank lines are skipped."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return (spark.read.text(path)
            .filter(F.trim(F.col("value")) != "")
            .select(F.get(parts, 0).try_cast("int").alias("month"),
                    F.get(parts, 1).try_cast("int").alias("day"),
                    F.get(parts, 2).try_cast("int").alias("year"),
                    F.get(parts, 3).try_cast("float").alias("temperature")))


def explode_json_map(df: DataFrame, key_col: str, json_col: str, key_name: str = "map_key",
                     value_name: str = "map_value") -> DataFrame:
    """S5 core: one JSON object per row -> one row per (row key, map key, value)."""
    m = F.from_json(F.col(json_col), T.MapType(T.StringType(), T.StringType()))
    return df.select(F.col(key_col), F.explode(m).alias(key_name, value_name))


def read_json_map_files(spark: SparkSession, path: str, key_name: str = "file_key") -> DataFrame:
    """S5. One JSON object per file; the file key is the base name up to the
    first ``_``.  Files are read whole and spread over tasks by Spark."""
    files = (spark.read.text(path, wholetext=True)
             .select(F.substring_index(F.col("_metadata.file_name"), "_", 1).alias(key_name), "value"))
    return explode_json_map(files, key_name, "value", "map_key", "map_value")


def extract_list_links(pages: DataFrame, id_col: str, html_col: str,
                       exclude_prefix: str = "List of ", tag: str | None = None,
                       css_class: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S6. First link text of each list item, minus texts starting with
    ``exclude_prefix``.  Returns (links, dropped count per page)."""
    all_links = first_list_item_links(html_col, None, tag, css_class)
    base = pages.select(F.col(id_col), all_links.alias("_links"))
    links = base.select(F.col(id_col), F.explode("_links").alias("link_text")) \
                .filter(~F.col("link_text").startswith(exclude_prefix))
    dropped = base.select(F.col(id_col), F.size(F.filter("_links", lambda t: t.startswith(exclude_prefix)))
                          .alias("n_dropped"))
    return links, dropped


def read_html_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files as (page_id = file name, html) rows."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("page_id"), F.col("value").alias("html"))


def read_gazetteer(spark: SparkSession, path: str, column: str = "publisher") -> DataFrame:
    """S7. One-column header CSV of official names; blank lines dropped."""
    df = read_header_csv(spark, path, [column])
    return df.filter(F.col(column).isNotNull() & (F.trim(F.col(column)) != ""))


def limit_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """S8/S14. First ``n`` rows (0 = all).  With ``order_by`` the rows are the
    same on every run (a top-n, planned as TakeOrderedAndProject)."""
    if not n:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def load_checkouts(spark: SparkSession, path: str) -> DataFrame:
    """Raw checkout feed (all strings, columns named by the header)."""
    return read_header_csv(spark, path)


def load_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_header_csv(spark, path)


def load_data_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return read_header_csv(spark, path)


__all__ = [
    "CHECKOUT_DATETIME_FORMAT", "read_header_csv", "load_external_books", "load_name_map", "load_weather",
    "explode_json_map", "read_json_map_files", "extract_list_links", "read_html_pages", "read_gazetteer",
    "limit_rows", "load_checkouts", "load_inventory", "load_data_dictionary",
]
