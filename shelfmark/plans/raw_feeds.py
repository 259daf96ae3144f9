"""The raw-feed path: driver tables written as the library's own feed files
(CSV with header, headerless CSV, blank-separated text, JSON objects), read
back by the feed readers and run through the builders.

Files go to a scratch folder of the shared storage; what a query returns is
checkpointed, and the files are removed.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.temporal import CHECKOUT_DATETIME_FORMAT, EXTERNAL_DATE_FORMAT
from shelfmark.plans import catalog as C
from shelfmark.plans.star import (build_authors, build_books, build_fact, build_publishers, build_star, link_external_books,
                                  load_checkout_rows, load_inventory_books, publisher_lookup)
from shelfmark.session import materialize, remove_at_exit, remove_path, scratch_path, stored
from shelfmark.sources import feeds
from shelfmark.sources.sinks import write_csv
from shelfmark.sources.tables import table


def _item_type(key) -> F.Column:
    """Five item types by the part key; three of them are print books."""
    return F.concat(F.lit("t"), (F.col(key).cast("bigint") % 5).cast("string"))


def _headed(df: DataFrame, path: str) -> None:
    write_csv(df, path, header=True)


def write_feeds(spark: SparkSession, d: str, root: str) -> None:
    """The six feeds below ``root``."""
    inv = C.inventory(spark, d)
    _headed(inv.select(F.col("bib_num").alias("BibNum"), F.col("raw_title").alias("Title"), F.col("raw_author").alias("Author"),
                       F.col("isbns").alias("ISBN"), F.col("raw_publication_year").alias("PublicationYear"),
                       F.col("raw_publisher").alias("Publisher"), F.col("raw_subjects").alias("Subjects"),
                       _item_type("bib_num").alias("ItemType")), os.path.join(root, "inventory"))
    nation = table(spark, d, "nation").filter("n_nationkey < 10")
    kind = F.col("n_nationkey")
    _headed(nation.select(F.concat(F.lit("t"), (kind % 5).cast("string")).alias("Code"),
                          F.when(kind < 5, "ItemType").otherwise("ItemCollection").alias("Code Type"),
                          F.when(kind % 2 == 0, "Print").otherwise("Media").alias("Format Group"),
                          F.lit("Book").alias("Format Subgroup")), os.path.join(root, "dictionary"))
    co = C.checkouts(spark, d)
    _headed(co.select(F.col("bib_num").alias("BibNumber"), F.col("item_barcode").alias("ItemBarcode"),
                      _item_type("bib_num").alias("ItemType"), F.lit("c").alias("Collection"), F.lit("n").alias("CallNumber"),
                      F.date_format("checkout_datetime", CHECKOUT_DATETIME_FORMAT).alias("CheckoutDateTime")),
            os.path.join(root, "checkouts"))
    ext = C.external_books(spark, d)
    _headed(ext.select("bookID", "title", "authors", F.col("average_rating").cast("float").alias("average_rating"), "isbn", "isbn13",
                       F.lit("en").alias("language_code"), F.lit(1).alias("  num_pages"), "ratings_count", "text_reviews_count",
                       F.date_format("publication_date", EXTERNAL_DATE_FORMAT).alias("publication_date"),
                       F.lit("p").alias("publisher")), os.path.join(root, "external"))
    w = C.weather(spark, d)
    line = F.concat_ws("   ", F.col("month").cast("string"), F.col("day").cast("string"), F.col("year").cast("string"),
                       F.col("temperature").cast("string"))
    w.select(F.concat(F.lit(" "), line)).write.text(os.path.join(root, "weather"))


@contextmanager
def feed_folder(spark: SparkSession, name: str):
    root = scratch_path(spark, name)
    try:
        yield root
    finally:
        remove_path(spark, root)


_FEEDS: dict[tuple[str, str], str] = {}


def feeds_of(spark: SparkSession, d: str) -> str:
    """The folder of the six feeds, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FEEDS:
        root = scratch_path(spark, "feeds")
        write_feeds(spark, d, root)
        remove_at_exit(spark, root)
        _FEEDS[key] = root
    return _FEEDS[key]


def star_from_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """B12 from the files: S1, S2, S4 readers, B1, B2 and the builders."""
    inventory, dictionary, checkouts, external, weather = _read_feeds(spark, root)
    return build_star(inventory, dictionary, checkouts, external, weather)


def _read_feeds(spark: SparkSession, root: str) -> tuple[DataFrame, ...]:
    return (feeds.load_inventory(spark, os.path.join(root, "inventory")),
            feeds.load_data_dictionary(spark, os.path.join(root, "dictionary")),
            feeds.read_header_csv(spark, os.path.join(root, "checkouts"), feeds.CHECKOUT_COLUMNS),
            feeds.load_external_books(spark, os.path.join(root, "external")),
            feeds.load_weather(spark, os.path.join(root, "weather")))


def raw_star_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One table of the star from the files, by the builders that it needs."""
    inventory, dictionary, checkouts, external, weather = _read_feeds(spark, feeds_of(spark, d))
    books = stored(link_external_books(load_inventory_books(inventory, dictionary), external), "books")
    if name == "dim_book":
        return build_books(books)
    if name == "dim_author":
        return build_authors(books).select("id", "name")
    lookup = stored(publisher_lookup(books, None), "publisher-lookup")
    return build_fact(load_checkout_rows(checkouts, dictionary), weather, lookup, build_publishers(lookup))


def name_map(spark: SparkSession, d: str) -> DataFrame:
    """A headerless two-column file, written and read."""
    p = table(spark, d, "part").select(F.concat(F.col("p_brand"), F.lit(", the ")).alias("raw"), "p_brand").distinct()
    with feed_folder(spark, "name-map") as root:
        write_csv(p, root)
        return materialize(feeds.load_name_map(spark, root))


def gazetteer(spark: SparkSession, d: str) -> DataFrame:
    """A one-column file with blank lines."""
    names = table(spark, d, "part").select(F.col("p_name").alias("publisher")).distinct()
    blank = table(spark, d, "nation").select(F.lit("  ").alias("publisher"))
    with feed_folder(spark, "gazetteer") as root:
        _headed(names.unionByName(blank), root)
        return materialize(feeds.read_gazetteer(spark, root))


def _named(spark: SparkSession, folder: str, target: str) -> None:
    """The part files below ``<folder>/file_key=<key>/`` as ``<target>/<key>_<n>.json``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(target))
    for part in fs.globStatus(hadoop.Path(folder, "file_key=*/part-*")):
        path = part.getPath()
        key = path.getParent().getName().removeprefix("file_key=")
        fs.rename(path, hadoop.Path(target, f"{key}_{path.getName().split('-')[1]}.json"))


def json_map_files(spark: SparkSession, d: str) -> DataFrame:
    """One JSON object a file, files named by their key."""
    e = table(spark, d, "events")
    per = e.groupBy(F.col("event_type").alias("file_key")).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_set(F.struct(
        F.unix_timestamp(F.date_trunc("day", "ts").cast("timestamp")).cast("string").alias("k"), F.col("event_type").alias("v")))))).alias("value"))
    with feed_folder(spark, "json-maps") as root:
        per.repartition("file_key").write.partitionBy("file_key").text(os.path.join(root, "parts"))
        _named(spark, os.path.join(root, "parts"), os.path.join(root, "files"))
        return stored(feeds.read_json_map_files(spark, os.path.join(root, "files")), "json-maps")
