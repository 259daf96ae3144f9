"""Incremental loads with Structured Streaming.

Two streams over landing folders, one of inventory files and one of checkout
files, add to a warehouse folder (``sources.warehouse``).  Every micro-batch:

books      keeps print books whose number is not stored, links the external
           feed, gives new subjects, author names and publishers the ids after the largest
           stored one (known keys keep theirs), and adds books, bridges and lookup rows;
checkouts  drops rows whose md5 id occurs twice or is stored, builds fact rows of the others
           with the stored publishers, and adds them and the times that are new.

Stored facts are read for that check only where year and month are those of the
batch (partition pruning).  All tables of a batch become visible at once, when its version
is published.  A batch that dies before is staged again from the start; one that dies
after it is recognised by its number and left alone.  So a re-delivered file, a repeated
row and a re-run batch all add nothing, and no id is given twice or skipped.

Run the book stream before the checkout stream: a checkout of a book that is
not stored yet gets no publisher, and keeps none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.text import clean_publisher, normalize_text, split_list
from shelfmark.operators.keys import append_new_keys
from shelfmark.operators.relate import dedupe_by_key
from shelfmark.plans.star import (StarOptions, book_author_names, build_book_authors, build_book_subjects, build_books,
                                  build_fact, build_time_dim, fact_id, late_columns, link_external_books,
                                  load_checkout_rows, load_inventory_books, publisher_lookup)
from shelfmark.session import stored
from shelfmark.sources import warehouse as W
from shelfmark.sources.feeds import CHECKOUT_COLUMNS, CSV_OPTIONS, INVENTORY_COLUMNS


@dataclass(frozen=True)
class Sides:
    """The tables that a batch is joined with."""
    dictionary: DataFrame
    weather: DataFrame
    external: DataFrame
    name_map: DataFrame | None = None
    options: StarOptions = StarOptions()


def _new(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not known; NULL is a key."""
    return rows.join(known.select(F.col(key).alias("_known")), F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def add_books(spark: SparkSession, root: str, books: DataFrame, batch_id: int, sides: Sides, stream: str = "books") -> bool:
    """Print books (B1 rows) of one batch: new books, keys and bridges.  False if the batch is in already."""
    at = W.current(spark, root)
    if at.batches.get(stream, -1) >= batch_id:
        return False
    opts = sides.options
    new = stored(link_external_books(_new(books, W.read_table(spark, root, "dim_book", at), "bib_num"), sides.external, opts), "new-books")
    subjects = new.select(F.explode(split_list("raw_subjects", opts.subject_delimiter)).alias("name")).distinct()
    more_subjects, all_subjects = append_new_keys(W.read_table(spark, root, "dim_subject", at), subjects, "name")
    names = book_author_names(new, opts).select("name", normalize_text("name").alias("key"))
    authors = dedupe_by_key(names, ["key"], ["name"])
    more_authors, all_authors = append_new_keys(W.read_table(spark, root, "_dim_author_keyed", at), authors, "key")
    lookup = stored(publisher_lookup(new, sides.name_map), "new-lookup")
    publishers = dedupe_by_key(lookup.select("key", "publisher"), ["key"], ["publisher"])
    publishers = publishers.select("key", clean_publisher("publisher").alias("name"))
    more_publishers, _ = append_new_keys(W.read_table(spark, root, "_dim_publisher_keyed", at), publishers, "key")
    return W.append(spark, root, stream, batch_id, {
        "dim_book": build_books(new), "dim_subject": more_subjects, "dim_author": more_authors, "dim_publisher": more_publishers,
        "br_book_subject": build_book_subjects(new, all_subjects, opts), "br_book_author": build_book_authors(new, all_authors, opts),
        "_dim_author_keyed": more_authors, "_dim_publisher_keyed": more_publishers, "_publisher_lookup": lookup})


def add_checkouts(spark: SparkSession, root: str, checkouts: DataFrame, batch_id: int, sides: Sides, stream: str = "checkouts") -> bool:
    """Checkouts (B2 rows) of one batch: new fact rows and times.  False if the batch is in already."""
    at = W.current(spark, root)
    if at.batches.get(stream, -1) >= batch_id:
        return False
    # as many rows as the batch has months
    when = [F.year("checkout_datetime").alias("y"), F.month("checkout_datetime").alias("m")]
    months = checkouts.groupBy(*when).agg(F.min("checkout_datetime").alias("lo"), F.max("checkout_datetime").alias("hi")).collect()
    same_month = F.lit(False)
    for r in months:
        same_month = same_month | (F.col("year").eqNullSafe(F.lit(r["y"])) & F.col("month").eqNullSafe(F.lit(r["m"])))
    lo = min((r["lo"] for r in months if r["lo"] is not None), default=None)
    hi = max((r["hi"] for r in months if r["hi"] is not None), default=None)
    in_range = F.col("checkout_datetime").isNull() | F.col("checkout_datetime").between(F.lit(lo), F.lit(hi))
    known = W.read_table(spark, root, W.FACT, at).where(same_month & in_range)
    new = build_fact(_new_checkouts(checkouts, known), *_one_each(
        sides.weather, W.read_table(spark, root, "_publisher_lookup", at), W.read_table(spark, root, "_dim_publisher_keyed", at)))
    times = W.read_table(spark, root, "dim_checkout_time", at).where(in_range)
    return W.append(spark, root, stream, batch_id, {W.FACT: new}, late=late_columns(), derived={
        "dim_checkout_time": lambda staged: _new(build_time_dim(staged(W.FACT)), times, "checkout_datetime")})


def _new_checkouts(checkouts: DataFrame, known: DataFrame) -> DataFrame:
    """One row (the smallest) per id that is not known.  Rows are dealt by their id before they have it, so
    it is not moved, and the join and the choice share that one shuffle and one sort.  Ids are compared as bytes."""
    rows = checkouts.select("bib_num", "item_barcode", "checkout_datetime").repartition(F.unhex(fact_id()))
    rows = rows.withColumn("_key", F.unhex(fact_id()))
    new = rows.join(known.select(F.unhex("id").alias("_known")), F.col("_key") == F.col("_known"), "left_anti")
    return dedupe_by_key(new, ["_key"]).drop("_key")


def _one_each(weather: DataFrame, lookup: DataFrame, keyed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One temperature a day, one publisher a book, the smallest of several (NULL first), so a checkout stays one row."""
    weather = weather.select("year", "month", "day", F.col("temperature").cast("double").alias("temperature"))
    keyed = dedupe_by_key(keyed.select("key", "id"), ["key"])
    ids = keyed.select(F.col("key").alias("_k"), "id")
    found = lookup.join(ids, F.col("key") == F.col("_k"), "left").select("bib_num", "id", "key")
    return (stored(dedupe_by_key(weather, ["year", "month", "day"]), "daily"),
            dedupe_by_key(found, ["bib_num"], ["id"]).select("bib_num", "key"), keyed)


# ---- streams -----------------------------------------------------------------

def _started(spark: SparkSession, source: str, columns: list[str], add: Callable[[DataFrame, int], object], checkpoint: str,
             available_now: bool, max_files_per_trigger: int | None) -> StreamingQuery:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.options(**CSV_OPTIONS).schema(schema).option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.csv(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_book_stream(spark: SparkSession, source: str, root: str, sides: Sides, checkpoint: str, available_now: bool = True,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Over CSV inventory files in ``source`` (header, all strings).  ``available_now`` processes what is there and stops."""
    def add(batch: DataFrame, batch_id: int) -> None:
        add_books(batch.sparkSession, root, load_inventory_books(batch, sides.dictionary), batch_id, sides)
    return _started(spark, source, INVENTORY_COLUMNS, add, checkpoint, available_now, max_files_per_trigger)


def start_checkout_stream(spark: SparkSession, source: str, root: str, sides: Sides, checkpoint: str, available_now: bool = True,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Over CSV checkout files in ``source`` (header, all strings)."""
    def add(batch: DataFrame, batch_id: int) -> None:
        add_checkouts(batch.sparkSession, root, load_checkout_rows(batch, sides.dictionary), batch_id, sides)
    return _started(spark, source, CHECKOUT_COLUMNS, add, checkpoint, available_now, max_files_per_trigger)
