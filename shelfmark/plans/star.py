"""Star-schema builders (B1-B12): dimensions, bridges and the checkout fact.

Inputs are library-shaped DataFrames; column names follow the feeds.  Output
tables use the warehouse DDL names (``ddl.STAR``).  Ids are dense and sorted
by key (``keys.dense_ids``) and every dimension is materialised once, so the
dimension, its bridge and the fact agree on ids (one computation, one truth).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import md5_row_key
from shelfmark.functions.temporal import CHECKOUT_DATETIME_FORMAT, parse_timestamp, time_parts
from shelfmark.functions.text import (clean_publication_year, clean_publisher, clean_title, format_person_name,
                                      normalize_text, split_list)
from shelfmark.operators.keys import dense_ids
from shelfmark.operators.relate import (dedupe_by_key, join_on_date_parts, link_multi_key, lookup_filter_join,
                                        map_or_raw, two_hop_left_join)
from shelfmark.session import stored
from shelfmark.sources.sinks import STAR

# The print-book filter of the data dictionary.
PRINT_BOOK_FILTER = {"Code Type": "ItemType", "Format Group": "Print", "Format Subgroup": "Book"}
# Linked-book columns taken from the external feed.
EXTERNAL_COLUMNS = {"title": "gr_title", "authors": "gr_authors", "publication_date": "gr_publication_date",
                    "average_rating": "gr_average_rating", "ratings_count": "gr_ratings_count",
                    "text_reviews_count": "gr_text_reviews_count"}


@dataclass(frozen=True)
class StarOptions:
    subject_delimiter: str = ", "
    isbn_delimiter: str = ", "
    external_author_delimiter: str = "/"   # D1: one delimiter for dimension and bridge
    prefer_external_authors: bool = False  # D2: False = union of both sources, as the job does
    distinct_bridges: bool = False         # D3: bridges keep duplicates unless asked
    num_partitions: int | None = None


def load_inventory_books(inventory: DataFrame, dictionary: DataFrame) -> DataFrame:
    """B1. Print books of the inventory, one row per BibNum (deterministic)."""
    df = lookup_filter_join(inventory, dictionary, "ItemType", "Code", PRINT_BOOK_FILTER)
    df = df.select(F.col("BibNum").alias("bib_num"), F.col("ISBN").alias("isbns"), F.col("Title").alias("raw_title"),
                   F.col("Author").alias("raw_author"), F.col("PublicationYear").alias("raw_publication_year"),
                   F.col("Publisher").alias("raw_publisher"), F.col("Subjects").alias("raw_subjects"))
    return dedupe_by_key(df, ["bib_num"])


def load_checkout_rows(checkouts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """B2. Print-book checkouts with the time parsed (``h:m:s a`` clock)."""
    df = lookup_filter_join(checkouts, dictionary, "ItemType", "Code", PRINT_BOOK_FILTER)
    return df.select(F.col("BibNumber").alias("bib_num"), F.col("ItemBarcode").alias("item_barcode"),
                     parse_timestamp("CheckoutDateTime", CHECKOUT_DATETIME_FORMAT).alias("checkout_datetime"))


def link_external_books(books: DataFrame, external: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """J4. Inventory + one matching external record (by isbn or isbn13)."""
    ext = external.select("bookID", "isbn", "isbn13", *EXTERNAL_COLUMNS)
    return link_multi_key(books, ext, "bib_num", "isbns", ["isbn", "isbn13"], EXTERNAL_COLUMNS,
                          order_by=["bookID"], delimiter=opts.isbn_delimiter)


def build_subjects(books: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """B3. dim_subject(id, name): distinct subjects, ids in subject order."""
    subjects = books.select(F.explode(split_list("raw_subjects", opts.subject_delimiter)).alias("name")).distinct()
    return dense_ids(subjects, ["name"], "id", num_partitions=opts.num_partitions).select("id", "name")


def build_book_subjects(books: DataFrame, dim_subject: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """B4. br_book_subject(bib_num, subject_id)."""
    pairs = books.select("bib_num", F.explode(split_list("raw_subjects", opts.subject_delimiter)).alias("_s"))
    out = pairs.join(dim_subject.select(F.col("name").alias("_s"), F.col("id").alias("subject_id")), "_s")
    out = out.select("bib_num", "subject_id")
    return out.distinct() if opts.distinct_bridges else out


def book_author_names(books: DataFrame, opts: StarOptions) -> DataFrame:
    local = books.select("bib_num", format_person_name("raw_author").alias("name"))
    ext = books.select("bib_num", F.explode(split_list("gr_authors", opts.external_author_delimiter)).alias("name"))
    if opts.prefer_external_authors:
        has_ext = books.filter(F.col("gr_authors").isNotNull()).select("bib_num")
        local = local.join(has_ext, "bib_num", "left_anti")
    return local.unionByName(ext).dropna()


def build_authors(books: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """B5. dim_author(id, name, key): one row per normalised name; the name
    kept for a key is the smallest spelling (deterministic)."""
    names = book_author_names(books, opts).select("name", normalize_text("name").alias("key"))
    one = dedupe_by_key(names, ["key"], ["name"])
    return dense_ids(one, ["key"], "id", num_partitions=opts.num_partitions).select("id", "name", "key")


def build_book_authors(books: DataFrame, dim_author: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """B6. br_book_author(bib_num, author_id) by normalised name."""
    pairs = book_author_names(books, opts).select("bib_num", normalize_text("name").alias("_k"))
    out = pairs.join(dim_author.select(F.col("key").alias("_k"), F.col("id").alias("author_id")), "_k")
    out = out.select("bib_num", "author_id")
    return out.distinct() if opts.distinct_bridges else out


def publisher_lookup(books: DataFrame, name_map: DataFrame | None) -> DataFrame:
    """B7. (bib_num, publisher, key): official name when mapped, else raw."""
    df = books.select("bib_num", "raw_publisher")
    if name_map is not None:
        df = map_or_raw(df, "raw_publisher", name_map, "publisher", "official_publisher", "publisher")
    else:
        df = df.withColumn("publisher", F.col("raw_publisher"))
    return df.select("bib_num", "publisher", normalize_text("publisher").alias("key"))


def build_publishers(lookup: DataFrame, opts: StarOptions = StarOptions()) -> DataFrame:
    """B8. dim_publisher(id, name, key); a NULL key is one row with a NULL
    name that no fact joins to (D6)."""
    one = dedupe_by_key(lookup.select("key", "publisher"), ["key"], ["publisher"])
    one = one.select("key", clean_publisher("publisher").alias("name"))
    return dense_ids(one, ["key"], "id", num_partitions=opts.num_partitions).select("id", "name", "key")


def build_time_dim(checkouts: DataFrame, ts_col: str = "checkout_datetime") -> DataFrame:
    """B9. dim_checkout_time: one row per distinct checkout time + parts."""
    times = checkouts.select(F.col(ts_col).alias("checkout_datetime")).distinct()
    return times.select("checkout_datetime", *time_parts("checkout_datetime"))


def build_books(books: DataFrame) -> DataFrame:
    """B10. dim_book with cleaned title and year, external ratings."""
    return books.select(
        "bib_num",
        clean_title("raw_title", "gr_title").alias("title"),
        "isbns",
        clean_publication_year("raw_publication_year", "gr_publication_date").alias("publication_year"),
        F.col("gr_average_rating").cast("double").alias("avg_rating"),
        F.col("gr_ratings_count").cast("int").alias("ratings_count"),
        F.col("gr_text_reviews_count").cast("int").alias("text_reviews_count"),
        "raw_title", "raw_author", "raw_publisher", "raw_publication_year")


def fact_id() -> Column:
    """F8. The fact's row id.  It follows from three of its columns, so a writer can add it to
    rows that have been moved already (half of a row's bytes)."""
    return md5_row_key("bib_num", "item_barcode", "checkout_datetime")


def late_columns() -> dict[str, dict[str, Column]]:
    """By table, the columns that the writers add to rows that have been moved already."""
    return {"fact_spl_book_checkout": {"id": fact_id()},
            "dim_checkout_time": dict(zip(STAR["dim_checkout_time"].names[1:], time_parts("checkout_datetime")))}


def build_fact(checkouts: DataFrame, weather: DataFrame, lookup: DataFrame, dim_publisher: DataFrame) -> DataFrame:
    """B11. fact_spl_book_checkout: checkout + day temperature (J5) +
    publisher id through the bib lookup (J6) + md5 row id (F8)."""
    # one fact-side join: the lookup meets the publisher dimension first; it moves the
    # checkouts, so they get their other columns after it
    df = two_hop_left_join(checkouts.select("bib_num", "item_barcode", "checkout_datetime"), lookup, dim_publisher,
                           "bib_num", "bib_num", "key", "key", {"id": "publisher_id"})
    df = join_on_date_parts(df, "checkout_datetime", weather,
                            columns=[F.col("temperature").cast("double").alias("temperature")])
    df = df.withColumn("id", fact_id())
    return df.select("bib_num", "item_barcode", "checkout_datetime", "temperature", "publisher_id", "id")


def build_star_from_books(books: DataFrame, checkouts: DataFrame, weather: DataFrame,
                          name_map: DataFrame | None = None, opts: StarOptions = StarOptions()) -> dict[str, DataFrame]:
    """B12 core: the eight tables from linked books, checkouts and weather.

    ``books`` feeds four builders and the fact, so it is materialised once.  So is
    ``weather``: the planner then knows the size of the daily rows, not only that of the rows
    they were averaged from, and does not shuffle the checkouts to join them."""
    books = stored(books, "books")
    weather = stored(weather, "weather")
    dim_subject = build_subjects(books, opts)
    dim_author = build_authors(books, opts)
    lookup = stored(publisher_lookup(books, name_map), "publisher-lookup")
    dim_publisher = build_publishers(lookup, opts)
    return {
        "dim_book": build_books(books),
        "dim_author": dim_author.select("id", "name"),
        "dim_subject": dim_subject,
        "dim_publisher": dim_publisher.select("id", "name"),
        "dim_checkout_time": build_time_dim(checkouts),
        "br_book_author": build_book_authors(books, dim_author, opts),
        "br_book_subject": build_book_subjects(books, dim_subject, opts),
        "fact_spl_book_checkout": build_fact(checkouts, weather, lookup, dim_publisher),
        # intermediates other builders and questions reuse (not warehouse tables)
        "_books": books,
        "_publisher_lookup": lookup,
        "_dim_publisher_keyed": dim_publisher,
        "_dim_author_keyed": dim_author,
    }


def warehouse_tables(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Only the eight warehouse tables of a ``build_star`` result."""
    return {k: v for k, v in star.items() if not k.startswith("_")}


def build_star(inventory: DataFrame, dictionary: DataFrame, checkouts: DataFrame, external: DataFrame,
               weather: DataFrame, name_map: DataFrame | None = None,
               opts: StarOptions = StarOptions()) -> dict[str, DataFrame]:
    """B12. Raw feeds -> the eight star tables (lazy except for the
    materialised books and dimension ids)."""
    books = link_external_books(load_inventory_books(inventory, dictionary), external, opts)
    co = load_checkout_rows(checkouts, dictionary)
    return build_star_from_books(books, co, weather, name_map, opts)
