"""The star build from small library-shaped feeds (FIXTURES.md §1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import quality
from shelfmark.plans.star import StarOptions, build_star, build_star_from_books, late_columns, warehouse_tables
from shelfmark.sources.sinks import write_parquet

DICT = [("acbk", "ItemType", "Print", "Book"), ("acdvd", "ItemType", "Media", "Video"),
        ("acbk", "ItemCollection", "Print", "Book"), ("jcbk", "ItemType", "Print", "Book")]
INV = [
    # BibNum, Title, Author, ISBN, PublicationYear, Publisher, Subjects, ItemType, ItemLocation
    ("1", "The only child : a novel / Andrew Pyper.", "Pyper, Andrew", "111, 222", "2008.", "Schocken Books,",
     "Fiction, Thrillers", "acbk", "cen"),
    ("1", "The only child : a novel / Andrew Pyper.", "Pyper, Andrew", "111, 222", "2008.", "Schocken Books,",
     "Fiction, Thrillers", "acbk", "bal"),
    ("2", "Avi book", "Avi, 1937-", "333", "1991, c1988.", None, None, "jcbk", "cen"),
    ("3", "A film", "Someone", "444", "2000", "Studio", "Film", "acdvd", "cen"),
    ("4", "No isbn", None, None, "n.d.", "Schocken books", "Fiction", "acbk", "cen"),
]
EXT = [("10", "The Only Child", "Andrew Pyper/Jane Roe", 3.58, "111", "9780000000111", "2008-01-01"),
       ("11", "Other edition", "Andrew Pyper", 4.0, "999", "222", "2009-01-01"),
       ("12", "Avi Title", "Avi", 5.0, "x", "333", None)]
CO = [("1", "0010000000001", "acbk", "01/01/2017 01:02:03 PM"), ("1", "0010000000001", "acbk", "01/01/2017 01:02:03 PM"),
      ("2", "0010000000002", "jcbk", "01/02/2017 10:00:00 AM"), ("3", "0010000000003", "acdvd", "01/02/2017 10:00:00 AM"),
      ("4", "0010000000004", "acbk", "bad date")]
WEATHER = [(1, 1, 2017, 40.0), (1, 2, 2017, -99.0)]


@pytest.fixture(scope="module")
def star(spark):
    d = spark.createDataFrame(DICT, "`Code` string, `Code Type` string, `Format Group` string, `Format Subgroup` string")
    inv = spark.createDataFrame(INV, "BibNum string, Title string, Author string, ISBN string, "
                                     "PublicationYear string, Publisher string, Subjects string, ItemType string, "
                                     "ItemLocation string")
    ext = spark.createDataFrame(EXT, "bookID string, title string, authors string, average_rating float, "
                                     "isbn string, isbn13 string, d string") \
        .withColumn("publication_date", F.col("d").cast("timestamp_ntz")).drop("d") \
        .withColumn("ratings_count", F.lit(1)).withColumn("text_reviews_count", F.lit(0))
    co = spark.createDataFrame(CO, "BibNumber string, ItemBarcode string, ItemType string, CheckoutDateTime string")
    w = spark.createDataFrame(WEATHER, "month int, day int, year int, temperature float")
    return build_star(inv, d, co, ext, w)


def test_print_books_only_and_one_row_per_bib(star):
    books = {r.bib_num: r for r in star["dim_book"].collect()}
    assert sorted(books) == ["1", "2", "4"]
    assert books["1"].title == "The Only Child"         # external title wins
    assert books["1"].publication_year == 2008
    assert books["2"].publication_year == 1988            # no external date: smallest year of the text
    assert books["4"].title == "No isbn" and books["4"].avg_rating is None


def test_dense_sorted_ids(star):
    subj = star["dim_subject"].orderBy("id").collect()
    assert [r.id for r in subj] == list(range(len(subj)))
    assert [r.name for r in subj] == sorted(r.name for r in subj)
    for name in ("dim_author", "dim_publisher"):
        ids = sorted(r.id for r in star[name].collect())
        assert ids == list(range(len(ids)))


def test_bridges_resolve(star):
    authors = {r.id: r.name for r in star["dim_author"].collect()}
    pairs = {(r.bib_num, authors[r.author_id]) for r in star["br_book_author"].collect()}
    assert ("1", "Andrew Pyper") in pairs and ("1", "Jane Roe") in pairs and ("2", "Avi") in pairs
    subj = {r.id: r.name for r in star["dim_subject"].collect()}
    assert {(r.bib_num, subj[r.subject_id]) for r in star["br_book_subject"].collect()} == {
        ("1", "Fiction"), ("1", "Thrillers"), ("4", "Fiction")}


def test_publishers_normalised_and_cleaned(star):
    names = sorted((r.name for r in star["dim_publisher"].collect()), key=str)
    # "Schocken Books," and "Schocken books" share one key; NULL publisher is one row
    assert len(names) == 2 and None in names


def test_fact(star):
    fact = star["fact_spl_book_checkout"].collect()
    assert len(fact) == 4                     # print books: 1 (twice), 2, 4 (bad date kept as NULL time)
    by = {(r.bib_num, r.checkout_datetime): r for r in fact}
    r1 = by[("1", dt.datetime(2017, 1, 1, 13, 2, 3))]
    assert r1.temperature == 40.0 and r1.publisher_id is not None and len(r1.id) == 32
    assert by[("2", dt.datetime(2017, 1, 2, 10, 0))].temperature == -99.0
    assert by[("4", None)].temperature is None


def test_time_dim_weekday_week(spark):
    from shelfmark.plans.star import build_time_dim
    df = spark.createDataFrame([(dt.datetime(2017, 1, 1, 9, 30),)], "checkout_datetime timestamp_ntz")
    r = build_time_dim(df).first()
    assert (r.weekday, r.week, r.hour, r.day, r.month, r.year) == (1, 52, 9, 1, 1, 2017)


def test_quality_reports_every_check(star):
    res = quality.quality_checks(warehouse_tables(star)).collect()
    checks = {(r.check_name, r.table_name, r.column_name): r for r in res}
    assert checks[("non_empty", "fact_spl_book_checkout", "checkout_datetime")].passed
    assert checks[("rating_max", "dim_book", "avg_rating")].passed
    assert checks[("barcode_length", "fact_spl_book_checkout", "item_barcode")].passed
    # the NULL checkout time violates NOT NULL, and one NULL time row reaches the time dimension
    assert not checks[("not_null", "fact_spl_book_checkout", "checkout_datetime")].passed
    # identical checkouts in the same minute collide on the md5 id
    assert not checks[("unique_key", "fact_spl_book_checkout", "id")].passed
    assert all(r.passed for r in res if r.check_name == "foreign_key")
    with pytest.raises(AssertionError):
        quality.raise_on_failure(quality.quality_checks(warehouse_tables(star)))


def test_rebuild_is_identical(spark, star):
    """Ids do not depend on partitioning: a rebuild with other partition
    counts gives the same dimension rows."""
    from shelfmark.plans.star import build_authors, build_subjects
    books = star["_books"]
    for fn, name in ((build_authors, "dim_author"), (build_subjects, "dim_subject")):
        again = fn(books.repartition(3), StarOptions(num_partitions=2)).select(*star[name].columns)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, star[name].collect()))


def test_distinct_bridges_option(star):
    from shelfmark.plans.star import build_book_subjects
    br = build_book_subjects(star["_books"], star["dim_subject"], StarOptions(distinct_bridges=True))
    assert br.count() == br.distinct().count()


def test_cached_star_keeps_options_apart(spark):
    from shelfmark.plans import catalog
    d = "/root/testdata/sf0.001"
    plain = catalog.star(spark, d)
    other = catalog.star(spark, d, StarOptions(distinct_bridges=True, prefer_external_authors=True))
    assert plain is not other and catalog.star(spark, d) is plain
    assert other["br_book_author"].count() < plain["br_book_author"].count()


def test_books_per_publisher_counts_books_never_borrowed(spark, star):
    from shelfmark.plans.analytics import books_per_publisher
    out = {r.publisher: r.n_books for r in books_per_publisher(star["_publisher_lookup"], star["_dim_publisher_keyed"]).collect()}
    assert sum(out.values()) == 3 and 2 in out.values()


def test_checkouts_are_not_shuffled_to_meet_a_day(spark):
    """The daily rows are small, whatever they were averaged from."""
    books = spark.createDataFrame([("1", "9", "Title / x.", "Ann", "2001.", "Ace", "Cats", None, None, None, None, None, None)],
                                  "bib_num string, isbns string, raw_title string, raw_author string, raw_publication_year string, "
                                  "raw_publisher string, raw_subjects string, gr_title string, gr_authors string, "
                                  "gr_publication_date timestamp, gr_average_rating float, gr_ratings_count int, gr_text_reviews_count int")
    checkouts = spark.range(200_000).select(F.lit("1").alias("bib_num"), F.col("id").cast("string").alias("item_barcode"),
                                            F.expr("timestamp_ntz'2017-01-01 10:00:00' + make_dt_interval(0, 0, 0, id % 60)")
                                            .alias("checkout_datetime"))
    weather = spark.range(200_000).groupBy((F.col("id") % 28 + 1).cast("int").alias("day")).agg(F.avg("id").alias("temperature"))
    weather = weather.select((F.col("day") * 0 + 2017).alias("year"), (F.col("day") * 0 + 1).alias("month"), "day", "temperature")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000000")
    try:
        fact = build_star_from_books(books, checkouts, weather)["fact_spl_book_checkout"]
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [year(" in plan and "SortMergeJoin [year(" not in plan
        row = fact.agg(F.count("id"), F.max("temperature"), F.min("publisher_id")).first()
        assert row[0] == 200_000 and row[1] == sum(range(0, 200_000, 28)) / len(range(0, 200_000, 28)) and row[2] == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_late_columns_are_computed_after_the_rows_are_moved(spark, tmp):
    df = spark.range(100).select((F.col("id") % 3).alias("month"), "id", F.expr("raise_error('moved')").cast("string").alias("row"))
    late = {"row": F.md5(F.col("id").cast("string"))}
    write_parquet(df, tmp + "/months", partition_by=["month"], sort_within=["month", "id"], late=late)
    write_parquet(df, tmp + "/whole", rebalance=True, late=late)
    for path in ("months", "whole"):
        out = spark.read.parquet(f"{tmp}/{path}")
        assert out.count() == out.where(F.col("row") == late["row"]).count() == 100
    assert spark.read.parquet(f"{tmp}/whole").columns == ["month", "id", "row"]


def test_late_columns_are_those_of_the_builders(spark, star):
    for name, late in late_columns().items():
        same = star[name].where(F.lit(True) if not late else ~F.greatest(*[~F.col(c).eqNullSafe(e) for c, e in late.items()], F.lit(False)))
        assert same.count() == star[name].count() > 0
