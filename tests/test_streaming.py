"""Incremental loads: book and checkout streams over growing, repeated and interrupted deliveries."""

import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shelfmark.plans.star import fact_id
from shelfmark.sources import warehouse as W
from shelfmark.streaming.incremental import Sides, _new_checkouts, add_checkouts, start_book_stream, start_checkout_stream

CHECKOUTS = "BibNumber,ItemBarcode,ItemType,Collection,CallNumber,CheckoutDateTime\n"
BOOKS = ("BibNum,Title,Author,ISBN,PublicationYear,Publisher,Subjects,ItemType,ItemCollection,FloatingItem,ItemLocation,"
         "ReportDate,ItemCount\n")


def _file(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(header + "".join(",".join(f'"{v}"' for v in r) + "\n" for r in rows))


def checkout(bib, code, when, kind="acbk"):
    return (bib, code.rjust(13, "0"), kind, "x", "y", when)


def book(bib, author, publisher, subjects, kind="acbk"):
    return (bib, f"Title {bib} / x.", author, "", "2001.", publisher, subjects, kind, "", "", "", "", "1")


class Library:
    def __init__(self, spark, root):
        self.spark, self.folder, self.root = spark, root, os.path.join(root, "warehouse")
        self.sides = Sides(
            spark.createDataFrame([("acbk", "ItemType", "Print", "Book"), ("dvd", "ItemType", "Media", "Video")],
                                  "`Code` string, `Code Type` string, `Format Group` string, `Format Subgroup` string"),
            spark.createDataFrame([(1, 1, 2017, 40.0)], "month int, day int, year int, temperature double"),
            spark.createDataFrame([], "bookID string, title string, authors string, average_rating float, isbn string, isbn13 string, "
                                      "ratings_count int, text_reviews_count int, publication_date timestamp"))

    def books(self, name, rows):
        _file(os.path.join(self.folder, "books"), name, BOOKS, rows)

    def checkouts(self, name, rows):
        _file(os.path.join(self.folder, "checkouts"), name, CHECKOUTS, rows)

    def run(self, start, kind):
        path = lambda x: os.path.join(self.folder, x)
        start(self.spark, path(kind), self.root, self.sides, path(f"offsets-{kind}")).awaitTermination(180)

    def load(self):
        self.run(start_book_stream, "books")
        if os.path.isdir(os.path.join(self.folder, "checkouts")):
            self.run(start_checkout_stream, "checkouts")

    def ids(self, name):
        return {r["name"]: r["id"] for r in W.read_table(self.spark, self.root, name).collect()}

    def rows(self, name):
        return W.read_table(self.spark, self.root, name).collect()


@pytest.fixture()
def library(spark, tmp):
    return Library(spark, tmp)


FIRST_BOOKS = [book("1", "Adams, Ann", "Knopf,", "Cats, Dogs"), book("2", "Brown, Bob", "Penguin,", "Dogs"),
               book("9", "Never, Seen", "Disc Co", "Film", kind="dvd")]
MORE_BOOKS = [book("2", "Brown, Bob", "Penguin,", "Dogs"), book("3", "Aaron, Abe", "Ace,", "Ants, Cats"), book("4", "Adams, Ann", "Knopf", "Dogs")]


def test_new_keys_get_the_next_ids_and_old_ones_keep_theirs(library):
    library.books("b1.csv", FIRST_BOOKS)
    library.load()
    assert library.ids("dim_subject") == {"Cats": 0, "Dogs": 1}
    assert library.ids("dim_author") == {"Ann Adams": 0, "Bob Brown": 1}
    assert library.ids("dim_publisher") == {"Knopf": 0, "Penguin": 1}
    library.books("b2.csv", MORE_BOOKS)
    library.load()
    assert library.ids("dim_subject") == {"Cats": 0, "Dogs": 1, "Ants": 2}  # sorts first, comes last
    assert library.ids("dim_author") == {"Ann Adams": 0, "Bob Brown": 1, "Abe Aaron": 2}
    assert library.ids("dim_publisher") == {"Knopf": 0, "Penguin": 1, "Ace": 2}
    assert sorted(r["bib_num"] for r in library.rows("dim_book")) == ["1", "2", "3", "4"]
    assert sorted((r["bib_num"], r["author_id"]) for r in library.rows("br_book_author")) == [("1", 0), ("2", 1), ("3", 2), ("4", 0)]
    assert sorted((r["bib_num"], r["subject_id"]) for r in library.rows("br_book_subject")) == [
        ("1", 0), ("1", 1), ("2", 1), ("3", 0), ("3", 2), ("4", 1)]
    library.books("b3.csv", FIRST_BOOKS + MORE_BOOKS)  # all of it again
    library.load()
    assert library.ids("dim_subject") == {"Cats": 0, "Dogs": 1, "Ants": 2} and len(library.rows("dim_book")) == 4


def test_repeated_checkouts_add_nothing(library):
    library.books("b1.csv", FIRST_BOOKS)
    first = [checkout("1", "1", "01/01/2017 01:00:00 PM"), checkout("2", "2", "01/01/2017 01:00:00 PM", kind="dvd"),
             checkout("1", "1", "01/01/2017 01:00:00 PM")]
    library.checkouts("c1.csv", first)
    library.load()
    assert len(library.rows(W.FACT)) == 1
    second = [checkout("1", "1", "01/01/2017 01:00:00 PM"), checkout("4", "4", "no date"), checkout("2", "3", "02/02/2017 09:00:00 AM")]
    library.checkouts("c2.csv", second)
    library.load()
    fact = library.rows(W.FACT)
    assert len(fact) == 3 and len({r["id"] for r in fact}) == 3
    assert {r["item_barcode"][-1]: (r["temperature"], r["publisher_id"]) for r in fact} == {"1": (40.0, 0), "3": (None, 1), "4": (None, None)}
    assert len(library.rows("dim_checkout_time")) == 3
    library.checkouts("c3.csv", first + second + [checkout("4", "4", "again no date")])
    library.load()
    assert len(library.rows(W.FACT)) == 3  # a bad date is a missing one
    times = library.rows("dim_checkout_time")
    assert len(times) == 3 and sum(r["checkout_datetime"] is None for r in times) == 1


def test_a_killed_batch_is_loaded_once(library, monkeypatch):
    library.books("b1.csv", FIRST_BOOKS)
    library.checkouts("c1.csv", [checkout("1", "1", "01/01/2017 01:00:00 PM")])
    library.load()
    library.books("b2.csv", MORE_BOOKS)
    library.checkouts("c2.csv", [checkout("3", "7", "03/01/2017 01:00:00 PM"), checkout("1", "1", "01/01/2017 01:00:00 PM")])
    before, publish = W.current(library.spark, library.root), W.publish

    def dies(*args):
        raise RuntimeError("executor, driver, everything")
    for kind, start in (("books", start_book_stream), ("checkouts", start_checkout_stream)):
        monkeypatch.setattr(W, "publish", dies)  # everything staged, nothing published
        with pytest.raises(StreamingQueryException):
            library.run(start, kind)
        assert W.current(library.spark, library.root) == before
        monkeypatch.setattr(W, "publish", publish)
        library.run(start, kind)
        before = W.current(library.spark, library.root)
    assert library.ids("dim_subject") == {"Cats": 0, "Dogs": 1, "Ants": 2}
    assert library.ids("dim_author") == {"Ann Adams": 0, "Bob Brown": 1, "Abe Aaron": 2}
    assert {(r["bib_num"], r["publisher_id"]) for r in library.rows(W.FACT)} == {("1", 0), ("3", 2)} and len(library.rows(W.FACT)) == 2

    def dies_after(*args):
        publish(*args)
        raise RuntimeError("published, but the stream never heard of it")
    library.checkouts("c3.csv", [checkout("2", "8", "03/02/2017 01:00:00 PM")])
    monkeypatch.setattr(W, "publish", dies_after)
    with pytest.raises(StreamingQueryException):
        library.run(start_checkout_stream, "checkouts")
    monkeypatch.setattr(W, "publish", publish)
    number = W.current(library.spark, library.root).number
    library.run(start_checkout_stream, "checkouts")
    assert W.current(library.spark, library.root).number == number and len(library.rows(W.FACT)) == 3


def test_stored_facts_are_read_for_the_batch_s_months_only(library, monkeypatch):
    library.books("b1.csv", FIRST_BOOKS)
    library.checkouts("c1.csv", [checkout("1", str(m), f"{m:02d}/05/2016 01:00:00 PM") for m in range(1, 13)])
    library.load()
    plans, read = [], W.read_table

    class Watched:
        def __init__(self, df):
            self.df = df

        def where(self, condition):
            out = self.df.where(condition)
            plans.append(out)
            return out
    monkeypatch.setattr(W, "read_table", lambda s, r, n, at=None: Watched(read(s, r, n, at)) if n == W.FACT else read(s, r, n, at))
    rows = library.spark.createDataFrame([("1", "0" * 12 + "3")], "bib_num string, item_barcode string")
    rows = rows.withColumn("checkout_datetime", F.lit("2016-03-05 13:00:00").cast("timestamp_ntz"))
    add_checkouts(library.spark, library.root, rows, 7, library.sides)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(plans[0].select("id").inputFiles()) >= 1 and plans[0].count() == 1
    monkeypatch.setattr(W, "read_table", read)
    assert len(library.rows(W.FACT)) == 12


def test_increments_become_one_load(library):
    library.books("b1.csv", FIRST_BOOKS)
    library.checkouts("c1.csv", [checkout("1", "1", "01/01/2017 01:00:00 PM")])
    library.load()
    library.checkouts("c2.csv", [checkout("2", "2", "01/03/2017 01:00:00 PM")])
    library.load()
    rows = {n: sorted(map(str, library.rows(n))) for n in W.STAR}
    W.rewrite(library.spark, library.root, buckets=2)
    at = W.current(library.spark, library.root)
    assert all(len(p) == 1 for p in at.parts.values()) and at.batches == {"books": 0, "checkouts": 1}
    assert {n: sorted(map(str, library.rows(n))) for n in W.STAR} == rows
    library.checkouts("c3.csv", [checkout("2", "2", "01/03/2017 01:00:00 PM"), checkout("2", "5", "01/04/2017 01:00:00 PM")])
    library.load()
    assert len(library.rows(W.FACT)) == 3


def test_new_checkouts_are_moved_once_and_without_their_ids(spark):
    rows = "bib_num string, item_barcode string, checkout_datetime timestamp_ntz"
    at = datetime(2017, 1, 1, 13)
    batch = spark.createDataFrame([("1", "a", at), ("1", "a", at), ("2", "b", at), ("2", "b", None), (None, "2=b", None), ("3", "c", at)], rows)
    known = spark.createDataFrame([("3", "c", at)], rows).withColumn("id", fact_id())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = _new_checkouts(batch, known)
        moved = [line for line in new._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
        assert len(moved) == 2  # one of the batch, one of the known ids
        assert sorted(map(tuple, new.collect()), key=str) == sorted([("1", "a", at), ("2", "b", at), (None, "2=b", None)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_checkout_stays_one_row_with_the_smallest_of_several_sides(spark, tmp):
    library = Library(spark, tmp)
    library.sides = Sides(library.sides.dictionary, spark.createDataFrame([(1, 1, 2017, t) for t in (40.0, 30.0, 50.0)],
                          "month int, day int, year int, temperature double"), library.sides.external)
    W.append(spark, library.root, "books", 0, {
        "_dim_publisher_keyed": spark.createDataFrame([(0, "A", "a"), (1, "B", "b")], "id bigint, name string, key string"),
        "_publisher_lookup": spark.createDataFrame([("1", "B", "b"), ("1", "A", "a"), ("2", "A", "a"), ("2", None, None)],
                                                   "bib_num string, publisher string, key string")})
    batch = spark.createDataFrame([("1", "a", datetime(2017, 1, 1, 13)), ("2", "b", datetime(2017, 1, 1, 13))],
                                  "bib_num string, item_barcode string, checkout_datetime timestamp_ntz")
    assert add_checkouts(spark, library.root, batch, 0, library.sides)
    assert {(r["bib_num"], r["temperature"], r["publisher_id"]) for r in library.rows(W.FACT)} == {("1", 30.0, 0), ("2", 30.0, None)}
    assert len(library.rows(W.FACT)) == 2 and len(library.rows("dim_checkout_time")) == 1
