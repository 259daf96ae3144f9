"""The analytic questions the star schema is built to answer.

Scale choices
- Time attributes that are pure functions of the checkout timestamp (year,
  weekday, hour) are computed from the fact's own column; joining the time
  dimension would only add a shuffle of the largest table.
- Bridge questions first reduce the fact to one row per (book, ...) with a
  map-side-combined aggregate, and only then join the bridge, so the fan-out
  join sees books, not checkouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.rank import top_k_per_group
from shelfmark.operators.relate import never_referenced


def _checkouts_per_book(fact: DataFrame, *extra) -> DataFrame:
    return fact.groupBy("bib_num", *extra).agg(F.count(F.lit(1)).alias("n"))


def top_books_per_year(fact: DataFrame, k: int = 10) -> DataFrame:
    """N1. The ``k`` most checked-out books of every year (ties by bib_num)."""
    per = _checkouts_per_book(fact, F.year("checkout_datetime").alias("year"))
    return top_k_per_group(per, ["year"], [F.col("n").desc(), F.col("bib_num").asc()], k)


def checkouts_by_weekday(fact: DataFrame) -> DataFrame:
    """N2. Checkouts per weekday (1 = Sunday), most popular first."""
    return (fact.groupBy(F.dayofweek("checkout_datetime").alias("weekday"))
                .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "weekday"))


def hour_by_subject(fact: DataFrame, bridge: DataFrame, dim_subject: DataFrame) -> DataFrame:
    """N3. Checkouts per (subject, hour of day)."""
    per = _checkouts_per_book(fact, F.hour("checkout_datetime").alias("hour"))
    joined = per.join(bridge, "bib_num").groupBy("subject_id", "hour").agg(F.sum("n").alias("n"))
    return joined.join(dim_subject.select(F.col("id").alias("subject_id"), F.col("name").alias("subject")),
                       "subject_id").select("subject_id", "subject", "hour", "n")


def books_never_checked_out(dim_book: DataFrame, fact: DataFrame) -> DataFrame:
    """N4. Books no checkout refers to."""
    return never_referenced(dim_book.select("bib_num", "title"), fact.select("bib_num").distinct(),
                            "bib_num", "bib_num")


def rating_vs_checkouts(dim_book: DataFrame, fact: DataFrame) -> DataFrame:
    """N5. Pearson correlation between rating and checkout count (0 for
    never-checked-out books) over rated books."""
    per = _checkouts_per_book(fact)
    rated = dim_book.filter(F.col("avg_rating").isNotNull()).select("bib_num", "avg_rating")
    j = rated.join(per, "bib_num", "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
    return j.agg(F.count(F.lit(1)).alias("n_books"),
                 F.round(F.corr(F.col("avg_rating"), F.col("n").cast("double")), 6).alias("corr_rating_checkouts"))


def checkouts_per_author(fact: DataFrame, bridge: DataFrame, dim_author: DataFrame) -> DataFrame:
    """N6. Checkouts per author over distinct (book, author) pairs, most
    popular first."""
    per = _checkouts_per_book(fact)
    pairs = bridge.select("bib_num", "author_id").distinct()
    tot = per.join(pairs, "bib_num").groupBy("author_id").agg(F.sum("n").alias("n"))
    names = dim_author.select(F.col("id").alias("author_id"), F.col("name").alias("author"))
    return tot.join(names, "author_id").select("author_id", "author", "n").orderBy(F.col("n").desc(), "author_id")


def books_per_author(bridge: DataFrame, dim_author: DataFrame) -> DataFrame:
    """N7. Distinct books per author, most prolific first."""
    tot = bridge.groupBy("author_id").agg(F.count_distinct("bib_num").alias("n_books"))
    names = dim_author.select(F.col("id").alias("author_id"), F.col("name").alias("author"))
    return tot.join(names, "author_id").select("author_id", "author", "n_books") \
              .orderBy(F.col("n_books").desc(), "author_id")


def daily_temperature_checkouts(fact: DataFrame, missing_value: float | None = -99.0) -> DataFrame:
    """Per day: temperature and checkout count; the sentinel is excluded."""
    daily = fact.groupBy(F.to_date("checkout_datetime").alias("day")).agg(
        F.max("temperature").alias("temperature"), F.count(F.lit(1)).alias("n"))
    daily = daily.filter(F.col("temperature").isNotNull())
    if missing_value is not None:
        daily = daily.filter(F.col("temperature") != missing_value)
    return daily


def temperature_band_effect(fact: DataFrame, band: float = 10.0, missing_value: float | None = -99.0) -> DataFrame:
    """N8. Checkouts per day by temperature band (``band`` degrees wide)."""
    daily = daily_temperature_checkouts(fact, missing_value)
    b = (F.floor(F.col("temperature") / band) * band).cast("double")
    return (daily.groupBy(b.alias("band")).agg(F.count(F.lit(1)).alias("n_days"),
                                                F.sum("n").alias("n_checkouts"),
                                                F.round(F.avg("n"), 6).alias("avg_per_day"))
                 .orderBy("band"))


def temperature_correlation(fact: DataFrame, missing_value: float | None = -99.0) -> DataFrame:
    """N8 companion: corr(day temperature, day checkouts)."""
    daily = daily_temperature_checkouts(fact, missing_value)
    return daily.agg(F.count(F.lit(1)).alias("n_days"),
                     F.round(F.corr("temperature", F.col("n").cast("double")), 6).alias("corr_temp_checkouts"))


def new_vs_old(fact: DataFrame, dim_book: DataFrame) -> DataFrame:
    """N9. Checkouts of books published in the checkout year ("new") against
    older ones ("old"); books without a year are "unknown"."""
    per = _checkouts_per_book(fact, F.year("checkout_datetime").alias("year"))
    j = per.join(dim_book.select("bib_num", "publication_year"), "bib_num", "left")
    cls = (F.when(F.col("publication_year").isNull(), F.lit("unknown"))
            .when(F.col("publication_year") == F.col("year"), F.lit("new"))
            .when(F.col("publication_year") < F.col("year"), F.lit("old"))
            .otherwise(F.lit("future")))
    return (j.groupBy(cls.alias("age")).agg(F.sum("n").alias("n_checkouts"),
                                            F.count_distinct("bib_num").alias("n_books"))
             .withColumn("avg_per_book", F.round(F.col("n_checkouts") / F.col("n_books"), 6)))


def books_per_publisher(lookup: DataFrame, dim_publisher: DataFrame) -> DataFrame:
    """N10. Inventory books per publisher, checked out or not: the book lookup
    (bib_num, key) against the keyed dimension, never the fact."""
    names = dim_publisher.select(F.col("key").alias("_k"), F.col("id").alias("publisher_id"), F.col("name").alias("publisher"))
    per = lookup.groupBy("key").agg(F.count_distinct("bib_num").alias("n_books"))
    return per.join(names, F.col("key") == F.col("_k"), "left").select("publisher_id", "publisher", "n_books")


def books_per_publication_year(dim_book: DataFrame) -> DataFrame:
    """N11. Books per cleaned publication year."""
    return dim_book.groupBy("publication_year").agg(F.count(F.lit(1)).alias("n_books"))
