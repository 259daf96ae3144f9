"""Writers and the declared warehouse layout.

The warehouse DDL is kept as data (``STAR``): column names, types, NOT NULL,
VARCHAR byte limits, primary and foreign keys.  Quality checks (Q6-Q9) and
``conform_schema`` (S13) read it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Column_:
    name: str
    type: str                 # Spark SQL type
    not_null: bool = False
    max_bytes: int | None = None  # VARCHAR(n): the warehouse counts bytes


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[Column_, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()   # (column, ref table, ref column)
    sort_key: str | None = None
    dist_key: str | None = None
    replicate: bool = False   # small table copied to every node -> broadcast at query time
    extra: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


# The warehouse tables (names, types, limits and keys).
STAR: dict[str, TableDef] = {t.name: t for t in [
    TableDef("dim_book", (
        Column_("bib_num", "string", max_bytes=10), Column_("title", "string", max_bytes=1500),
        Column_("isbns", "string", max_bytes=1500), Column_("publication_year", "int"),
        Column_("avg_rating", "double"), Column_("ratings_count", "int"), Column_("text_reviews_count", "int"),
        Column_("raw_title", "string", max_bytes=1500), Column_("raw_author", "string", max_bytes=255),
        Column_("raw_publisher", "string", max_bytes=500), Column_("raw_publication_year", "string", max_bytes=255)),
        primary_key=("bib_num",), sort_key="bib_num", replicate=True),
    TableDef("dim_author", (Column_("id", "bigint"), Column_("name", "string", True, 1000)),
             primary_key=("id",), sort_key="name", replicate=True),
    TableDef("dim_subject", (Column_("id", "bigint"), Column_("name", "string", True, 255)),
             primary_key=("id",), sort_key="name", replicate=True),
    TableDef("dim_publisher", (Column_("id", "bigint"), Column_("name", "string", max_bytes=500)),
             primary_key=("id",), sort_key="name", replicate=True),
    TableDef("dim_checkout_time", (
        Column_("checkout_datetime", "timestamp_ntz"), Column_("hour", "int", True), Column_("day", "int", True),
        Column_("week", "int", True), Column_("weekday", "int", True), Column_("month", "int", True),
        Column_("year", "int", True)),
        primary_key=("checkout_datetime",), sort_key="checkout_datetime", dist_key="checkout_datetime"),
    TableDef("br_book_author", (Column_("bib_num", "string", max_bytes=10), Column_("author_id", "bigint", True)),
             foreign_keys=(("author_id", "dim_author", "id"),), sort_key="bib_num", replicate=True),
    TableDef("br_book_subject", (Column_("bib_num", "string", max_bytes=10), Column_("subject_id", "bigint", True)),
             foreign_keys=(("subject_id", "dim_subject", "id"),), sort_key="bib_num", replicate=True),
    TableDef("fact_spl_book_checkout", (
        Column_("bib_num", "string", True, 10), Column_("item_barcode", "string", max_bytes=13),
        Column_("checkout_datetime", "timestamp_ntz", True), Column_("temperature", "double"),
        Column_("publisher_id", "bigint"), Column_("id", "string", max_bytes=32)),
        primary_key=("id",),
        foreign_keys=(("checkout_datetime", "dim_checkout_time", "checkout_datetime"),
                      ("publisher_id", "dim_publisher", "id")),
        sort_key="checkout_datetime", dist_key="checkout_datetime"),
]}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                  sort_within: Sequence[str] | None = None, files: int | None = None,
                  rebalance: bool = False, late: Mapping[str, Column] | None = None) -> None:
    """S9/S10. Parquet writer.  With ``partition_by`` the rows are rebalanced
    on the partition columns first: AQE splits a hot partition value over
    several tasks (a month holding a third of all rows does not land in one
    task) and merges small ones, which bounds both file size and file count.
    ``files`` fixes the number of writing tasks (and so of files per value); ``rebalance`` leaves
    it to AQE where there are no partitions.
    ``late`` columns follow from others: they are neither shuffled nor sorted, but computed after that."""
    names = df.columns
    if late:
        df = df.drop(*late)
    if files:
        df = df.repartition(files, *(partition_by or ()))
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    elif rebalance:
        df = df.hint("rebalance")
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    if late:
        df = df.withColumns(dict(late)).select(*names)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """S11. CSV writer (the name map is written headerless); blanks at the
    ends of a value are kept, quotes inside a value are doubled."""
    (df.write.mode(mode).option("escape", '"').option("header", str(header).lower()).option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))


def conform_schema(df: DataFrame, table: TableDef | str, by_position: bool = True) -> DataFrame:
    """S13. Shape a frame to a declared table: take columns by position (as a
    warehouse bulk load does) or by name, rename to the declared names, cast
    to the declared types, in declared order.  A missing or extra column and a
    value that does not fit its type fail the load, as a warehouse load does."""
    t = STAR[table] if isinstance(table, str) else table
    src = df.columns if by_position else t.names
    if len(df.columns) != len(t.columns) or not by_position and set(df.columns) != set(t.names):
        raise ValueError(f"{t.name}: expected columns {t.names}, got {df.columns}")

    def cast(s: str, c: Column_):
        value = F.col(s).try_cast(c.type)
        bad = F.col(s).isNotNull() & value.isNull()
        message = F.concat(F.lit(f"{t.name}.{c.name}: not a {c.type}: "), F.col(s).cast("string"))
        return F.when(bad, F.raise_error(message).cast(c.type)).otherwise(value).alias(c.name)
    return df.select(*[cast(s, c) for s, c in zip(src, t.columns)])


def save_star_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str,
                     buckets: int = 0, location: str | None = None) -> None:
    """S12. Drop and recreate the given star tables, managed or at ``location``
    (a path with ``{}`` for the table's name).

    The warehouse's distribution key becomes bucketing (fact and time dimension on
    ``checkout_datetime``: their join needs no shuffle).  Rows are dealt by the
    same hash before the write, so a bucket is one file however many tasks there are, and its order, the sort
    key's, can be used.  Replicated tables are sorted, unbucketed (they are
    broadcast at query time by size)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        if name not in STAR:
            continue
        t = STAR[name]
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        df = conform_schema(df.select(*t.names), t, by_position=False)
        order = t.sort_key or t.dist_key
        if buckets and t.dist_key:
            w = df.repartition(buckets, t.dist_key).write.bucketBy(buckets, t.dist_key).sortBy(order)
        else:
            df = df.hint("rebalance")
            w = (df.sortWithinPartitions(order) if order else df).write
        w = w.mode("overwrite").format("parquet")
        if location:
            w = w.option("path", location.format(name))
        w.saveAsTable(f"{database}.{name}")


def write_star(tables: Mapping[str, DataFrame], root: str, dimension_files: int | None = None,
               late: Mapping[str, Mapping[str, Column]] | None = None) -> None:
    """B12 writer: each table under ``root/<name>``; the fact partitioned by
    checkout year and month, sorted by time inside files (min/max skipping
    on time filters).  ``late``: by table, the columns that follow from its others (see ``write_parquet``)."""
    import os

    for name, df in tables.items():
        if name not in STAR:
            continue
        path = os.path.join(root, name)
        if name == "fact_spl_book_checkout":
            df = (df.withColumn("year", F.year("checkout_datetime"))
                    .withColumn("month", F.month("checkout_datetime")))
            # (year, month) first: satisfies the writer's required ordering, so it adds no
            # second sort, and rows inside each file stay in time order
            write_parquet(df, path, partition_by=["year", "month"], sort_within=["year", "month", "checkout_datetime"],
                          late=(late or {}).get(name))
        else:
            # dimensions are rebalanced: AQE writes as few files as their size needs
            write_parquet(df, path, files=dimension_files, rebalance=not dimension_files, late=(late or {}).get(name))
