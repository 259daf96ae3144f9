"""Operator 4: line dedup with levelled sorted runs.

Documents arrive in batches of growing id.  The distinct line keys of a batch
are merge-anti-joined with every run seen so far; what is left is new, and is
stored as a run of its own: a table of (hash, owner) dealt into buckets of one sorted file
each, whose order the scans report, so that later anti-joins merge it without a shuffle and without a sort.  When a level
holds ``fanout`` runs they are merged, bucket by bucket, into one run of the next level, so n
batches leave O(log n) runs.  A line is dropped if its key is in an earlier
run, or is owned by a smaller id of its own batch.

A key is a pair of independent 64-bit hashes.  Keys are aggregated before
every shuffle that gathers them, so a line that a third of all documents share
is one row per task.  Lines are joined back by an ordinary equi-join of two shuffled
sides, which adaptive execution splits where a key is hot.

Defined cases: null text is one empty line; a null id is the largest id and so
never takes a line from another document; repeated rows are one document and
lose the same lines; empty input gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.frames import identified, own_columns, shuffle_partitions, with_identity, written
from shelfmark.llm.native_text import let, lower_az, strip_white
from shelfmark.session import remove_path, scratch_path

MIN_KEY_CHARS = 10
BATCHES = 4
FANOUT = 2
KEY = ["_h1", "_h2"]
SCAN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class LineRuns:
    """The runs, by level; every run is a bucketed table whose files lie in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.order_before = spark.conf.get(SCAN_ORDER, None)
        spark.conf.set(SCAN_ORDER, "true")  # Spark checks that every bucket is one file
        self.buckets = shuffle_partitions(spark)
        self.name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.made = 0
        self.paths: dict[str, str] = {}

    def _store(self, keys: DataFrame) -> str:
        """``keys`` are dealt by hash of KEY already, by their aggregate or by the buckets
        they come from: every task writes whole buckets."""
        self.made += 1
        table = f"{self.name}_{self.made}"
        self.paths[table] = scratch_path(self.spark, table)
        (keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.paths[table])
         .saveAsTable(table, format="parquet"))
        return table

    def _forget(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")
        remove_path(self.spark, self.paths.pop(table))

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of lines (_id, _th, _pos, _h1, _h2), all of larger ids
        than those before; returns the lines (_id, _th, _pos) to drop."""
        fresh = lines.groupBy(*KEY).agg(F.min("_id").alias("_owner"))
        for run in (r for level in self.levels for r in level):
            fresh = fresh.join(self.spark.table(run).select(*KEY), KEY, "left_anti")
        own = self._store(fresh)
        # as files, not as a bucketed table: both sides are shuffled then, and a hot line is split
        owners = self.spark.read.schema(fresh.schema).parquet(self.paths[own])
        dropped = written(
            lines.join(owners, KEY, "left").where(F.col("_owner").isNull() | (F.col("_id") > F.col("_owner")))
            .select("_id", "_th", "_pos"), "line-drops")
        self.levels[0].append(own)
        self._compact()
        return dropped

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self.merged(old)
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._store(merged))
            for t in old:
                self._forget(t)
            level += 1

    def merged(self, tables: list[str]) -> DataFrame:
        """The rows of runs, which have no key in common, by a merge join of their sorted buckets."""
        out = self.spark.table(tables[0])
        for t in tables[1:]:
            out = (out.join(self.spark.table(t).withColumnRenamed("_owner", "_other"), KEY, "full_outer")
                   .select(*KEY, F.coalesce("_owner", "_other").alias("_owner")))
        return out

    def drop(self) -> None:
        self.spark.conf.unset(SCAN_ORDER) if self.order_before is None else self.spark.conf.set(SCAN_ORDER, self.order_before)
        for t in (t for level in self.levels for t in level):
            self._forget(t)
        self.levels = [[]]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line long enough to count: (_id, _th, _pos, _h1, _h2)."""
    return (rows.select("_id", "_th", F.posexplode(lines_of(F.col("_text"))).alias("_pos", "_line"))
            .select("_id", "_th", "_pos", lower_az(strip_white(F.col("_line"))).alias("_key"))
            .where(F.char_length("_key") >= min_chars)
            .select("_id", "_th", "_pos", F.xxhash64(F.lit(11), "_key").alias("_h1"),
                    F.xxhash64(F.lit(29), "_key").alias("_h2")))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
                  fanout: int = FANOUT, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(_id, _th, _pos) of every line to drop, batch by batch in id order."""
    spark = docs.sparkSession
    rows = identified(docs, id_col, text_col)
    shares = [k / batches for k in range(1, batches)]
    cuts = sorted(set(rows.agg(F.percentile_approx("_id", shares)).first()[0] or [])) if shares else []
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("_id") > F.lit(cut)).cast("int")
    lines = written(line_keys(rows, min_chars).withColumn("_batch", batch), "line-keys", "_batch")
    runs = LineRuns(spark, fanout)
    try:
        drops = None
        for k in range(len(cuts) + 1):
            part = runs.add(lines.where(F.col("_batch") == k).drop("_batch"))
            drops = part if drops is None else drops.unionByName(part)
    finally:
        runs.drop()
    return drops


def _deduped(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    gone = (dropped_lines(docs, id_col, text_col, **options).groupBy("_id", "_th")
            .agg(F.collect_set("_pos").alias("_gone")))
    rows = with_identity(docs, id_col, text_col)
    text = F.col(text_col).cast("string")
    stay = lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: F.get(lines, i))
    return (rows.join(gone, ["_id", "_th"], "left")
            .withColumn("_kept", F.when(F.col("_gone").isNull(), F.coalesce(text, F.lit("")))
                        .otherwise(let(lines_of(text), lambda x: F.array_join(stay(x), "\n"))))
            .withColumn("_n_lines", F.size(lines_of(text)).cast("long"))
            .withColumn("_n_dropped", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
            .drop("_id", "_th", "_gone"))


@own_columns
def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` plus ``_kept`` (the text that stays), ``_n_lines`` and ``_n_dropped``."""
    return _deduped(docs, id_col, text_col, **options)


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with its text replaced by the text that stays, and ``length_col`` by that text's length."""
    @own_columns
    def cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return _deduped(docs, id_col, text_col, **options).withColumn(text_col, F.col("_kept")).select(*docs.columns)
    out = cut(docs, id_col, text_col)
    return out.withColumn(length_col, F.char_length(text_col).cast("long")) if length_col else out
