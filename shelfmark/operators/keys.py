"""Surrogate keys (K1, K2) and stable keys under incremental loads.

``dense_ids`` numbers rows 0..n-1 in key order without a one-task stage:
range-partition and sort, tag every row with its partition and position
(``monotonically_increasing_id`` = partition << 33 | position), write,
count rows per partition, turn the counts into offsets and add them.  The
offsets table has one row per partition, so broadcasting it is bounded by the
partition count, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.relate import dedupe_by_key
from shelfmark.session import stored


def dense_ids(df: DataFrame, order_by: Sequence[str], id_col: str = "id", start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """K1. Add ``id_col`` = start + rank of the row in ``order_by`` order
    (0-based, gap-free).  Rows should be distinct on ``order_by``; ties get
    distinct ids in an unspecified order.  The rows are written before they are
    split by ranges (which reads them twice) and after, so the work above is done
    once and dimension, bridge and fact builders all see the same ids."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (stored(df, "keys").repartitionByRange(n, *order_by)
                 .sortWithinPartitions(*order_by)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = stored(ordered, "ordered-keys")
    part = F.shiftright(F.col("_mid"), 33)
    tagged = ordered.withColumn("_part", part).withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_part"), 33))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a global window over it is tiny.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_part")
    out = out.withColumn(id_col, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
    return out.drop("_mid", "_part", "_pos", "_off")


def unique_ids(df: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """K2. Unique, increasing, not dense, not stable across runs."""
    return df.withColumn(id_col, F.monotonically_increasing_id())


def append_new_keys(existing: DataFrame, candidates: DataFrame, key_col: str, id_col: str = "id",
                    order_by: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """B13. Incremental dimension load: keys already stored (a NULL key is a key) keep their ids;
    new keys (anti join) get dense ids after the current ``max(id)``.

    Returns (new rows with ids, full dimension = existing + new)."""
    one = dedupe_by_key(candidates.select(key_col, *[c for c in candidates.columns if c != key_col]), [key_col])
    known = existing.select(F.col(key_col).alias("_known"))
    new = one.join(known, F.col(key_col).eqNullSafe(F.col("_known")), "left_anti")
    start_row = existing.agg(F.max(id_col).alias("m")).first()
    start = 0 if start_row is None or start_row["m"] is None else int(start_row["m"]) + 1
    added = dense_ids(new, order_by or [key_col], id_col, start=start)
    full = existing.unionByName(added.select(*existing.columns), allowMissingColumns=False)
    return added, full
