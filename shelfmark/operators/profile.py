"""Profiling (A1-A9, A13, P5, A6): one aggregation pass per question.

The notebooks ran one full scan per helper per column; here every statistic
for every requested column comes out of a single ``agg`` (partial aggregation
on the map side, one shuffle of one row per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """A1+A2+A3+A13+P5. Per column: rows, non-NULL values, distinct values,
    NULLs, blank strings.  ``exact=False`` uses HyperLogLog for the distinct
    count, which avoids one Expand copy of the data per distinct column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        col = F.col(c)
        aggs += [
            F.count(col).alias(f"v{i}"),
            (F.count_distinct(col) if exact else F.approx_count_distinct(col)).alias(f"d{i}"),
            F.count_if(col.isNull()).alias(f"n{i}"),
            F.count_if(F.trim(col.cast("string")) == "").alias(f"e{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("n_values"),
                     F.col(f"d{i}").alias("n_distinct"), F.col(f"n{i}").alias("n_null"),
                     F.col(f"e{i}").alias("n_empty")) for i, c in enumerate(columns)]
    return wide.select("n_rows", F.inline(F.array(*rows))).select(
        "column_name", "n_rows", "n_values", "n_distinct", "n_null", "n_empty")


def basic_stats(df: DataFrame, columns: Sequence[str], digits: int | None = 6) -> DataFrame:
    """A4. count, avg, min, max per column in one row (``<col>_n`` ...).

    Timestamps get min/max only; text columns get lexical min/max and the
    average of their numeric values (``try_cast``, non-numbers ignored)."""
    aggs = []
    types = dict(df.dtypes)

    def avg(c):
        a = F.avg(c)
        return F.round(a, digits) if digits is not None else a

    for c in columns:
        col = F.col(c)
        aggs.append(F.count(col).alias(f"{c}_n"))
        t = types[c]
        if t.startswith("timestamp") or t == "date":
            pass
        elif t == "string":
            aggs.append(avg(col.try_cast("double")).alias(f"{c}_avg"))
        else:
            aggs.append(avg(col.cast("double")).alias(f"{c}_avg"))
        aggs += [F.min(col).alias(f"{c}_min"), F.max(col).alias(f"{c}_max")]
    return df.agg(*aggs)


def length_extremes(df: DataFrame, col: str, id_col: str, n: int = 10) -> DataFrame:
    """A5. The ``n`` shortest and ``n`` longest values by character length
    (ties by id).  One scan: every row is offered to both rankings and a
    per-kind top-n keeps at most ``n`` rows per kind in each task before the
    shuffle (partial WindowGroupLimit), so the text is read once."""
    from shelfmark.operators.rank import top_k_per_group

    base = df.select(F.col(id_col), F.length(col).alias("len"))
    both = base.withColumn("kind", F.explode(F.array(F.lit("shortest"), F.lit("longest"))))
    both = both.withColumn("_o", F.when(F.col("kind") == "shortest", F.col("len")).otherwise(-F.col("len")))
    top = top_k_per_group(both, ["kind"], [F.col("_o").asc(), F.col(id_col).asc()], n, rank_col="_r")
    # at most 2n rows go back for their values
    top = F.broadcast(top.select(F.col(id_col).alias("_id"), F.col("len").alias("_len"), "kind"))
    values = df.select(F.col(id_col), F.length(col).alias("len"), F.col(col).alias("value"))
    return (values.join(top, (F.col(id_col) == F.col("_id")) & F.col("len").eqNullSafe(F.col("_len")))
            .select(id_col, "len", "kind", "value"))


def histogram(df: DataFrame, col: str, bins: int, where=None, lower: float | None = None,
              upper: float | None = None) -> DataFrame:
    """A6. Equal-width histogram between min and max (or given bounds).

    Bin i (1..bins) covers [lo + (i-1)w, lo + iw); the maximum falls into the
    last bin; empty bins are emitted with count 0.  Bounds come from one
    aggregate (two scalars), counts from one grouped aggregate; the bin frame
    has ``bins`` rows, so its broadcast is bounded by the parameter."""
    data = df.filter(where) if where is not None else df
    v = F.col(col).cast("double")
    if lower is None or upper is None:
        row = data.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
        lower = row["lo"] if lower is None else lower
        upper = row["hi"] if upper is None else upper
    spark = df.sparkSession
    if lower is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    lo, hi = float(lower), float(upper)
    span = hi - lo
    if span == 0:
        idx = F.lit(1)
    else:
        raw = F.floor((v - F.lit(lo)) / F.lit(span) * F.lit(bins)).cast("int") + 1
        idx = F.least(F.greatest(raw, F.lit(1)), F.lit(bins))
    counts = (data.filter(v.isNotNull() & (v >= lo) & (v <= hi))
                  .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    width = span / bins
    edges = spark.range(1, bins + 1).select(
        F.col("id").cast("int").alias("bin"),
        F.round(F.lit(lo) + (F.col("id") - 1) * F.lit(width), 6).alias("bin_lo"),
        F.round(F.lit(lo) + F.col("id") * F.lit(width), 6).alias("bin_hi"))
    return (F.broadcast(edges).join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def group_stats(df: DataFrame, keys: Sequence, value: str, prefix: str = "", digits: int | None = 6) -> DataFrame:
    """A7/A8. count, avg, min, max of ``value`` per group, largest groups first."""
    v = F.col(value)
    a = F.avg(v.cast("double"))
    a = F.round(a, digits) if digits is not None else a
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}n"), a.alias(f"{prefix}avg"),
                                F.min(v).alias(f"{prefix}min"), F.max(v).alias(f"{prefix}max"))
    return out.orderBy(F.col(f"{prefix}n").desc(), *out.columns[: len(keys)])


def key_frequency(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A9. Rows of every key, most frequent first."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), *keys)


def rollup_counts(df: DataFrame, levels: Sequence, value: str | None = None) -> DataFrame:
    """ROLLUP over ``levels`` (e.g. year, month): row counts and an optional
    sum, with subtotal rows (NULL below the rolled-up level) and a grand
    total."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias(f"sum_{value}"))
    return df.rollup(*levels).agg(*aggs)
