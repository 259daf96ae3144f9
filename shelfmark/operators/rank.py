"""Top-k per group (W1) and sorted top-n (O1/O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """W1. The first ``k`` rows of every group by ``order`` (``order`` must be a
    total order, e.g. end with the row key, so ties are stable).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle: each task keeps at most ``k`` rows per group, so a group with
    a third of all rows sends only ``k`` rows per task to its reducer."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """O2. Global top-n (TakeOrderedAndProject: per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)
