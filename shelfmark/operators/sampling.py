"""Samples of a fixed number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_hash(columns: Sequence[str], seed: int) -> Column:
    """md5 of the seed and the columns' texts; NULL and the empty text differ."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def sample_rows(df: DataFrame, n: int, seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly min(n, rows) rows: those of the smallest hashes of ``key`` (default: all columns).

    Every task keeps its n smallest, and the n smallest of those are the sample
    (planned as TakeOrderedAndProject), so partitioning and task order do not matter, samples of parts can be merged, and a
    smaller n gives a part of a larger one.  Every set of n keys is equally likely over
    seeds; rows with equal keys are taken together, in the order of their other columns."""
    h = sample_hash(key or df.columns, seed)
    free = "_".join(["hash", *df.columns])
    ties = [c for c, t in df.dtypes if not t.startswith("map")]
    return df.withColumn(free, h).orderBy(free, *[F.col(f"`{c}`") for c in ties]).limit(n).drop(free)
