"""Connected components of an edge table by alternating star contraction.

Each half round sends neighbours to the smallest node next to them: first from
the larger neighbours (large star), then from the smaller (small star).
The edges never leave Spark.  Every round is written to the shared
folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import written


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) bigint links, any order, self links ignored -> (node, root) for
    every linked node other than its root; root is the smallest node."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", narrow=True)
    before = None
    while (stamp := _stamp(now)) != before:
        before = stamp
        now = written(_small_star(_large_star(now)), "stars", narrow=True)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
