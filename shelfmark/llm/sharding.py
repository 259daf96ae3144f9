"""Operator 3: placement by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table, given
by an offset and a skip hashed from its name.  Shards take turns claiming the next
free slot of their permutation; a shard of weight w takes w turns a round.
A row's slot is its key's hash modulo the table size, so placement is one lookup in a
table of SLOTS rows, broadcast (its size is this parameter, not the data's).
When a shard comes or goes, nearly all slots of the others stay.

The key is the document id, which no source or group of copies can make hot.

Defined cases: a null key is the empty text; equal keys share a shard;
extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfmark.llm.frames import own_columns

SLOTS = 65_537  # prime, over 100 slots for each of up to 655 shards
SHARDS = 64


def _number(text: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{text}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def filled_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> list[int]:
    """Index into ``shards`` for every slot."""
    if not is_prime(slots):
        raise ValueError(f"{slots} slots: the number must be prime, or a skip may not reach every slot")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shard names must be given, distinct and fewer than the slots")
    turns = weights or [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("weights must be natural numbers, one a shard, not all 0")
    at = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    free = slots
    while free:
        for k, n in enumerate(turns):
            for _ in range(min(n, free)):
                while table[at[k]] >= 0:
                    at[k] = (at[k] + skip[k]) % slots
                table[at[k]] = k
                free -= 1
    return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS,
                weights: list[int] | None = None) -> DataFrame:
    schema = T.StructType([T.StructField("_slot", T.LongType(), False), T.StructField("_shard", T.StringType(), False)])
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(filled_table(shards, slots, weights))], schema)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots))


@own_columns
def with_shard(docs: DataFrame, shards: list[str] | None = None, slots: int = SLOTS,
               weights: list[int] | None = None, key_col: str = "doc_id") -> DataFrame:
    """``docs`` plus ``_slot`` and ``_shard``; rows are not moved."""
    names = shards or [f"shard-{k:03d}" for k in range(SHARDS)]
    table = table_frame(docs.sparkSession, names, slots, weights)
    return docs.withColumn("_slot", slot_of(F.col(key_col), slots)).join(F.broadcast(table), "_slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write ``docs`` as one folder a shard; a shard's rows are dealt over several
    tasks by adaptive execution where they are many."""
    placed = with_shard(docs, **options).drop("_slot").withColumnRenamed("_shard", "shard")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
