"""Row identity and scratch tables shared by the operators of this folder.

Identity.  ``doc_id`` may be null or repeated.  Operators order and join rows
by ``_id`` (doc_id as bigint; null counts as the largest id, 2^63 - 1) and, where a
row must be found again, by ``_id`` plus ``_th``, a 64-bit hash of the text.
Rows equal in both are equal inputs and get equal results.

Names.  Working columns start with an underscore.  ``own_columns`` keeps the caller's
columns apart from them, whatever they are called.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.session import remove_at_exit, remove_path, scratch_path

NULL_ID = 2**63 - 1
_made: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession, keep: int = 1) -> Iterator[None]:
    """Tables written inside are removed at the end, but for the last ``keep``."""
    start = len(_made)
    try:
        yield
    finally:
        stop = max(start, len(_made) - keep)
        for path in _made[start:stop]:
            remove_path(spark, path)
        del _made[start:stop]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def own_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Runs ``operator(docs, ..., <name>_col=...)`` on ``docs`` with its columns called
    c0, c1, ..., so that none clashes with the operator's own, and gives them their
    names back.  A column that the operator adds under a name of the caller's
    comes out as ``<name>_new``."""
    signature = inspect.signature(operator)

    @wraps(operator)
    def run(*args, **options) -> DataFrame:
        call = signature.bind(*args, **options)
        call.apply_defaults()
        docs = call.arguments["docs"]
        plain = {c: f"c{k}" for k, c in enumerate(docs.columns)}
        call.arguments["docs"] = docs.toDF(*plain.values())
        for key in ("id_col", "text_col", "key_col", "learn_col"):
            if key in call.arguments:
                call.arguments[key] = plain.get(call.arguments[key], call.arguments[key])
        out = operator(*call.args, **call.kwargs)
        given = {v: k for k, v in plain.items()}

        def name(c: str) -> str:
            if c in given:
                return given[c]
            return c if c not in plain else name(f"{c}_new")
        return out.toDF(*map(name, out.columns))
    return run


def numbered(id_col: str) -> Column:
    """The id as bigint; null is NULL_ID.  Other texts than whole numbers are refused."""
    number = F.col(id_col).try_cast("long")
    refused = F.concat(F.lit("document ids must be whole numbers (bigint), got: "), F.col(id_col).cast("string"))
    return (F.when(F.col(id_col).isNull(), F.lit(NULL_ID))
            .when(number.isNull(), F.raise_error(refused).cast("long")).otherwise(number))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _th, _text, <id_col>): what an operator needs of a document row; null text stays null."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col), numbered(id_col).alias("_id"),
                       F.xxhash64(text).alias("_th"), text.alias("_text"))


def with_identity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``_id`` and ``_th``."""
    return docs.withColumns({"_id": numbered(id_col),
                             "_th": F.xxhash64(F.col(text_col).cast("string"))})


def held_out(id_col: str, parts: int, part: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``, equals ``part`` (a null id is the empty text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(parts) == F.lit(part)


def written(df: DataFrame, name: str, partition_by: str | None = None, narrow: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends at
    files that every executor sees, and the work above is done once.
    ``narrow`` is for tables that are far smaller than the documents: an eighth
    of the shuffle's tasks write them, so that they are not many tiny files."""
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(max(2, shuffle_partitions(spark) // 8))
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    _made.append(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
