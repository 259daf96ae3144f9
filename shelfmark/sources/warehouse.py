"""A warehouse folder whose content changes in one step.

    root/parts/<table>/load=<id>   written once, never changed
    root/versions/<n>.json         version n: the parts of every table, and the last batch of every stream

The current version is the highest one.  A load stages all its tables, reads them
back, runs the quality checks on what would become visible, and only then
publishes one small file by a rename; a load that fails before leaves the
version before it as it was, all eight tables of it.  Readers that opened a version keep it.

Order of a whole load: stage, check (Q1-Q9), publish, ``attach``.
Order of an increment: stage the new rows, publish (see ``streaming.incremental``).

Tables with a distribution key are staged as buckets of one sorted file each, so
the fact meets its time dimension without a shuffle and without a sort.  Increments of the fact are
partitioned by year and month instead, which is what a duplicate check is pruned by.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.quality import CHECKOUT_YEARS, quality_checks, raise_on_failure
from shelfmark.session import remove_path
from shelfmark.sources.sinks import STAR, conform_schema, save_star_tables, write_parquet

FACT = "fact_spl_book_checkout"
#: A bucket is written and sorted by one task, so their number follows the rows of the fact.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8
#: Tables that later loads need besides the eight: the keys that ids were given to.
HELPERS = {"_dim_author_keyed": "id bigint, name string, key string",
           "_dim_publisher_keyed": "id bigint, name string, key string",
           "_publisher_lookup": "bib_num string, publisher string, key string"}


class FailedLoad(RuntimeError):
    """The staged tables were not published."""


@dataclass(frozen=True)
class Part:
    path: str
    buckets: int = 0


@dataclass(frozen=True)
class Version:
    number: int = 0
    parts: dict[str, list[Part]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


# ---- versions ----------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    folder, fs = _folder(spark, os.path.join(root, "versions"))
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def version(spark: SparkSession, root: str, number: int) -> Version:
    text = spark.read.text(os.path.join(root, "versions", f"{number:08d}.json"), wholetext=True).first()[0]
    raw = json.loads(text)
    return Version(raw["number"], {t: [Part(**p) for p in parts] for t, parts in raw["parts"].items()}, raw["batches"])


def current(spark: SparkSession, root: str) -> Version:
    known = versions(spark, root)
    return version(spark, root, known[-1]) if known else Version()


def publish(spark: SparkSession, root: str, new: Version) -> None:
    """Make ``new`` the current version: written aside, then renamed.  A number is given once."""
    target, fs = _folder(spark, os.path.join(root, "versions", f"{new.number:08d}.json"))
    aside, _ = _folder(spark, os.path.join(root, "versions", f".{uuid.uuid4().hex}"))
    out = fs.create(aside)
    out.write(json.dumps(asdict(new)).encode())
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FailedLoad(f"version {new.number} was published by another load")


# ---- reading -----------------------------------------------------------------

def _schema(name: str) -> str:
    return HELPERS.get(name) or ", ".join(f"{c.name} {c.type}" for c in STAR[name].columns)


def read_table(spark: SparkSession, root: str, name: str, at: Version | None = None) -> DataFrame:
    """All rows of a table; of the fact also ``year`` and ``month`` (partition columns where it is partitioned)."""
    parts = (at or current(spark, root)).parts.get(name, [])
    schema, month = _schema(name), name == FACT
    out = spark.createDataFrame([], schema + (", year int, month int" if month else ""))
    whole = [p.path for p in parts if p.buckets or not month]
    if whole:
        rows = spark.read.schema(schema).parquet(*whole)
        if month:
            rows = rows.withColumns({"year": F.year("checkout_datetime"), "month": F.month("checkout_datetime")})
        out = out.unionByName(rows)
    if month and (split := [p.path for p in parts if not p.buckets]):
        reader = spark.read.schema(schema + ", load string, year int, month int").option("basePath", os.path.join(root, "parts", name))
        out = out.unionByName(reader.parquet(*split).drop("load"))
    return out


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight tables of the current version."""
    at = current(spark, root)
    return {n: read_table(spark, root, n, at).select(*STAR[n].names) for n in STAR}


# ---- writing -----------------------------------------------------------------

def bucket_count(fact: DataFrame) -> int:
    """As many buckets as keep each of them near ``BUCKET_ROWS`` rows."""
    return max(LEAST_BUCKETS, -(-fact.count() // BUCKET_ROWS))


def _staged(spark: SparkSession, root: str, load: str, tables: Mapping[str, DataFrame], buckets: int,
            late: Mapping[str, Mapping[str, Column]] | None = None) -> dict[str, Part]:
    """Write the tables as parts of ``load``, shaped as declared.  ``late``: see ``write_star``."""
    location = os.path.join(root, "parts", "{}", f"load={load}")
    out = {}
    if buckets:
        aside = f"staged_{uuid.uuid4().hex[:12]}"
        dealt = {n: df for n, df in tables.items() if n in STAR and STAR[n].dist_key}
        try:
            save_star_tables(spark, dealt, aside, buckets, location)
        finally:  # the files stay
            spark.sql(f"DROP DATABASE IF EXISTS {aside} CASCADE")
        out = {n: Part(location.format(n), buckets) for n in dealt}
    for name, df in tables.items():
        if name in out or name not in STAR and name not in HELPERS:
            continue
        part = out[name] = Part(location.format(name))
        if name in HELPERS:
            df.select(*spark.createDataFrame([], HELPERS[name]).columns).write.mode("overwrite").parquet(part.path)
        elif name == FACT:
            df = conform_schema(df.select(*STAR[name].names), name, by_position=False)
            write_parquet(df.withColumns({"year": F.year("checkout_datetime"), "month": F.month("checkout_datetime")}), part.path,
                          partition_by=["year", "month"], sort_within=["year", "month", "checkout_datetime"], late=(late or {}).get(name))
        else:
            df = conform_schema(df.select(*STAR[name].names), name, by_position=False)
            write_parquet(df, part.path, sort_within=[STAR[name].sort_key] if STAR[name].sort_key else None, rebalance=True,
                          late=(late or {}).get(name))
    return out


def load_star(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], buckets: int | None = None,
              year_range: tuple[int, int] = CHECKOUT_YEARS, batches: dict[str, int] | None = None) -> Version:
    """A whole load: all eight tables or none.  Raises FailedLoad with the failed checks.
    Without a number of ``buckets`` the fact is counted (quick where it is stored)."""
    missing = set(STAR) - set(tables)
    if missing:
        raise FailedLoad(f"tables missing: {sorted(missing)}")
    load = f"whole-{uuid.uuid4().hex[:12]}"
    before = versions(spark, root)
    try:
        parts = _staged(spark, root, load, tables, bucket_count(tables[FACT]) if buckets is None else buckets)
        new = Version((before or [0])[-1] + 1, {n: [p] for n, p in parts.items()}, batches or {})
        staged = {n: read_table(spark, root, n, new).select(*STAR[n].names) for n in STAR}
        raise_on_failure(quality_checks(staged, year_range))
        publish(spark, root, new)
    except Exception as reason:
        for name in [*STAR, *HELPERS]:
            remove_path(spark, os.path.join(root, "parts", name, f"load={load}"))
        raise FailedLoad(str(reason)) from reason
    return new


def append(spark: SparkSession, root: str, stream: str, batch_id: int, new_rows: Mapping[str, DataFrame],
           derived: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]] | None = None,
           late: Mapping[str, Mapping[str, Column]] | None = None) -> bool:
    """Add the rows of one batch of ``stream`` to all their tables at once.  A batch that was
    published before is left alone; one that was only staged is staged anew.  ``derived`` tables are
    made from staged ones (a function from a table's name to its new rows), so these are computed once."""
    before = current(spark, root)
    if before.batches.get(stream, -1) >= batch_id:
        return False
    load = f"{stream}-{batch_id:08d}"
    parts = _staged(spark, root, load, new_rows, 0, late)
    staged = Version(parts={n: [p] for n, p in parts.items()})
    parts |= _staged(spark, root, load, {n: make(lambda name: read_table(spark, root, name, staged))
                                         for n, make in (derived or {}).items()}, 0, late)
    after = {n: [*before.parts.get(n, []), *([parts[n]] if n in parts else [])] for n in {*before.parts, *parts}}
    publish(spark, root, Version(before.number + 1, after, {**before.batches, stream: batch_id}))
    return True


def rewrite(spark: SparkSession, root: str, buckets: int | None = None, year_range: tuple[int, int] = CHECKOUT_YEARS) -> Version:
    """Turn all increments into one checked load; the streams go on where they were."""
    at = current(spark, root)
    tables = {n: read_table(spark, root, n, at) for n in [*STAR, *HELPERS]}
    return load_star(spark, root, tables, buckets, year_range, at.batches)


def attach(spark: SparkSession, root: str, database: str) -> None:
    """The current version as tables of ``database``, with the buckets and their order
    declared; of tables with increments a view."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")  # holds while a bucket is one file
    at = current(spark, root)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE {database}")
    for name, t in STAR.items():
        parts = at.parts.get(name, [])
        if len(parts) != 1:
            paths = " UNION ALL ".join(f"SELECT {', '.join(t.names)} FROM parquet.`{p.path}`" for p in parts)
            spark.sql(f"CREATE VIEW {database}.{name} AS {paths or 'SELECT ' + ', '.join(f'CAST(NULL AS {c.type}) AS {c.name}' for c in t.columns) + ' WHERE false'}")
            continue
        dealt = f"CLUSTERED BY ({t.dist_key}) SORTED BY ({t.sort_key}) INTO {parts[0].buckets} BUCKETS" if parts[0].buckets else ""
        spark.sql(f"CREATE TABLE {database}.{name} ({_schema(name)}) USING parquet {dealt} LOCATION '{parts[0].path}'")


def fact_with_time(spark: SparkSession, database: str) -> DataFrame:
    """Every checkout with its time parts, joined bucket by bucket."""
    fact, times = spark.table(f"{database}.{FACT}"), spark.table(f"{database}.dim_checkout_time")
    return fact.join(times, "checkout_datetime")
