"""Plan shape of every registered query, and a DuckDB oracle check on the
smallest driver tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from shelfmark.plans import registry
from shelfmark.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) - registry.WITHOUT_SQL == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["bib_num", "year", "n", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle_and_plan_is_clean(spark, con, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # no row count by a limit in front of a join
    assert "GlobalLimit" not in plan or name in ("limit_rows",), plan
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDF
    if "ArrowEvalPython" in plan:
        assert name == "jaro_winkler_pairs"
    rows = df.collect()
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    sorder = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    got = sorted("|".join(_norm(r[i]) for i in sorder) for r in rows)
    exp = sorted("|".join(_norm(r[i]) for i in order) for r in want)
    assert got == exp


def test_writers_take_more_tasks_for_more_rows(spark, monkeypatch):
    import os
    import re

    from shelfmark.plans import raw_feeds
    tasks = {}

    def seen(module):
        remove = module.remove_path

        def remove_path(session, path):
            local = path.removeprefix("file:")
            # part-<task>-..., or <key>_<task>.json once a file has the name of its key
            found = [re.match(r"(?:part-|[^_.]+_)(\d{5})(?:-|\.json$)", f) for _, _, files in os.walk(local) for f in files]
            tasks.setdefault(module.__name__, set()).update(m[1] for m in found if m)
            remove(session, path)
        monkeypatch.setattr(module, "remove_path", remove_path)

    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    seen(registry), seen(raw_feeds)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        books = registry.QUERIES["conform_schema"](spark, SF).count()
        maps = registry.QUERIES["raw_json_maps"](spark, SF).count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert books and maps
    assert len(tasks["shelfmark.plans.registry"]) > 2 and len(tasks["shelfmark.plans.raw_feeds"]) > 1
