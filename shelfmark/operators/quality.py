"""Data-quality checks over the star tables (Q1-Q9).

All checks of one table come out of one aggregation pass; the result is one
DataFrame (check, table_name, column_name, observed, bound, passed) instead
of an abort on the first failure.  ``raise_on_failure`` restores the abort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.sinks import STAR, TableDef

# The bounds of the original checks.
MAX_TEMPERATURE = 120.0          # exclusive
RATING_RANGE = (0.0, 5.0)        # inclusive
BARCODE_LENGTH = 13
CHECKOUT_YEARS = (2005, 2017)    # inclusive
# Column counted by the non-empty check, per table.
COUNT_COLUMN = {"dim_publisher": "id", "dim_author": "id", "dim_subject": "id", "dim_book": "bib_num",
                "dim_checkout_time": "checkout_datetime", "br_book_author": "bib_num",
                "br_book_subject": "bib_num", "fact_spl_book_checkout": "checkout_datetime"}

RESULT_SCHEMA = "check_name string, table_name string, column_name string, observed double, bound string, passed boolean"


def _row(check: str, table: str, column: str | None, observed: Column, bound: str, passed: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                    F.lit(column).cast("string").alias("column_name"), observed.cast("double").alias("observed"),
                    F.lit(bound).alias("bound"), passed.alias("passed"))


def table_checks(df: DataFrame, t: TableDef, year_range: tuple[int, int] = CHECKOUT_YEARS) -> DataFrame:
    """All single-table checks of one table in one aggregation."""
    aggs: list[Column] = []
    specs = []  # (check, column, agg alias, bound text, pass predicate on the alias)
    cc = COUNT_COLUMN.get(t.name, t.names[0])
    aggs.append(F.count(cc).alias("q1"))
    specs.append(("non_empty", cc, "q1", "> 0", lambda c: c > 0))
    for i, col in enumerate(t.columns):
        if col.not_null:
            aggs.append(F.count_if(F.col(col.name).isNull()).alias(f"nn{i}"))
            specs.append(("not_null", col.name, f"nn{i}", "= 0", lambda c: c == 0))
        if col.max_bytes:
            aggs.append(F.count_if(F.octet_length(F.col(col.name)) > col.max_bytes).alias(f"vb{i}"))
            specs.append(("max_bytes", col.name, f"vb{i}", f"<= {col.max_bytes} bytes: 0 over", lambda c: c == 0))
    if t.primary_key:
        pk = [F.col(c) for c in t.primary_key]
        present = F.count(F.when(F.least(*[c.isNotNull().cast("int") for c in pk], F.lit(1)) == 1, F.lit(1)))
        aggs.append((present - F.count_distinct(*pk)).alias("pk"))
        specs.append(("unique_key", ",".join(t.primary_key), "pk", "= 0 duplicates", lambda c: c == 0))
    if t.name == "fact_spl_book_checkout":
        aggs.append(F.max("temperature").alias("tmax"))
        specs.append(("max_temperature", "temperature", "tmax", f"< {MAX_TEMPERATURE}",
                      lambda c: F.coalesce(c < MAX_TEMPERATURE, F.lit(True))))
        aggs.append(F.count(F.when(F.length("item_barcode") != BARCODE_LENGTH, F.col("item_barcode"))).alias("bc"))
        specs.append(("barcode_length", "item_barcode", "bc", f"= 0 not {BARCODE_LENGTH} long", lambda c: c == 0))
    if t.name == "dim_book":
        lo, hi = RATING_RANGE
        aggs += [F.min("avg_rating").alias("rmin"), F.max("avg_rating").alias("rmax")]
        # no rated book -> NULL observed, reported as passed = NULL (no data)
        specs.append(("rating_min", "avg_rating", "rmin", f">= {lo}", lambda c: c >= lo))
        specs.append(("rating_max", "avg_rating", "rmax", f"<= {hi}", lambda c: c <= hi))
    if t.name == "dim_checkout_time":
        y0, y1 = year_range
        aggs.append(F.count(F.when((F.col("year") < y0) | (F.col("year") > y1), F.col("checkout_datetime")))
                    .alias("yr"))
        specs.append(("checkout_year", "year", "yr", f"= 0 outside {y0}..{y1}", lambda c: c == 0))
    wide = df.agg(*aggs)
    rows = [_row(check, t.name, column, F.col(alias), bound, pred(F.col(alias)))
            for check, column, alias, bound, pred in specs]
    return wide.select(F.inline(F.array(*rows)))


def fk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q9/J10. Per declared foreign key: rows whose non-NULL key has no
    parent (left anti join, parent keys deduplicated first)."""
    out = None
    for t in STAR.values():
        if t.name not in tables:
            continue
        for col, ref_table, ref_col in t.foreign_keys:
            if ref_table not in tables:
                continue
            # one row per key before the join: a hot key is counted map-side, and the fact is not shuffled
            child = (tables[t.name].select(F.col(col).alias("_k")).filter(F.col("_k").isNotNull())
                     .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
            parent = tables[ref_table].select(F.col(ref_col).alias("_k")).distinct()
            n = child.join(parent, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
            row = n.select(F.inline(F.array(_row("foreign_key", t.name, col, F.col("n"),
                                                 f"-> {ref_table}.{ref_col}: 0 orphans", F.col("n") == 0))))
            out = row if out is None else out.unionByName(row)
    return out


def pk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q6 detail: every primary-key value that occurs more than once."""
    out = None
    for t in STAR.values():
        if t.name not in tables or not t.primary_key:
            continue
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in t.primary_key])
        d = (tables[t.name].groupBy(key.alias("key_value")).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).select(F.lit(t.name).alias("table_name"), "key_value", "n"))
        out = d if out is None else out.unionByName(d)
    return out


def quality_checks(tables: Mapping[str, DataFrame], year_range: tuple[int, int] = CHECKOUT_YEARS,
                   include_foreign_keys: bool = True) -> DataFrame:
    """Q1-Q9 over whichever star tables are given."""
    out = None
    for name, df in tables.items():
        if name not in STAR:
            continue
        r = table_checks(df, STAR[name], year_range)
        out = r if out is None else out.unionByName(r)
    if include_foreign_keys:
        fk = fk_violations(tables)
        if fk is not None:
            out = out.unionByName(fk)
    return out


def raise_on_failure(results: DataFrame) -> None:
    failed = results.filter(F.col("passed") == F.lit(False)).collect()
    if failed:
        lines = [f"{r.check_name} {r.table_name}.{r.column_name}: observed {r.observed}, want {r.bound}" for r in failed]
        raise AssertionError("data quality checks failed:\n" + "\n".join(lines))
