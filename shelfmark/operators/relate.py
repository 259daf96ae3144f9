"""Record linkage and enrichment joins (J1-J10) and deterministic dedupe (A10).

Scale notes
- Broadcast is hinted only for sides whose size is fixed by construction (one
  row per calendar day); everything else is left to the planner, where AQE
  converts a shuffle join to a broadcast only after it has measured the bytes
  of the materialised side.
- The disjunctive-key join is rewritten into an equi-join (an OR condition
  plans as a Cartesian product).
- Dedupe is an aggregate of ``min(struct(order..., rest...))``.  Struct buffers
  cannot be hash-aggregated, so each task sorts its input; but it combines
  map-side, so a key holding a third of all rows sends one row per task
  instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup_filter_join(df: DataFrame, lookup: DataFrame, left_key: str, lookup_key: str,
                       equals: Mapping[str, object], keep: Sequence[str] = ()) -> DataFrame:
    """J1/P3. Keep rows of ``df`` whose ``left_key`` is a code of ``lookup``
    passing every ``column == value`` filter.

    The lookup is filtered first and reduced to its key (plus ``keep``
    columns).  Without ``keep`` this is a semi join, so the big side never
    fans out; with ``keep`` it is an inner join bringing those columns."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    small = lookup.filter(cond).select(F.col(lookup_key).alias("_lk"), *[F.col(k) for k in keep])
    if not keep:
        small = small.distinct()
    how = "inner" if keep else "left_semi"
    out = df.join(small, F.col(left_key) == F.col("_lk"), how)
    return out.drop("_lk") if keep else out


def explode_list(df: DataFrame, list_col: str, out_col: str, delimiter: str = ", ",
                 keep: Sequence[str] = ()) -> DataFrame:
    """F7. One row per element of a delimited multi-value field (NULL -> no rows)."""
    from shelfmark.functions.text import split_list

    return df.select(*[F.col(k) for k in keep], F.explode(split_list(list_col, delimiter)).alias(out_col))


def join_any_key(left: DataFrame, right: DataFrame, left_key: str, right_keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """J2. ``left_key == right_keys[0] OR left_key == right_keys[1] ...``.

    Rewritten as an equi-join: every right row is unpivoted to its distinct
    non-NULL key values, so a pair that matches on two keys is still emitted
    once.  Plans as a sort-merge (or AQE broadcast) join, never a Cartesian
    product."""
    keys = F.array_distinct(F.array(*[F.col(k).cast("string") for k in right_keys]))
    r = right.withColumn("_any_key", F.explode(F.filter(keys, lambda k: k.isNotNull())))
    out = left.join(r, F.col(left_key).cast("string") == F.col("_any_key"), how)
    return out.drop("_any_key")


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                  descending: bool = False) -> DataFrame:
    """A10. One row per key: the row with the smallest (or, with
    ``descending``, largest) ``order_by`` values; remaining columns break ties,
    so the survivor is the same on every run and every partitioning."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = list(order_by) + rest
    if not fields:
        return df.dropDuplicates(keys)
    packed = F.struct(*[F.col(c) for c in fields])
    pick = (F.max if descending else F.min)(packed).alias("_row")
    out = df.groupBy(*keys).agg(pick)
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in fields]).select(*df.columns)


def left_enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                columns: Mapping[str, str], order_by: Sequence[str] = ()) -> DataFrame:
    """J3. Keep every left row; add ``columns`` (right name -> new name) from
    one right row per key (deterministic pick), so the left never fans out."""
    one = dedupe_by_key(right.select(right_key, *[c for c in columns if c != right_key],
                                     *[c for c in order_by if c not in columns and c != right_key]),
                        [right_key], order_by)
    one = one.select(F.col(right_key).alias("_rk"), *[F.col(src).alias(dst) for src, dst in columns.items()])
    return left.join(one, F.col(left_key) == F.col("_rk"), "left").drop("_rk")


def link_multi_key(inventory: DataFrame, external: DataFrame, id_col: str, keys_col: str,
                   external_keys: Sequence[str], columns: Mapping[str, str],
                   order_by: Sequence[str] = (), delimiter: str = ", ") -> DataFrame:
    """J4. Explode the inventory's key list, match each value against any of
    the external key columns, keep one external match per inventory id and
    left-join it back: every inventory row survives exactly once.

    The kept match is the smallest by ``order_by`` (then the other columns).
    The minimum over all matches of an id equals the minimum over its keys of
    each key's own minimum, so the external side is first reduced to one row
    per key value (a map-side-combined aggregate).  The join then emits at
    most one row per inventory key, however many external rows share a key."""
    pick_order = list(order_by) or list(external_keys)
    cols = list(dict.fromkeys([*pick_order, *columns]))
    keys = F.array_distinct(F.array(*[F.col(k).cast("string") for k in external_keys]))
    per_key = external.select(F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("_key"), *cols)
    per_key = dedupe_by_key(per_key, ["_key"], pick_order)
    exploded = explode_list(inventory, keys_col, "_key", delimiter, keep=[id_col]).withColumnRenamed(id_col, "_id")
    matched = exploded.join(per_key, "_key").drop("_key")
    return left_enrich(inventory, matched, id_col, "_id", columns, pick_order)


def join_on_date_parts(df: DataFrame, ts_col: str, daily: DataFrame, year: str = "year",
                       month: str = "month", day: str = "day", columns: Sequence[str] = (),
                       how: str = "left") -> DataFrame:
    """J5. Match the calendar day of ``ts_col`` against three integer columns.

    A three-key equi-join without a hint: a table of one row per calendar day is
    broadcast by its size, one by station or hour is not.  Duplicate days on the right fan out,
    as in the original job (checked by ``quality.pk_violations``)."""
    r = daily.select(F.col(year).alias("_y"), F.col(month).alias("_m"), F.col(day).alias("_d"), *columns)
    ts = F.col(ts_col)
    cond = (F.year(ts) == F.col("_y")) & (F.month(ts) == F.col("_m")) & (F.dayofmonth(ts) == F.col("_d"))
    return df.join(r, cond, how).drop("_y", "_m", "_d")


def two_hop_left_join(df: DataFrame, lookup: DataFrame, dim: DataFrame, df_key: str, lookup_key: str,
                      lookup_dim_key: str, dim_key: str, dim_columns: Mapping[str, str]) -> DataFrame:
    """J6. ``df`` -> lookup(key -> dim key) -> dim(dim key -> columns), both
    left joins, so every ``df`` row is kept.  The two small tables are joined
    first, so ``df`` (the large one) is joined once."""
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(lookup_dim_key).alias("_ldk"))
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(s).alias(t) for s, t in dim_columns.items()])
    resolved = lk.join(d, F.col("_ldk") == F.col("_dk"), "left").drop("_ldk", "_dk")
    return df.join(resolved, F.col(df_key) == F.col("_lk"), "left").drop("_lk")


def map_or_raw(df: DataFrame, raw_col: str, mapping: DataFrame, map_raw: str, map_official: str,
               out_col: str) -> DataFrame:
    """J8. Official name when the raw name is in the map, else the raw name."""
    m = mapping.select(F.col(map_raw).alias("_mraw"), F.col(map_official).alias("_moff"))
    out = df.join(m, F.col(raw_col) == F.col("_mraw"), "left")
    return out.withColumn(out_col, F.coalesce(F.col("_moff"), F.col(raw_col))).drop("_mraw", "_moff")


def never_referenced(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """J9. Dimension rows no fact row points at (left anti join)."""
    f = fact.select(F.col(fact_key).alias("_fk")).filter(F.col("_fk").isNotNull())
    return dim.join(f, F.col(dim_key) == F.col("_fk"), "left_anti")
