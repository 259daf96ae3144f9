"""Registered queries over the driver tables and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same tables) must agree on column names and values.  Every
query reads whole tables; limits appear only where the operator is a top-n
(preview, length extremes, top-k per group, candidate top-10).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.keys import md5_bucket, md5_row_key
from shelfmark.functions.similarity import jaro_winkler
from shelfmark.functions.temporal import (CHECKOUT_DATETIME_FORMAT, EXTERNAL_DATE_FORMAT, INVENTORY_REPORT_FORMAT,
                                          ISO_DATETIME_FORMAT, epoch_seconds_to_ts, parse_timestamp)
from shelfmark.functions.text import (clean_publisher, format_person_name, format_person_name_v0,
                                      normalize_text)
from shelfmark.operators import match, profile as prof, quality
from shelfmark.operators.keys import append_new_keys, dense_ids, unique_ids
from shelfmark.operators.rank import top_n
from shelfmark.operators.relate import (dedupe_by_key, explode_list, join_any_key, join_on_date_parts,
                                        left_enrich, lookup_filter_join, map_or_raw, two_hop_left_join)
from shelfmark.plans import analytics as A
from shelfmark.plans import catalog as C
from shelfmark.plans import deliveries as D
from shelfmark.plans import oracle as O
from shelfmark.plans import raw_feeds as R
from shelfmark.plans import star as S
from shelfmark.plans.star import StarOptions, warehouse_tables
from shelfmark.session import materialize, remove_path, scratch_path, stored
from shelfmark.sources.feeds import explode_json_map, extract_list_links, limit_rows
from shelfmark.sources.sinks import STAR, conform_schema, write_parquet
from shelfmark.sources import warehouse as W
from shelfmark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Registered without SQL, tested on worked examples.
WITHOUT_SQL = {"metaphone_pairs"}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, d, name):
    return table(spark, d, name)


def _star(spark, d):
    return C.star(spark, d)


# --------------------------------------------------------------------------- sources and sinks

@register("json_map_explode", """
SELECT event_id, k AS map_key, json_extract_string(props, '$."' || k || '"') AS map_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def q_json_map_explode(spark, d):
    return explode_json_map(_t(spark, d, "events"), "event_id", "props")


@register("epoch_to_ts", """
SELECT event_id, k AS map_key, epoch_ms(TRY_CAST(json_extract_string(props, '$."' || k || '"') AS BIGINT) * 1000)
       AS rank_ts
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def q_epoch_to_ts(spark, d):
    m = explode_json_map(_t(spark, d, "events"), "event_id", "props")
    return m.select("event_id", "map_key", epoch_seconds_to_ts("map_value").alias("rank_ts"))


_DECODE = "replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


@register("html_list_links", rf"""
SELECT page_id, link_text FROM (
  SELECT page_id, {_DECODE} AS link_text
  FROM (SELECT page_id, regexp_replace(regexp_extract(item, '(?s)<a\b[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g') AS t
        FROM (SELECT page_id, unnest(regexp_extract_all(nav, '(?s)<li\b[^>]*>(.*?)</li>', 1)) AS item
              FROM (SELECT page_id, array_to_string(regexp_extract_all(html, '(?s)<nav\b[^>]*>(.*?)</nav>', 1), ' ') AS nav
                    FROM pages))
        WHERE regexp_matches(item, '(?s)<a\b[^>]*>.*?</a>')))
WHERE NOT starts_with(link_text, 'The')""")
def q_html_list_links(spark, d):
    links, _ = extract_list_links(_t(spark, d, "pages"), "page_id", "html", "The", tag="nav")
    return links


@register("limit_rows", """
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 100""")
def q_limit_rows(spark, d):
    return limit_rows(_t(spark, d, "lineitem"), 100, ["l_orderkey", "l_linenumber"])


@register("parquet_round_trip", """
SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n, sum(l_quantity) AS sum_qty
FROM lineitem GROUP BY ALL""")
def q_parquet_round_trip(spark, d):
    li = _t(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem_by_month")
    write_parquet(li.withColumn("year", F.year("l_shipdate")).withColumn("month", F.month("l_shipdate")),
                  path, partition_by=["year", "month"])
    back = spark.read.parquet(path)
    out = materialize(back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty")))
    remove_path(spark, path)
    return out


@register("conform_schema", O.with_star("SELECT * FROM dim_book"))
def q_conform_schema(spark, d):
    # written with the job's parquet names, loaded by position into the DDL names
    books = S.build_books(C.linked_books(spark, d)).withColumnRenamed("avg_rating", "average_rating")
    path = scratch_path(spark, "dim_book")
    write_parquet(books.hint("rebalance"), path)  # dim_book grows: as many files as its size needs
    out = materialize(conform_schema(spark.read.parquet(path), STAR["dim_book"], by_position=True))
    remove_path(spark, path)
    return out


# --------------------------------------------------------------------------- projection and filters

@register("project_rename", C.SQL_INVENTORY)
def q_project_rename(spark, d):
    return C.inventory(spark, d)


_AMERICA = """
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'AMERICA'"""


@register("lookup_filter_join", f"SELECT c.*, n.n_name {_AMERICA}")
def q_lookup_filter_join(spark, d):
    return lookup_filter_join(_t(spark, d, "customer"), C.code_dictionary(spark, d), "c_nationkey", "n_nationkey",
                              {"r_name": "AMERICA"}, keep=["n_name"])


@register("drop_nulls", f"SELECT DISTINCT c.c_mktsegment {_AMERICA} AND c.c_mktsegment IS NOT NULL")
def q_drop_nulls(spark, d):
    kept = lookup_filter_join(_t(spark, d, "customer"), C.code_dictionary(spark, d), "c_nationkey", "n_nationkey",
                              {"r_name": "AMERICA"})
    return kept.select("c_mktsegment").distinct().dropna(how="any")


@register("prefix_distinct", """
SELECT DISTINCT p_name FROM part WHERE NOT starts_with(lower(p_name), 'small')""")
def q_prefix_distinct(spark, d):
    return _t(spark, d, "part").filter(~F.lower("p_name").startswith("small")).select("p_name").distinct()


@register("prefix_filter", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 's')")
def q_prefix_filter(spark, d):
    return _t(spark, d, "part").filter(F.col("p_name").startswith("s")).select("p_partkey", "p_name")


@register("point_filter", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7")
def q_point_filter(spark, d):
    return _t(spark, d, "orders").filter(F.col("o_custkey") == 7).select("o_orderkey", "o_custkey", "o_totalprice")


@register("top_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def q_top_rows(spark, d):
    return top_n(_t(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                 [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 25)


@register("unique_row_ids", "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS in_order FROM lineitem")
def q_unique_row_ids(spark, d):
    # the ids differ per run: what is promised is one per row, growing with the rows of a task
    rows = unique_ids(_t(spark, d, "lineitem").select("l_orderkey"), "row_id")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"),
                    (F.min("row_id") >= 0).alias("in_order"))


@register("hash_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE (('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT) % 100 < 20""")
def q_hash_sample(spark, d):
    o = _t(spark, d, "orders")
    return o.filter(md5_bucket("o_orderkey", 100) < 20).select("o_orderkey", "o_custkey", "o_totalprice")


# --------------------------------------------------------------------------- joins

@register("or_key_join", f"""
WITH ik AS (SELECT p_partkey, unnest([CAST(p_partkey AS VARCHAR), '978' || CAST(p_partkey * 3 AS VARCHAR)]) AS k FROM part)
SELECT ik.p_partkey, ik.k, c_custkey FROM ik
JOIN customer ON ik.k = CAST(c_custkey AS VARCHAR) OR ik.k = '978' || CAST(c_custkey AS VARCHAR)""")
def q_or_key_join(spark, d):
    # keys are near unique, as ISBNs are: two numbers a part, two a customer
    key = F.col("p_partkey")
    two = F.concat_ws(", ", key.cast("string"), F.concat(F.lit("978"), (key * 3).cast("string")))
    keys = explode_list(_t(spark, d, "part").select("p_partkey", two.alias("isbns")), "isbns", "k", keep=["p_partkey"])
    other = _t(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("isbn"),
                                            F.concat(F.lit("978"), F.col("c_custkey").cast("string")).alias("isbn13"))
    return join_any_key(keys, other, "k", ["isbn", "isbn13"]).select("p_partkey", "k", "c_custkey")


@register("left_enrich", """
SELECT c.c_custkey, c.c_name, o.o_orderkey AS first_orderkey, o.o_orderdate AS first_orderdate,
       o.o_totalprice AS first_totalprice
FROM customer c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) o
  ON c.c_custkey = o.o_custkey AND o.rn = 1""")
def q_left_enrich(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    return left_enrich(c, _t(spark, d, "orders"), "c_custkey", "o_custkey",
                       {"o_orderkey": "first_orderkey", "o_orderdate": "first_orderdate",
                        "o_totalprice": "first_totalprice"}, order_by=["o_orderdate", "o_orderkey"])


@register("link_multi_key", O.with_star("SELECT * FROM books"))
def q_link_multi_key(spark, d):
    return C.linked_books(spark, d)


@register("date_parts_join", f"""
WITH co AS ({C.SQL_CHECKOUTS}), weather AS ({C.SQL_WEATHER})
SELECT c.*, CAST(w.temperature AS DOUBLE) AS temperature FROM co c
LEFT JOIN weather w ON w.year = year(c.checkout_datetime) AND w.month = month(c.checkout_datetime)
                   AND w.day = day(c.checkout_datetime)""")
def q_date_parts_join(spark, d):
    return join_on_date_parts(C.checkouts(spark, d), "checkout_datetime", stored(C.weather(spark, d), "weather"),
                              columns=[F.col("temperature").cast("double").alias("temperature")])


@register("two_hop_left_join", O.with_star("""
SELECT c.*, p.id AS publisher_id FROM co c
LEFT JOIN pub_lookup l ON l.bib_num = c.bib_num LEFT JOIN dim_publisher_k p ON p.key = l.key"""))
def q_two_hop_left_join(spark, d):
    lookup = S.publisher_lookup(C.linked_books(spark, d), None)
    return two_hop_left_join(C.checkouts(spark, d), lookup, S.build_publishers(lookup),
                             "bib_num", "bib_num", "key", "key", {"id": "publisher_id"})


@register("bridge_multi_value", O.with_star("SELECT * FROM br_book_subject"))
def q_bridge_multi_value(spark, d):
    books = C.linked_books(spark, d)
    return S.build_book_subjects(books, S.build_subjects(books))


# fuzzy-matching inputs: official names = distinct part names; dirty names = part
# names with a type word appended, and part names missing their first letter.
def _raw_names(spark, d):
    p = _t(spark, d, "part")
    return (p.select("p_partkey", F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type")).alias("raw_name"))
             .unionByName(p.select("p_partkey", F.substr(F.col("p_name"), F.lit(2)).alias("raw_name"))))


def _gazetteer(spark, d):
    return _t(spark, d, "part").select(F.col("p_name").alias("official")).distinct()


_SQL_RAW = """SELECT p_partkey, p_name || ' ' || lower(p_type) AS raw_name FROM part
              UNION ALL SELECT p_partkey, substr(p_name, 2) AS raw_name FROM part"""


def _sql_pre(x):
    return rf"trim(lower(regexp_replace({x}, '\W', ' ', 'g')))"


def _sql_tokens(x):
    return f"list_filter(string_split_regex({x}, ' +'), lambda t: t <> '')"


def _sql_stem(t):
    return (f"CASE WHEN length({t}) > 4 AND suffix({t}, 'ies') THEN regexp_replace({t}, 'ies$', '') || 'y' "
            f"WHEN length({t}) > 3 AND suffix({t}, 's') AND NOT suffix({t}, 'ss') THEN regexp_replace({t}, 's$', '') "
            f"ELSE {t} END")


def _sql_ratio(a, b):
    return (f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 100 ELSE CAST(round(100.0::DOUBLE * "
            f"(1.0::DOUBLE - levenshtein({a}, {b}) / greatest(length({a}), length({b})))) AS INTEGER) END")


_SQL_CANDIDATES = f"""
raw_names AS (SELECT DISTINCT raw_name AS name FROM ({_SQL_RAW}) WHERE raw_name IS NOT NULL),
gaz AS (SELECT DISTINCT p_name AS official FROM part WHERE p_name IS NOT NULL),
gtok AS (SELECT DISTINCT official, {_sql_stem('t')} AS token
         FROM (SELECT official, unnest({_sql_tokens(_sql_pre('official'))}) AS t FROM gaz)),
gdf AS (SELECT token, count(*) AS df FROM gtok GROUP BY token),
gidx AS (SELECT g.token, g.official, ln(1.0 + (SELECT count(*) FROM gaz)::DOUBLE / d.df) AS idf
         FROM gtok g JOIN gdf d ON g.token = d.token),
ntok AS (SELECT DISTINCT name, {_sql_stem('t')} AS token
         FROM (SELECT name, unnest({_sql_tokens(_sql_pre('name'))}) AS t FROM raw_names)),
scored AS (SELECT n.name, g.official, round(sum(g.idf), 9) AS relevance
           FROM ntok n JOIN gidx g ON n.token = g.token GROUP BY n.name, g.official),
cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY relevance DESC, official) AS rank
                        FROM scored) WHERE rank <= 10)"""

_SQL_BEST = f"""
pre AS (SELECT name, official, relevance, rank, {_sql_pre('name')} AS pa, {_sql_pre('official')} AS pb FROM cand),
tk AS (SELECT *, {_sql_tokens('pa')} AS la, {_sql_tokens('pb')} AS lb FROM pre),
st AS (SELECT *, list_distinct(la) AS da, list_distinct(lb) AS db,
              array_to_string(list_sort(la), ' ') AS sa, array_to_string(list_sort(lb), ' ') AS sb FROM tk),
ts AS (SELECT *, array_to_string(list_sort(list_intersect(da, db)), ' ') AS inter,
              array_to_string(list_sort(list_filter(da, lambda x: NOT list_contains(db, x))), ' ') AS only_a,
              array_to_string(list_sort(list_filter(db, lambda x: NOT list_contains(da, x))), ' ') AS only_b FROM st),
t12 AS (SELECT *, trim(concat_ws(' ', inter, only_a)) AS t1, trim(concat_ws(' ', inter, only_b)) AS t2 FROM ts),
sc AS (SELECT name, official, relevance, rank,
              greatest({_sql_ratio('pa', 'pb')}, {_sql_ratio('sa', 'sb')},
                       greatest({_sql_ratio('inter', 't1')}, {_sql_ratio('inter', 't2')}, {_sql_ratio('t1', 't2')}))
              AS score FROM t12),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name
                                  ORDER BY score DESC, relevance DESC, rank ASC, official DESC) AS rn FROM sc)
         WHERE rn = 1 AND score >= 89)"""


@register("match_candidates", f"WITH {_SQL_CANDIDATES.strip()}\nSELECT * FROM cand")
def q_match_candidates(spark, d):
    names = _raw_names(spark, d).select(F.col("raw_name").alias("name")).distinct()
    return match.match_candidates(names, _gazetteer(spark, d), "name", "official")


@register("fuzzy_best_match", f"""WITH {_SQL_CANDIDATES.strip()},{_SQL_BEST}
SELECT name AS publisher, official AS official_publisher FROM best""")
def q_fuzzy_best_match(spark, d):
    return match.build_name_map(_raw_names(spark, d), "raw_name", _gazetteer(spark, d), "official")


@register("jaro_winkler_pairs", f"""WITH {_SQL_CANDIDATES.strip()}
SELECT name, official, round(jaro_winkler_similarity(name, official), 6) AS jw FROM cand""")
def q_jaro_winkler_pairs(spark, d):
    names = _raw_names(spark, d).select(F.col("raw_name").alias("name")).distinct()
    cand = match.match_candidates(names, _gazetteer(spark, d), "name", "official")
    return cand.select("name", "official", F.round(jaro_winkler("name", "official"), 6).alias("jw"))


@register("map_or_raw", f"""WITH {_SQL_CANDIDATES.strip()},{_SQL_BEST}
SELECT r.p_partkey, r.raw_name, coalesce(b.official, r.raw_name) AS publisher
FROM ({_SQL_RAW}) r LEFT JOIN best b ON b.name = r.raw_name""")
def q_map_or_raw(spark, d):
    raw = _raw_names(spark, d)
    name_map = match.build_name_map(raw, "raw_name", _gazetteer(spark, d), "official")
    return map_or_raw(raw, "raw_name", name_map, "publisher", "official_publisher", "publisher")


# four ways to write a publisher, dealt by book number
_SQL_SPELLINGS = """CASE CAST(bib_num AS BIGINT) % 4 WHEN 0 THEN raw_publisher WHEN 1 THEN upper(raw_publisher)
                    WHEN 2 THEN raw_publisher || ' (reprint)' ELSE replace(raw_publisher, '#', ' # ') END"""


@register("dedupe_pairs", f"""
WITH inv AS (SELECT {_SQL_SPELLINGS} AS spelling FROM ({C.SQL_INVENTORY})),
k AS (SELECT spelling AS name, {O.normalize('spelling')} AS key FROM inv),
tot AS (SELECT count(*)::DOUBLE AS t FROM k WHERE key IS NOT NULL),
names AS (SELECT name, key, count(*) AS name_rows FROM k WHERE key IS NOT NULL GROUP BY name, key),
sizes AS (SELECT key, sum(name_rows)::BIGINT AS cluster_rows, count(*) AS cluster_names FROM names GROUP BY key),
reps AS (SELECT key, name AS representative FROM names
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY name_rows DESC, name) = 1),
j AS (SELECT n.name, n.key, n.name_rows, s.cluster_rows, s.cluster_names, r.representative,
             {_sql_ratio('n.name', 'r.representative')} AS similarity,
             -log2(s.cluster_rows / (SELECT t FROM tot)) AS tf
      FROM names n JOIN sizes s ON n.key = s.key JOIN reps r ON r.key = n.key)
SELECT name, key, name_rows, cluster_rows, cluster_names, representative, similarity, round(tf, 6) AS tf_weight,
       round(tf * similarity / 100, 6) AS match_weight FROM j""")
def q_dedupe_pairs(spark, d):
    inventory = C.inventory(spark, d).withColumn("spelling", F.expr(_SQL_SPELLINGS))
    return match.duplicate_clusters(inventory, "spelling", normalize_text("spelling"))


@register("never_referenced", O.with_star("""
SELECT bib_num, title FROM dim_book b
WHERE NOT EXISTS (SELECT 1 FROM fact_spl_book_checkout f
                  WHERE f.bib_num = b.bib_num AND year(f.checkout_datetime) = 1998)"""))
def q_never_referenced(spark, d):
    # every part is sold at some time: the question is asked for one year
    s = _star(spark, d)
    return A.books_never_checked_out(s["dim_book"], s["fact_spl_book_checkout"].filter("year(checkout_datetime) = 1998"))


def _fk_sql(child, col, parent, pcol, tables=None):
    return (f"SELECT 'foreign_key' AS check_name, '{child}' AS table_name, '{col}' AS column_name, "
            f"CAST(count(*) AS DOUBLE) AS observed, '-> {parent}.{pcol}: 0 orphans' AS bound, count(*) = 0 AS passed "
            f"FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {(tables or {}).get(parent, parent)} p WHERE p.{pcol} = c.{col})")


_FK_SQL = "\nUNION ALL\n".join(_fk_sql(t.name, c, rt, rc) for t in STAR.values() for c, rt, rc in t.foreign_keys)


# --------------------------------------------------------------------------- aggregation

_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("profile_columns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS n_empty FROM customer" for c in _CUSTOMER_COLS))
def q_profile_columns(spark, d):
    return prof.profile(_t(spark, d, "customer"), _CUSTOMER_COLS)


@register("basic_stats", """
SELECT count(o_totalprice) AS o_totalprice_n, round(avg(o_totalprice), 6) AS o_totalprice_avg,
       min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
       count(o_orderdate) AS o_orderdate_n, min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max,
       count(o_orderpriority) AS o_orderpriority_n,
       round(avg(TRY_CAST(o_orderpriority AS DOUBLE)), 6) AS o_orderpriority_avg,
       min(o_orderpriority) AS o_orderpriority_min, max(o_orderpriority) AS o_orderpriority_max
FROM orders""")
def q_basic_stats(spark, d):
    return prof.basic_stats(_t(spark, d, "orders"), ["o_totalprice", "o_orderdate", "o_orderpriority"])


@register("length_extremes", """
(SELECT doc_id, length(text) AS len, 'shortest' AS kind, text AS value FROM documents ORDER BY len, doc_id LIMIT 10)
UNION ALL
(SELECT doc_id, length(text) AS len, 'longest' AS kind, text AS value FROM documents ORDER BY len DESC, doc_id LIMIT 10)""")
def q_length_extremes(spark, d):
    return prof.length_extremes(_t(spark, d, "documents"), "text", "doc_id", 10)


def _hist_sql(tbl, col, bins, where=""):
    w = f"WHERE {where}" if where else ""
    a = f"AND {where}" if where else ""
    return f"""
WITH s AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {tbl} {w}),
c AS (SELECT least(greatest(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER) + 1, 1), {bins}) AS bin,
             count(*) AS n
      FROM {tbl}, s WHERE {col} IS NOT NULL AND {col} >= lo AND {col} <= hi {a} GROUP BY 1),
g AS (SELECT CAST(range + 1 AS INTEGER) AS bin FROM range({bins}))
SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / {bins}), 6) AS bin_lo,
       round(lo + g.bin * ((hi - lo) / {bins}), 6) AS bin_hi, coalesce(c.n, 0) AS n
FROM g CROSS JOIN s LEFT JOIN c ON g.bin = c.bin"""


@register("histogram", _hist_sql("lineitem", "l_extendedprice", 20))
def q_histogram(spark, d):
    return prof.histogram(_t(spark, d, "lineitem"), "l_extendedprice", 20)


@register("histogram_trimmed", _hist_sql("orders", "o_totalprice", 40, "o_totalprice < 400000"))
def q_histogram_trimmed(spark, d):
    return prof.histogram(_t(spark, d, "orders"), "o_totalprice", 40, where=F.col("o_totalprice") < 400000)


@register("group_stats", """
SELECT l_suppkey, count(*) AS n, round(avg(l_quantity), 6) AS avg, min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem GROUP BY l_suppkey""")
def q_group_stats(spark, d):
    return prof.group_stats(_t(spark, d, "lineitem"), ["l_suppkey"], "l_quantity")


@register("group_by_year_stats", """
SELECT year(o_orderdate) AS year, count(*) AS n, round(avg(o_totalprice), 6) AS avg, min(o_totalprice) AS min,
       max(o_totalprice) AS max FROM orders GROUP BY 1""")
def q_group_by_year_stats(spark, d):
    return prof.group_stats(_t(spark, d, "orders"), [F.year("o_orderdate").alias("year")], "o_totalprice")


@register("key_frequency", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey""")
def q_key_frequency(spark, d):
    return prof.key_frequency(_t(spark, d, "orders"), ["o_custkey"])


@register("dedupe_by_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def q_dedupe_by_key(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return dedupe_by_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], descending=True)


@register("time_rollup", """
SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n, sum(l_quantity) AS sum_l_quantity
FROM lineitem GROUP BY ROLLUP (year(l_shipdate), month(l_shipdate))""")
def q_time_rollup(spark, d):
    li = _t(spark, d, "lineitem")
    return prof.rollup_counts(li, [F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")],
                              "l_quantity")


@register("explode_counts", """
SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY token""")
def q_explode_counts(spark, d):
    return (explode_list(_t(spark, d, "part"), "p_name", "token", " ")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------------------- scalar functions

@register("clean_title", O.with_star("SELECT bib_num, title, raw_title FROM dim_book"))
def q_clean_title(spark, d):
    return S.build_books(C.linked_books(spark, d)).select("bib_num", "title", "raw_title")


@register("extract_min_year", O.with_star(
    "SELECT publication_year, count(*) AS n_books FROM dim_book GROUP BY publication_year"))
def q_extract_min_year(spark, d):
    return A.books_per_publication_year(S.build_books(C.linked_books(spark, d)))


@register("clean_trailing_commas", f"""
WITH inv AS ({C.SQL_INVENTORY})
SELECT bib_num, raw_publisher, {O.clean_publisher('raw_publisher')} AS publisher FROM inv""")
def q_clean_trailing_commas(spark, d):
    return C.inventory(spark, d).select("bib_num", "raw_publisher",
                                        clean_publisher("raw_publisher").alias("publisher"))


@register("format_person_name", f"""
WITH inv AS ({C.SQL_INVENTORY})
SELECT bib_num, raw_author, {O.format_author('raw_author')} AS author FROM inv""")
def q_format_person_name(spark, d):
    return C.inventory(spark, d).select("bib_num", "raw_author", format_person_name("raw_author").alias("author"))


@register("format_person_name_v0", f"""
WITH inv AS ({C.SQL_INVENTORY}), p AS (SELECT bib_num, raw_author, string_split(raw_author, ', ') AS p FROM inv)
SELECT bib_num, CASE WHEN len(p) IN (2, 3) THEN p[2] || ' ' || p[1] ELSE raw_author END AS author FROM p""")
def q_format_person_name_v0(spark, d):
    return C.inventory(spark, d).select("bib_num", format_person_name_v0("raw_author").alias("author"))


@register("normalize_text", f"""
WITH inv AS ({C.SQL_INVENTORY})
SELECT bib_num, {O.normalize('raw_title')} AS title_key, {O.normalize("raw_title || '  ''x  (' || raw_author || ') '")} AS long_key,
       {O.normalize('raw_publisher')} AS publisher_key FROM inv""")
def q_normalize_text(spark, d):
    longer = F.concat(F.col("raw_title"), F.lit("  'x  ("), F.col("raw_author"), F.lit(") "))
    return C.inventory(spark, d).select("bib_num", normalize_text("raw_title").alias("title_key"),
                                        normalize_text(longer).alias("long_key"),
                                        normalize_text("raw_publisher").alias("publisher_key"))


@register("union_normalise", O.with_star("SELECT bib_num, name, key FROM author_keys"))
def q_union_normalise(spark, d):
    names = S.book_author_names(C.linked_books(spark, d), StarOptions())
    return names.select("bib_num", "name", normalize_text("name").alias("key"))


@register("md5_row_key", """
SELECT l_orderkey, l_linenumber,
       md5(concat_ws('=', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_shipdate AS VARCHAR)))
       AS row_key FROM lineitem""")
def q_md5_row_key(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", md5_row_key("l_orderkey", "l_linenumber", "l_shipdate")
                     .alias("row_key"))


@register("time_dimension", O.with_star("SELECT * FROM dim_checkout_time"))
def q_time_dimension(spark, d):
    return S.build_time_dim(C.checkouts(spark, d))


@register("parse_timestamps", f"""
WITH co AS ({C.SQL_CHECKOUTS})
SELECT item_barcode, checkout_datetime AS checkout_ts, checkout_datetime AS report_ts, checkout_datetime AS iso_ts,
       date_trunc('day', checkout_datetime)::TIMESTAMP AS external_ts, CAST(NULL AS TIMESTAMP) AS bad_ts FROM co""")
def q_parse_timestamps(spark, d):
    co = C.checkouts(spark, d)
    text = lambda fmt: F.date_format("checkout_datetime", fmt)
    return co.select("item_barcode",
                     parse_timestamp(text(CHECKOUT_DATETIME_FORMAT), CHECKOUT_DATETIME_FORMAT).alias("checkout_ts"),
                     parse_timestamp(text(INVENTORY_REPORT_FORMAT), INVENTORY_REPORT_FORMAT).alias("report_ts"),
                     parse_timestamp(text(ISO_DATETIME_FORMAT), ISO_DATETIME_FORMAT).alias("iso_ts"),
                     parse_timestamp(text(EXTERNAL_DATE_FORMAT), EXTERNAL_DATE_FORMAT).alias("external_ts"),
                     parse_timestamp(text("HH-mm"), EXTERNAL_DATE_FORMAT).alias("bad_ts"))


# --------------------------------------------------------------------------- keys, dimensions, fact

@register("surrogate_key", """
SELECT row_number() OVER (ORDER BY o_orderdate) - 1 AS id, o_orderdate FROM (SELECT DISTINCT o_orderdate FROM orders)""")
def q_surrogate_key(spark, d):
    days = _t(spark, d, "orders").select("o_orderdate").distinct()
    return dense_ids(days, ["o_orderdate"], "id").select("id", "o_orderdate")


@register("dim_multi_value", O.with_star("SELECT * FROM dim_subject"))
def q_dim_multi_value(spark, d):
    return S.build_subjects(C.linked_books(spark, d))


@register("dim_normalised", O.with_star("SELECT * FROM dim_author"))
def q_dim_normalised(spark, d):
    return S.build_authors(C.linked_books(spark, d)).select("id", "name")


@register("bridge_normalised", O.with_star("SELECT * FROM br_book_author"))
def q_bridge_normalised(spark, d):
    books = C.linked_books(spark, d)
    return S.build_book_authors(books, S.build_authors(books))


@register("dim_from_lookup", O.with_star("SELECT * FROM dim_publisher"))
def q_dim_from_lookup(spark, d):
    return S.build_publishers(S.publisher_lookup(C.linked_books(spark, d), None)).select("id", "name")


@register("fact_build", O.with_star("SELECT * FROM fact_spl_book_checkout"))
def q_fact_build(spark, d):
    lookup = S.publisher_lookup(C.linked_books(spark, d), None)
    return S.build_fact(C.checkouts(spark, d), stored(C.weather(spark, d), "weather"), lookup, S.build_publishers(lookup))


@register("incremental_keys", """
WITH t AS (SELECT DISTINCT CASE WHEN day(l_shipdate) <> 13 THEN l_shipdate END AS checkout_datetime FROM lineitem),
old AS (SELECT checkout_datetime, row_number() OVER (ORDER BY checkout_datetime NULLS FIRST) - 1 AS id FROM t
        WHERE year(checkout_datetime) < 1998 OR checkout_datetime IS NULL),
new AS (SELECT checkout_datetime,
               (SELECT coalesce(max(id), -1) FROM old) + row_number() OVER (ORDER BY checkout_datetime) AS id
        FROM t WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.checkout_datetime IS NOT DISTINCT FROM t.checkout_datetime))
SELECT * FROM old UNION ALL SELECT * FROM new""")
def q_incremental_keys(spark, d):
    # the 13th of a month stands for a bad date: a NULL key in both loads
    time = F.when(F.dayofmonth("l_shipdate") != 13, F.col("l_shipdate"))
    times = _t(spark, d, "lineitem").select(time.alias("checkout_datetime")).distinct()
    first = F.col("checkout_datetime").isNull() | (F.year("checkout_datetime") < 1998)
    first_load = dense_ids(times.filter(first), ["checkout_datetime"], "id")
    _, full = append_new_keys(first_load, times, "checkout_datetime", "id")
    return full


# --------------------------------------------------------------------------- quality

def _quality_sql() -> str:
    from shelfmark.operators.quality import BARCODE_LENGTH, CHECKOUT_YEARS, COUNT_COLUMN, MAX_TEMPERATURE, RATING_RANGE

    parts = []

    def row(check, tname, col, observed, bound, passed):
        parts.append(f"SELECT '{check}' AS check_name, '{tname}' AS table_name, '{col}' AS column_name, "
                     f"CAST(({observed}) AS DOUBLE) AS observed, '{bound}' AS bound, ({passed}) AS passed "
                     f"FROM {tname}")

    for t in STAR.values():
        cc = COUNT_COLUMN[t.name]
        row("non_empty", t.name, cc, f"count({cc})", "> 0", f"count({cc}) > 0")
        for c in t.columns:
            if c.not_null:
                e = f"count(*) FILTER (WHERE {c.name} IS NULL)"
                row("not_null", t.name, c.name, e, "= 0", f"{e} = 0")
            if c.max_bytes:
                e = f"count(*) FILTER (WHERE strlen({c.name}) > {c.max_bytes})"
                row("max_bytes", t.name, c.name, e, f"<= {c.max_bytes} bytes: 0 over", f"{e} = 0")
        if t.primary_key:
            pk = ", ".join(t.primary_key)
            nn = " AND ".join(f"{k} IS NOT NULL" for k in t.primary_key)
            e = f"count(*) FILTER (WHERE {nn}) - count(DISTINCT ({pk}))"
            if len(t.primary_key) == 1:
                e = f"count(*) FILTER (WHERE {nn}) - count(DISTINCT {pk})"
            row("unique_key", t.name, ",".join(t.primary_key), e, "= 0 duplicates", f"{e} = 0")
        if t.name == "fact_spl_book_checkout":
            row("max_temperature", t.name, "temperature", "max(temperature)", f"< {MAX_TEMPERATURE}",
                f"coalesce(max(temperature) < {MAX_TEMPERATURE}, true)")
            e = f"count(item_barcode) FILTER (WHERE length(item_barcode) <> {BARCODE_LENGTH})"
            row("barcode_length", t.name, "item_barcode", e, f"= 0 not {BARCODE_LENGTH} long", f"{e} = 0")
        if t.name == "dim_book":
            lo, hi = RATING_RANGE
            row("rating_min", t.name, "avg_rating", "min(avg_rating)", f">= {lo}", f"min(avg_rating) >= {lo}")
            row("rating_max", t.name, "avg_rating", "max(avg_rating)", f"<= {hi}", f"max(avg_rating) <= {hi}")
        if t.name == "dim_checkout_time":
            y0, y1 = CHECKOUT_YEARS
            e = f"count(checkout_datetime) FILTER (WHERE year < {y0} OR year > {y1})"
            row("checkout_year", t.name, "year", e, f"= 0 outside {y0}..{y1}", f"{e} = 0")
    return "\nUNION ALL\n".join(parts + [_FK_SQL])


@register("quality_checks", O.with_star(_quality_sql()))
def q_quality_checks(spark, d):
    return quality.quality_checks(warehouse_tables(_star(spark, d)))


def _dirty(spark, d):
    """The star with faults: subjects and books that stand twice, authors and
    publishers and times that are missing."""
    s = dict(warehouse_tables(_star(spark, d)))
    s["dim_subject"] = s["dim_subject"].unionByName(s["dim_subject"].filter("id % 7 = 0"))
    s["dim_book"] = s["dim_book"].unionByName(s["dim_book"].filter("cast(bib_num as bigint) % 11 = 0"))
    s["dim_author"] = s["dim_author"].filter("id % 5 <> 0")
    s["dim_publisher"] = s["dim_publisher"].filter("id % 3 <> 0")
    s["dim_checkout_time"] = s["dim_checkout_time"].filter("hour <> 13")
    return s


_DIRTY_SQL = {
    "dim_subject": "(SELECT * FROM dim_subject UNION ALL SELECT * FROM dim_subject WHERE id % 7 = 0)",
    "dim_book": "(SELECT * FROM dim_book UNION ALL SELECT * FROM dim_book WHERE CAST(bib_num AS BIGINT) % 11 = 0)",
    "dim_author": "(SELECT * FROM dim_author WHERE id % 5 <> 0)",
    "dim_publisher": "(SELECT * FROM dim_publisher WHERE id % 3 <> 0)",
    "dim_checkout_time": "(SELECT * FROM dim_checkout_time WHERE hour <> 13)",
}


@register("pk_violations", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{t.name}' AS table_name, CAST({t.primary_key[0]} AS VARCHAR) AS key_value, count(*) AS n "
    f"FROM {_DIRTY_SQL.get(t.name, t.name)} GROUP BY {t.primary_key[0]} HAVING count(*) > 1"
    for t in STAR.values() if t.primary_key)))
def q_pk_violations(spark, d):
    return quality.pk_violations(_dirty(spark, d))


@register("fk_violations", O.with_star("\nUNION ALL\n".join(
    _fk_sql(t.name, c, rt, rc, _DIRTY_SQL) for t in STAR.values() for c, rt, rc in t.foreign_keys)))
def q_fk_violations(spark, d):
    return quality.fk_violations(_dirty(spark, d))


# --------------------------------------------------------------------------- analytic questions

@register("topk_per_group", O.with_star("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, bib_num) AS rank
               FROM (SELECT bib_num, year(checkout_datetime) AS year, count(*) AS n
                     FROM fact_spl_book_checkout GROUP BY ALL)) WHERE rank <= 10"""))
def q_topk_per_group(spark, d):
    return A.top_books_per_year(_star(spark, d)["fact_spl_book_checkout"], 10)


@register("count_by_weekday", O.with_star("""
SELECT dayofweek(checkout_datetime) + 1 AS weekday, count(*) AS n FROM fact_spl_book_checkout GROUP BY 1"""))
def q_count_by_weekday(spark, d):
    return A.checkouts_by_weekday(_star(spark, d)["fact_spl_book_checkout"])


@register("hour_by_category", O.with_star("""
SELECT b.subject_id, s.name AS subject, hour(f.checkout_datetime) AS hour, count(*) AS n
FROM fact_spl_book_checkout f JOIN br_book_subject b ON f.bib_num = b.bib_num JOIN dim_subject s ON s.id = b.subject_id
GROUP BY ALL"""))
def q_hour_by_category(spark, d):
    s = _star(spark, d)
    return A.hour_by_subject(s["fact_spl_book_checkout"], s["br_book_subject"], s["dim_subject"])


@register("rating_correlation", O.with_star("""
SELECT count(*) AS n_books, round(corr(b.avg_rating, coalesce(c.n, 0)::DOUBLE), 6) AS corr_rating_checkouts
FROM dim_book b LEFT JOIN (SELECT bib_num, count(*) AS n FROM fact_spl_book_checkout GROUP BY bib_num) c
  ON b.bib_num = c.bib_num
WHERE b.avg_rating IS NOT NULL"""))
def q_rating_correlation(spark, d):
    s = _star(spark, d)
    return A.rating_vs_checkouts(s["dim_book"], s["fact_spl_book_checkout"])


@register("top_by_bridge", O.with_star("""
SELECT p.author_id, a.name AS author, sum(c.n) AS n
FROM (SELECT bib_num, count(*) AS n FROM fact_spl_book_checkout GROUP BY bib_num) c
JOIN (SELECT DISTINCT bib_num, author_id FROM br_book_author) p ON c.bib_num = p.bib_num
JOIN dim_author a ON a.id = p.author_id GROUP BY ALL"""))
def q_top_by_bridge(spark, d):
    s = _star(spark, d)
    return A.checkouts_per_author(s["fact_spl_book_checkout"], s["br_book_author"], s["dim_author"])


@register("distinct_per_bridge", O.with_star("""
SELECT b.author_id, a.name AS author, count(DISTINCT b.bib_num) AS n_books
FROM br_book_author b JOIN dim_author a ON a.id = b.author_id GROUP BY ALL"""))
def q_distinct_per_bridge(spark, d):
    s = _star(spark, d)
    return A.books_per_author(s["br_book_author"], s["dim_author"])


_DAILY = """(SELECT CAST(checkout_datetime AS DATE) AS day, max(temperature) AS temperature, count(*) AS n
             FROM fact_spl_book_checkout GROUP BY 1
             HAVING max(temperature) IS NOT NULL AND max(temperature) <> -99.0)"""


@register("band_effect", O.with_star(f"""
SELECT CAST(floor(temperature / 10.0) * 10.0 AS DOUBLE) AS band, count(*) AS n_days, sum(n) AS n_checkouts,
       round(avg(n), 6) AS avg_per_day
FROM {_DAILY} GROUP BY 1"""))
def q_band_effect(spark, d):
    return A.temperature_band_effect(_star(spark, d)["fact_spl_book_checkout"])


@register("band_correlation", O.with_star(f"""
SELECT count(*) AS n_days, round(corr(temperature, n::DOUBLE), 6) AS corr_temp_checkouts FROM {_DAILY}"""))
def q_band_correlation(spark, d):
    return A.temperature_correlation(_star(spark, d)["fact_spl_book_checkout"])


@register("new_vs_old", O.with_star("""
SELECT age, sum(n) AS n_checkouts, count(DISTINCT bib_num) AS n_books,
       round(sum(n) / count(DISTINCT bib_num), 6) AS avg_per_book
FROM (SELECT c.bib_num, c.n,
             CASE WHEN b.publication_year IS NULL THEN 'unknown' WHEN b.publication_year = c.year THEN 'new'
                  WHEN b.publication_year < c.year THEN 'old' ELSE 'future' END AS age
      FROM (SELECT bib_num, year(checkout_datetime) AS year, count(*) AS n FROM fact_spl_book_checkout GROUP BY ALL) c
      LEFT JOIN dim_book b ON b.bib_num = c.bib_num)
GROUP BY age"""))
def q_new_vs_old(spark, d):
    s = _star(spark, d)
    return A.new_vs_old(s["fact_spl_book_checkout"], s["dim_book"])


@register("count_per_dim", O.with_star("""
SELECT p.id AS publisher_id, p.name AS publisher, count(DISTINCT l.bib_num) AS n_books
FROM pub_lookup l LEFT JOIN dim_publisher_k p ON p.key = l.key GROUP BY ALL"""))
def q_count_per_dim(spark, d):
    lookup = S.publisher_lookup(C.linked_books(spark, d), None)
    return A.books_per_publisher(lookup, S.build_publishers(lookup))


# --------------------------------------------------------------------------- raw feeds (files written, read and built)

_PRINT = "CAST(bib_num AS BIGINT) % 5 IN (0, 2, 4)"
_RAW = {
    "inventory": f"SELECT * FROM ({C.SQL_INVENTORY}) WHERE {_PRINT}",
    "checkouts": f"SELECT * FROM ({C.SQL_CHECKOUTS}) WHERE {_PRINT}",
    "external": f"SELECT * REPLACE (CAST(CAST(average_rating AS FLOAT) AS DOUBLE) AS average_rating) FROM ({C.SQL_EXTERNAL})",
    "weather": f"SELECT * REPLACE (CAST(CAST(temperature AS FLOAT) AS DOUBLE) AS temperature) FROM ({C.SQL_WEATHER})",
}


@register("raw_feed_books", O.with_star("SELECT * FROM dim_book", **_RAW))
def q_raw_feed_books(spark, d):
    return R.raw_star_table(spark, d, "dim_book")


@register("raw_feed_fact", O.with_star("SELECT * FROM fact_spl_book_checkout", **_RAW))
def q_raw_feed_fact(spark, d):
    return R.raw_star_table(spark, d, "fact_spl_book_checkout")


@register("raw_feed_authors", O.with_star("SELECT * FROM dim_author", **_RAW))
def q_raw_feed_authors(spark, d):
    return R.raw_star_table(spark, d, "dim_author")


@register("raw_name_map", """
SELECT DISTINCT p_brand || ', the ' AS publisher, p_brand AS official_publisher FROM part""")
def q_raw_name_map(spark, d):
    return R.name_map(spark, d)


@register("raw_gazetteer", "SELECT DISTINCT p_name AS publisher FROM part")
def q_raw_gazetteer(spark, d):
    return R.gazetteer(spark, d)


@register("raw_json_maps", """
SELECT DISTINCT event_type AS file_key, CAST(CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS VARCHAR) AS map_key,
       event_type AS map_value FROM events""")
def q_raw_json_maps(spark, d):
    return R.json_map_files(spark, d)


def _warehouse_sql() -> str:
    parts = []
    for t in STAR.values():
        keys = f"count(DISTINCT {t.primary_key[0]})" if t.primary_key else "CAST(NULL AS BIGINT)"
        orphans = "".join(f" + (SELECT count(*) FROM {t.name} c WHERE c.{c} IS NOT NULL AND NOT EXISTS "
                          f"(SELECT 1 FROM {rt} p WHERE p.{rc} = c.{c}))" for c, rt, rc in t.foreign_keys)
        met = "FROM fact_spl_book_checkout JOIN dim_checkout_time USING (checkout_datetime)"
        fact = t.name == W.FACT
        parts.append(f"SELECT '{t.name}' AS table_name, count(*) AS n_rows, {keys} AS n_keys, "
                     f"{'0' + orphans if orphans else 'CAST(NULL AS BIGINT)'} AS n_orphans, "
                     f"{f'(SELECT count(*) {met})' if fact else 'CAST(NULL AS BIGINT)'} AS n_with_time, "
                     f"{f'(SELECT sum(weekday) {met})' if fact else 'CAST(NULL AS BIGINT)'} AS sum_weekday FROM {t.name}")
    return " UNION ALL ".join(parts)


@register("warehouse_tables", O.with_star(_warehouse_sql()))
def q_warehouse_tables(spark, d):
    return D.warehouse_report(spark, d)


# --------------------------------------------------------------------------- incremental loads

def _given(select_sql: str) -> str:
    return O.with_star(f", {D.given_ids_sql(O.clean_publisher('name'))}\n{select_sql}")


@register("incremental_dimensions", _given("\nUNION ALL\n".join(
    f"SELECT 'dim_{n}' AS table_name, id, name FROM given_{n}" for n in ("author", "subject", "publisher"))))
def q_incremental_dimensions(spark, d):
    return D.delivered_dimensions(spark, d)


@register("incremental_bridges", _given("""
SELECT a.bib_num, 'br_book_author' AS table_name, g.id FROM author_keys a JOIN given_author g ON a.key = g.key
UNION ALL
SELECT b.bib_num, 'br_book_subject' AS table_name, g.id
FROM (SELECT bib_num, unnest(string_split(raw_subjects, ', ')) AS name FROM books) b JOIN given_subject g ON b.name = g.name"""))
def q_incremental_bridges(spark, d):
    return D.delivered_bridges(spark, d)


@register("incremental_fact", _given("""
SELECT f.bib_num, f.item_barcode, f.checkout_datetime, f.temperature, g.id AS publisher_id, f.id
FROM fact_spl_book_checkout f LEFT JOIN pub_lookup l ON l.bib_num = f.bib_num LEFT JOIN given_publisher g ON g.key = l.key"""))
def q_incremental_fact(spark, d):
    return D.delivered_fact(spark, d)
