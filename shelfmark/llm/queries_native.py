"""Queries of the operators that are built-in expressions only (4, 7, 9), with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import decontaminate, line_dedup, quality_rules
from shelfmark.llm.frames import documents, with_identity


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedupe_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontaminate.contaminated(docs, bench)
    ids = with_identity(docs).select("doc_id", "_id", "_th")
    return ids.join(out, ["_id", "_th"]).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.col("_n_hit") > 0).alias("contaminated"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_rules.judged(docs).select(
        "doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


QUERIES = {"op4_line_dedup": op4_line_dedup, "op7_decontamination": op7_decontamination,
           "op9_quality_rules": op9_quality_rules}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM x),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, k.pos, k.line, o.owner IS NOT NULL AND k.doc_id > o.owner AS gone
      FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_WORDS7 = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS7}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS7} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS win FROM (
         SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w] ELSE [w[i:i+9] FOR i IN range(1, len(w) - 8)] END) AS g
         FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n.n, unnest(range(1, len(w) - n.n + 2)) AS s,
              unnest([array_to_string(w[i:i+n.n-1], ' ') FOR i IN range(1, len(w) - n.n + 2)]) AS win
       FROM d, n WHERE len(w) >= n.n),
h AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM h) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def _op9_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
    def clause(r: quality_rules.Rule) -> str:
        value = r.value.replace(" / ", "::DOUBLE / ")
        tests = [f"({value}) >= {r.low}"] * (r.low is not None) + [f"({value}) <= {r.high}"] * (r.high is not None)
        ok = "(" + " AND ".join(tests) + (f" OR n_words < {r.from_words}" if r.from_words else "") + (
            f" OR NOT ({r.only_if})" if r.only_if else "") + ")"
        return f"coalesce({ok}, true)"
    base = " AND ".join(map(clause, quality_rules.BASE_RULES))
    rest = " AND ".join(map(clause, quality_rules.RULES))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS s,
             unnest([array_to_string(w[i:i+7], ' ') FOR i IN range(1, len(w) - 6)]) AS win FROM w WHERE len(w) >= 8),
r AS (SELECT doc_id, s FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM r) GROUP BY 1),
q AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stop}) AND x <> upper(x)))::BIGINT AS n_stop_words,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]')))::BIGINT AS n_latin_words,
             len(list_filter(w, lambda x: x LIKE '%!!'))::BIGINT AS n_shouts
      FROM w LEFT JOIN c USING (doc_id)),
v AS (SELECT *, NOT ({base}) AS base_failed, {rest} AS good FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND good AS kept FROM v
"""


ORACLE = {"op4_line_dedup": OP4_SQL, "op7_decontamination": OP7_SQL, "op9_quality_rules": _op9_sql()}
