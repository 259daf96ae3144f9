"""Query of operator 5, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import near_dup
from shelfmark.llm.frames import NULL_ID, documents


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dup.with_groups(documents(spark, sf_dir).select("doc_id", "text"))
    component = F.when(F.col("_component") != NULL_ID, F.col("_component"))
    return out.select("doc_id", F.col("_n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS g FROM d),
k AS (SELECT doc_id, len(g) AS n, min(doc_id) OVER (PARTITION BY g) AS rep, g FROM s),
c AS (SELECT rep, n, unnest(g) AS sh FROM k WHERE doc_id = rep AND n > 0),
p AS (SELECT x.rep AS a, y.rep AS b, count(*) AS i, any_value(x.n) AS na, any_value(y.n) AS nb
      FROM c x JOIN c y ON x.sh = y.sh AND x.rep < y.rep GROUP BY 1, 2),
e AS (SELECT a, b FROM p WHERE 100 * i >= 85 * (na + nb - i)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS lo FROM u UNION SELECT u.b, r.lo FROM r JOIN u ON r.node = u.a),
m AS (SELECT node, min(lo) AS component_id FROM r GROUP BY 1)
SELECT k.doc_id, k.n AS n_shingles,
       CASE WHEN k.n = 0 THEN k.doc_id ELSE coalesce(m.component_id, k.rep) END AS component_id,
       k.doc_id = CASE WHEN k.n = 0 THEN k.doc_id ELSE coalesce(m.component_id, k.rep) END AS kept
FROM k LEFT JOIN m ON k.rep = m.node
"""

QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLE = {"op5_near_duplicates": OP5_SQL}
