"""Queries of operators 11 and 13, the latter with SQL (there is no crc32 for the former)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import ranked_search, spelling
from shelfmark.llm.frames import documents


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir)))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.index(documents(spark, sf_dir))
    out = ranked_search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP13_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS nd, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY 1, 2),
w AS (SELECT term, floor(1000.0 * ln((2.0 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, nd),
m AS (SELECT r, doc_id, 25 + (75 * len(t) * nd) // l AS m FROM d, s),
q AS (SELECT b, item_id, term, count(*) AS times
      FROM (SELECT row_number() OVER () AS b, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY 1, 2, 3),
a AS (SELECT b, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY 1, 2, 3, 4)
SELECT item_id, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id, r)::INTEGER AS rank, doc_id, score
FROM a WHERE score > 0 QUALIFY rank <= 10
"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants, "op13_ranked_search": op13_ranked_search}
ORACLE = {"op13_ranked_search": OP13_SQL}
