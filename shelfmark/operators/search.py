"""Ranked name search (M1): BM25 over English stems, exact top ``k`` per name.

A posting's score is fixed when the index is built, in millionths (so sums are exact and
ties are ties).  Of the words of a query, those in at most ``rare_names`` names join the index.
The common rest, the query's tail, joins it once per distinct tail, for that tail's own ``k`` best names.
Every word's largest score bounds what it can add, so a partner whose rare score plus the tail's bound
stays below the ``k``-th best rare score goes before its score is completed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.functions.english import with_stems, words_of
from shelfmark.operators.match import CANDIDATES, RARE_NAMES
from shelfmark.operators.rank import top_k_per_group
from shelfmark.session import stored

# Fixed values of the ranking function.
K1, B = 1.2, 0.75
SCALE = 1_000_000


def stemmed_words(names: DataFrame, name_col: str) -> DataFrame:
    """Written: (name, token, times, length) of the distinct non-NULL names that have words."""
    words = names.select(F.col(name_col).alias("name")).where(F.col(name_col).isNotNull()).distinct().select("name", words_of("name").alias("_w"))
    rows = words.select("name", F.size("_w").alias("length"), F.explode("_w").alias("word")).groupBy("name", "length", "word").agg(F.count("*").alias("n"))
    rows = stored(rows, "name-words")
    stems = with_stems(rows.select("word").distinct(), "word", "token")  # a word once
    return stored(rows.join(stems, "word").groupBy("name", "length", "token").agg(F.sum("n").alias("times")), "name-stems")


def postings(gazetteer: DataFrame, name_col: str) -> DataFrame:
    """Written: (official, token, df, score), the BM25 score of every word of every name."""
    rows = stemmed_words(gazetteer, name_col)
    n, mean = rows.select("name", "length").distinct().agg(F.count("*"), F.avg("length")).first()
    df = rows.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0))
    score = F.round(idf * F.col("times") * (K1 + 1) / (F.col("times") + norm) * SCALE).cast("long")
    return stored(rows.join(df, "token").select(F.col("name").alias("official"), "token", "df", score.alias("score")), "postings")


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + value(x))


def _tail_best(queries: DataFrame, common: DataFrame, k: int) -> DataFrame:
    """(q, official): the ``k`` best names of every tail, found once per distinct tail."""
    tails = queries.where(F.size("tail") > 0)
    sums = (tails.select("tail_key", "tail").distinct().select("tail_key", F.explode("tail").alias("t"))
            .select("tail_key", "t.token", "t.times").join(common, "token")
            .groupBy("tail_key", "official").agg(F.sum(F.col("times") * F.col("score")).alias("sum")))
    best = top_k_per_group(sums, ["tail_key"], [F.col("sum").desc(), F.col("official").asc()], k)
    return tails.select("q", "tail_key").join(best.select("tail_key", "official"), "tail_key").select("q", "official")


def search_candidates(names: DataFrame, gazetteer: DataFrame, name_col: str, gazetteer_col: str, k: int = CANDIDATES,
                      rare_names: int = RARE_NAMES) -> DataFrame:
    """The ``k`` official names of highest BM25 score per name (ties by official name):
    (name, official, relevance in millionths, rank).  Exact for every ``rare_names``."""
    index = postings(gazetteer, gazetteer_col)
    bounds = stored(index.groupBy("token", "df").agg(F.max("score").alias("most")), "word-bounds")
    known = (stemmed_words(names, name_col).join(bounds, "token")
             .groupBy("name").agg(F.array_sort(F.collect_list(F.struct("token", "times", "df", "most"))).alias("set")))
    key = lambda items: F.array_join(F.transform(items, lambda t: F.concat_ws("*", t["token"], t["times"])), " ")
    known = stored(known.withColumn("q", key(F.col("set"))), "query-words")
    tail = F.filter("set", lambda t: t["df"] > rare_names)
    queries = (known.select("q", "set").distinct().withColumn("tail", tail).withColumn("tail_key", key(F.col("tail")))
               .withColumn("tail_most", _sum(F.col("tail"), lambda t: t["times"] * t["most"])))
    rare = (queries.select("q", "tail_most", F.explode("set").alias("t")).where(F.col("t.df") <= rare_names)
            .select("q", "tail_most", "t.token", "t.times").join(index.where(F.col("df") <= rare_names).select("token", "official", "score"), "token")
            .groupBy("q", "official", "tail_most").agg(F.sum(F.col("times") * F.col("score")).alias("part")))
    # a window holds one query's partners: at most its rare words times rare_names
    by_part = W.partitionBy("q").orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bar = F.coalesce(F.nth_value("part", k).over(by_part), F.lit(0))
    partners = rare.withColumn("bar", bar).where(F.col("part") + F.col("tail_most") >= F.col("bar")).select("q", "official")
    partners = partners.unionByName(_tail_best(queries, index.where(F.col("df") > rare_names), k)).distinct()
    scores = index.groupBy("official").agg(F.map_from_entries(F.collect_list(F.struct("token", "score"))).alias("scores"))
    relevance = _sum(F.col("set"), lambda t: t["times"] * F.coalesce(F.try_element_at("scores", t["token"]), F.lit(0)))
    scored = (partners.join(queries.select("q", "set"), "q").join(scores, "official").select("q", "official", relevance.alias("relevance")))
    best = (top_k_per_group(scored, ["q"], [F.col("relevance").desc(), F.col("official").asc()], k)
            .groupBy("q").agg(F.collect_list(F.struct("official", "relevance", "rank")).alias("hits")))
    return known.select("name", "q").join(best, "q").select("name", F.inline("hits"))
