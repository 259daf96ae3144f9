"""Fuzzy entity matching of dirty names to an official list (M0-M4).

The original job sent every dirty name to a search service (top 10 by text
relevance, English stemming) and kept the best fuzzy score >= 89.  Here the
search is a token join:

1. both sides are preprocessed, tokenised and lightly stemmed;
2. every official token gets an IDF weight; dirty names are reduced to
   their distinct sets of known tokens;
3. the rare tokens of a set join the index, the common ones are looked at only in
   the candidates found and in the best officials of the common part alone, which
   is exact (see ``match_candidates``); the top ``k`` by summed weight are kept;
4. the best candidate by edit-based ratio wins if it reaches the cutoff.

No step emits all pairs of a group: a token set meets at most ``RARE_NAMES``
official names per rare token, and a token that is common to both lists is joined once per
distinct common part, not once per name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.functions.similarity import best_ratio, edit_ratio, preprocess, tokens
from shelfmark.functions.util import as_col
from shelfmark.operators.rank import top_k_per_group
from shelfmark.session import stored

# Fixed values of the original matcher.
CANDIDATES = 10      # hits fetched per name
MATCH_CUTOFF = 89    # minimum score (inclusive) on a 0..100 scale

RARE_NAMES = 1000    # a token in more official names than this is common
SLACK = 1e-6         # far above the rounding of summed weights


def stem(t) -> Column:
    """Light English suffix stemming: ``-ies`` -> ``-y``; a final ``s`` is
    dropped unless the word ends in ``ss`` or is at most three letters."""
    t = as_col(t)
    return (F.when((F.length(t) > 4) & t.endswith("ies"), F.concat(F.regexp_replace(t, "ies$", ""), F.lit("y")))
             .when((F.length(t) > 3) & t.endswith("s") & ~t.endswith("ss"), F.regexp_replace(t, "s$", ""))
             .otherwise(t))


def stemmed_tokens(name) -> Column:
    return F.array_distinct(F.transform(tokens(preprocess(name)), stem))


def name_tokens(df: DataFrame, name_col: str, out: str = "token") -> DataFrame:
    """(name, stemmed token) rows, one per distinct token of the name."""
    return df.select(F.col(name_col), F.explode(stemmed_tokens(name_col)).alias(out))


def official_tokens(gazetteer: DataFrame, name_col: str) -> DataFrame:
    """(official, toks): the distinct non-NULL official names, materialised once for all later readers."""
    g = gazetteer.select(F.col(name_col).alias("official")).filter(F.col("official").isNotNull()).distinct()
    return stored(g.select("official", stemmed_tokens("official").alias("toks")), "official-names")


def token_weights(officials: DataFrame) -> DataFrame:
    """(token, df, idf) with idf = ln(1 + N / df(token))."""
    n = officials.count()
    df_ = officials.select(F.explode("toks").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return df_.withColumn("idf", F.log(F.lit(1.0) + F.lit(float(n)) / F.col("df")))


def _shared_weight(tokens_: Column, toks: Column) -> Column:
    """Summed idf of the tokens that ``toks`` holds, in token order."""
    shared = F.filter(tokens_, lambda t: F.array_contains(toks, t["token"]))
    return F.round(F.aggregate(shared, F.lit(0.0), lambda a, t: a + t["idf"]), 9)


def _key(tokens_: Column) -> Column:
    """A token set as text; tokens hold no blanks."""
    return F.array_join(F.transform(tokens_, lambda t: t["token"]), " ")


def _tail_fillers(queries: DataFrame, common: DataFrame, k: int) -> DataFrame:
    """(q, official): the ``k`` best official names of every set's tail, found once per distinct tail."""
    tails = queries.where(F.size("tail") > 0)
    sums = (tails.select("tail_key", "tail").distinct().select("tail_key", F.explode("tail").alias("t"))
            .select("tail_key", F.col("t.token").alias("token")).join(common, "token")
            .groupBy("tail_key", "official").agg(F.round(F.sum("idf"), 9).alias("weight")))
    first = top_k_per_group(sums, ["tail_key"], [F.col("weight").desc(), F.col("official").asc()], k)
    return tails.select("q", "tail_key").join(first.select("tail_key", "official"), "tail_key").select("q", "official")


def match_candidates(names: DataFrame, gazetteer: DataFrame, name_col: str, gazetteer_col: str,
                     k: int = CANDIDATES, rare_names: int = RARE_NAMES) -> DataFrame:
    """M1. Top ``k`` official names per dirty name by summed IDF of shared
    stemmed tokens (ties by official name): (name, official, relevance, rank).

    Names with the same known tokens have the same candidates, so the search
    runs once per distinct token set.  Of a set, the tokens in at most
    ``rare_names`` official names are joined with the index; the common rest (its
    tail) is not.  An official name that shares only the tail cannot
    enter the top ``k`` unless it is among the first ``k`` of the tail alone: those
    ahead of it there have at least its score and win its ties.  So the
    candidates are the rare partners plus the ``k`` best of the tail, found
    once per distinct tail; a partner also goes if its rare weight plus the whole
    tail stays below the k-th best rare weight.  The result is exact for every ``rare_names``."""
    officials = official_tokens(gazetteer, gazetteer_col)
    weights = stored(token_weights(officials), "token-weights")
    index = officials.select("official", F.explode("toks").alias("token")).join(weights, "token")
    dirty = name_tokens(names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct(), "name")
    known = stored(
        dirty.join(weights, "token").groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct("token", "idf", "df"))).alias("set"))
        .withColumn("q", _key(F.col("set"))), "known-tokens")
    tail = F.filter("set", lambda t: t["df"] > rare_names)
    queries = (known.select("q", "set").distinct()
               .withColumn("tail", tail).withColumn("tail_key", _key(F.col("tail")))
               .withColumn("tail_weight", F.aggregate("tail", F.lit(0.0), lambda a, t: a + t["idf"])))

    rare = (queries.select("q", "tail_weight", F.explode("set").alias("t"))
            .where(F.col("t.df") <= rare_names).select("q", "tail_weight", F.col("t.token").alias("token"))
            .join(index.where(F.col("df") <= rare_names), "token")
            .groupBy("q", "official").agg(F.sum("idf").alias("part"), F.first("tail_weight").alias("tail_weight")))
    # a window holds one token set's partners: at most its rare tokens times rare_names
    by_part = (W.partitionBy("q").orderBy(F.desc("part"))
               .rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    bar = F.coalesce(F.nth_value("part", k).over(by_part), F.lit(0.0))
    partners = (rare.withColumn("bar", bar).where(F.col("part") + F.col("tail_weight") >= F.col("bar") - SLACK)
                .select("q", "official"))

    if (weights.agg(F.max("df")).first()[0] or 0) > rare_names:  # otherwise no set has a tail
        partners = partners.unionByName(_tail_fillers(queries, index.where(F.col("df") > rare_names), k)).distinct()
    scored = (partners.join(queries.select("q", "set"), "q").join(officials, "official")
              .select("q", "official", _shared_weight(F.col("set"), F.col("toks")).alias("relevance")))
    best = (top_k_per_group(scored, ["q"], [F.col("relevance").desc(), F.col("official").asc()], k)
            .groupBy("q").agg(F.collect_list(F.struct("official", "relevance", "rank")).alias("hits")))
    return known.select("name", "q").join(best, "q").select("name", F.inline("hits"))


def best_match(candidates: DataFrame, cutoff: int = MATCH_CUTOFF) -> DataFrame:
    """M2. Best candidate per name by fuzzy score, kept if score >= cutoff
    (ties: higher relevance, then official name).  An aggregate of
    ``max(struct(score, relevance, -rank))``: combines map-side."""
    scored = candidates.withColumn("score", best_ratio("name", "official"))
    best = scored.groupBy("name").agg(
        F.max(F.struct(F.col("score"), F.col("relevance"), (-F.col("rank")).alias("neg_rank"),
                       F.col("official"))).alias("b"))
    return (best.select("name", F.col("b.official").alias("official"), F.col("b.score").alias("score"))
                .filter(F.col("score") >= cutoff))


def build_name_map(raw: DataFrame, raw_col: str, gazetteer: DataFrame, gazetteer_col: str,
                   k: int = CANDIDATES, cutoff: int = MATCH_CUTOFF) -> DataFrame:
    """M3. (raw name, official name) for every distinct non-NULL raw name
    with an accepted match."""
    names = raw.select(F.col(raw_col).alias("_n")).filter(F.col("_n").isNotNull()).distinct()
    cand = match_candidates(names, gazetteer, "_n", gazetteer_col, k)
    best = best_match(cand, cutoff)
    return best.select(F.col("name").alias("publisher"), F.col("official").alias("official_publisher"))


def duplicate_clusters(df: DataFrame, name_col: str, key: Column) -> DataFrame:
    """M4 (re-aimed). Dedupe on one column with term-frequency adjustment,
    reported per name instead of per pair: names sharing a comparison key form
    a cluster, represented by its most frequent name (ties by name);
    ``tf_weight`` = -log2(cluster rows / all rows) is the weight of agreeing on a key so rare,
    ``similarity`` (0..100) the edit ratio of a name to the representative, and
    ``match_weight`` their product.  No pairs are emitted; rows are counted
    per name before anything is grouped by key."""
    keyed = df.select(F.col(name_col).alias("name"), key.alias("key")).filter(F.col("key").isNotNull())
    names = keyed.groupBy("name", "key").agg(F.count(F.lit(1)).alias("name_rows"))
    total = names.agg(F.sum("name_rows")).first()[0] or 0
    sizes = names.groupBy("key").agg(
        F.sum("name_rows").alias("cluster_rows"), F.count(F.lit(1)).alias("cluster_names"),
        F.min(F.struct((-F.col("name_rows")).alias("rows"), "name"))["name"].alias("representative"))
    tf = -F.log2(F.col("cluster_rows") / F.lit(float(total)))
    similarity = edit_ratio("name", "representative")
    return names.join(sizes, "key").select(
        "name", "key", "name_rows", "cluster_rows", "cluster_names", "representative", similarity.alias("similarity"),
        F.round(tf, 6).alias("tf_weight"), F.round(tf * similarity / 100, 6).alias("match_weight"))
