"""Probabilistic dedupe of one name column (M4): match weights learned by
expectation-maximisation, links between differently spelt names, clusters.

1. Names are counted, and their comparison keys are what is compared.
2. Candidates: in each of several orders of the keys (``ORDERS``) a key is paired with its next
   ``window`` neighbours, by equal positions; so there are at most orders x window pairs a
   key, whatever the keys have in common.
3. A pair's comparisons are agreement levels.  Pairs are counted per pattern of levels, and the fit works
   on those counts (at most the product of the numbers of levels).  It learns the share of matches and, for
   matches and for other candidates, the chances of every level: neighbours that are no match often share a beginning,
   so chances from pairs at random would call them matches.
4. A pair's weight is log2 of prior odds times likelihood ratios.  Pairs with equal words are adjusted by the
   frequency of their rarest word: agreeing on a common one says less.
5. Pairs of at least ``probability`` are links, and their components are the clusters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.similarity import edit_ratio, tokens
from shelfmark.operators.keys import dense_ids
from shelfmark.session import stored

WINDOW = 5
ROUNDS = 15
PRIOR = 0.1
START = 4.0
PROBABILITY = 0.9
HALF = 0.5  # added to every count of a level


@dataclass(frozen=True)
class Comparison:
    """``level`` of two keys is 0 (nothing in common) to ``levels`` - 1."""
    name: str
    levels: int
    level: Callable[[Column, Column], Column]


def _graded(value: Column, bounds: Sequence[int]) -> Column:
    out = F.lit(0)
    for bound in bounds:
        out = out + (value >= bound).cast("int")
    return out


def _words(key: Column) -> Column:
    return F.array_distinct(tokens(key))


def _word_level(a: Column, b: Column) -> Column:
    """What is left without the shared words: nothing (3), or how alike it is."""
    left = lambda x, y: F.array_join(F.array_sort(F.array_except(_words(x), _words(y))), " ")
    mine, theirs = left(a, b), left(b, a)
    return F.when((mine == "") & (theirs == ""), len(REST_BOUNDS) + 1).otherwise(_graded(edit_ratio(mine, theirs), REST_BOUNDS))


REST_BOUNDS = (55, 78)
RATIO_BOUNDS = (80, 90, 95)
COMPARISONS = (
    Comparison("ratio", len(RATIO_BOUNDS) + 1, lambda a, b: _graded(edit_ratio(a, b), RATIO_BOUNDS)),
    Comparison("words", len(REST_BOUNDS) + 2, _word_level),
    Comparison("start", 2, lambda a, b: (F.get(tokens(a), 0) == F.get(tokens(b), 0)).cast("int")),
)
#: Orders in which spellings of one name stand near each other: by its beginning, its end, its words.
ORDERS: tuple[Callable[[Column], Column], ...] = (
    lambda k: k, lambda k: F.reverse(k), lambda k: F.array_join(F.array_sort(tokens(k)), " "))


def neighbours(keys: DataFrame, order: Column, window: int) -> DataFrame:
    """(a, b), a < b: every key with the ``window`` keys after it in ``order``."""
    placed = dense_ids(keys.select("key", order.alias("_o")), ["_o", "key"], "place").select("key", "place")
    ahead = placed.select(F.col("key").alias("_x"), F.explode(F.sequence(F.col("place") + 1, F.col("place") + window)).alias("place"))
    pairs = ahead.join(placed, "place")
    return pairs.select(F.least("_x", "key").alias("a"), F.greatest("_x", "key").alias("b"))


def compared(pairs: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    return pairs.select("a", "b", *[F.coalesce(c.level(F.col("a"), F.col("b")), F.lit(0)).alias(c.name) for c in comparisons])


def _patterns(levels: DataFrame, comparisons: Sequence[Comparison]) -> dict[tuple[int, ...], int]:
    names = [c.name for c in comparisons]
    return {tuple(r[c] for c in names): r["n"] for r in levels.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()}


@dataclass(frozen=True)
class Weights:
    prior: float
    match: tuple[tuple[float, ...], ...]    # per comparison and level: chance among matches
    other: tuple[tuple[float, ...], ...]    # among the other candidates

    def of(self, pattern: Sequence[int]) -> float:
        """log2 odds of a match."""
        return math.log2(self.prior / (1 - self.prior)) + sum(
            math.log2(m[k] / u[k]) for k, m, u in zip(pattern, self.match, self.other))


def fit(patterns: dict[tuple[int, ...], int], levels: Sequence[int], rounds: int = ROUNDS) -> Weights:
    """Expectation-maximisation over pattern counts.  It starts from other pairs that agree as the candidates
    do, and from matches of which each level is START times as likely as the one below."""
    def shares(weight: dict[tuple[int, ...], float]) -> tuple[tuple[float, ...], ...]:
        total = sum(weight.values())
        return tuple(tuple((sum(w for p, w in weight.items() if p[k] == x) + HALF) / (total + HALF * n) for x in range(n))
                     for k, n in enumerate(levels))

    match = tuple(tuple(START**x * (START - 1) / (START**n - 1) for x in range(n)) for n in levels)
    prior, other, total = PRIOR, shares(patterns), sum(patterns.values())
    for _ in range(rounds if total else 0):
        odds = {p: 2.0 ** Weights(prior, match, other).of(p) for p in patterns}
        expected = {p: n * odds[p] / (1 + odds[p]) for p, n in patterns.items()}
        prior = (sum(expected.values()) + HALF) / (total + 2 * HALF)
        match, other = shares(expected), shares({p: n - expected[p] for p, n in patterns.items()})
    return Weights(prior, match, other)


def weighted(levels: DataFrame, weights: Weights, comparisons: Sequence[Comparison]) -> DataFrame:
    """``levels`` plus ``weight``, not yet adjusted."""
    out = F.lit(math.log2(weights.prior / (1 - weights.prior)))
    for c, m, u in zip(comparisons, weights.match, weights.other):
        per_level = F.array(*[F.lit(math.log2(a / b)) for a, b in zip(m, u)])
        out = out + F.get(per_level, F.col(c.name))
    return levels.withColumn("weight", out)


def _adjusted(scored: DataFrame, keys: DataFrame, weights: Weights, comparisons: Sequence[Comparison], on: str) -> DataFrame:
    """Pairs at the top level of ``on`` agree on all words: the chance of that is replaced by the
    share of keys that hold the rarest of them."""
    n_keys = keys.count()
    words = stored(keys.select("key", F.explode(_words(F.col("key"))).alias("word")), "key-words")
    share = words.groupBy("word").agg((F.count(F.lit(1)) / F.lit(float(max(n_keys, 1)))).alias("share"))
    rarest = words.join(share, "word").groupBy(F.col("key").alias("a")).agg(F.min("share").alias("rarest"))
    k = [c.name for c in comparisons].index(on)
    top = comparisons[k].levels - 1
    agree = F.col(on) == top
    return (scored.join(rarest, "a", "left")
            .withColumn("weight", F.col("weight") + F.when(agree & F.col("rarest").isNotNull(), F.log2(F.lit(weights.other[k][top]) / F.col("rarest")))
                        .otherwise(0.0)).drop("rarest"))


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every node's component, by smallest neighbour and pointer
    doubling.  Every round is a written table."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        seen = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        # the smallest root next to a component's node becomes the root of that component's root, too
        lower = roots.join(seen, "node").select(F.explode(F.array("node", "root")).alias("node"), F.least("near", "root").alias("low"))
        lower = lower.groupBy("node").agg(F.min("low").alias("low"))
        step = stored(roots.join(lower, "node", "left").select("node", F.least("root", F.coalesce("low", "root")).alias("root")), "roots")
        onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = stored(step.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        if not step.join(roots.withColumnRenamed("root", "before"), "node").where("root <> before").limit(1).count():
            return step
        roots = step


def linked_clusters(df: DataFrame, name_col: str, key: Column, window: int = WINDOW, rounds: int = ROUNDS,
                    probability: float = PROBABILITY, comparisons: Sequence[Comparison] = COMPARISONS,
                    orders: Sequence[Callable[[Column], Column]] = ORDERS, words: str = "words") -> DataFrame:
    """One row per name: name, key, cluster (its smallest key), name_rows, cluster_rows, cluster_names, cluster_keys,
    representative (the most frequent name, ties by name), similarity (edit ratio to it) and match_weight (of the
    key's strongest link; NULL without one).  Names without a key are left out."""
    keyed = df.select(F.col(name_col).alias("name"), key.alias("key")).where(F.col("key").isNotNull() & F.col("name").isNotNull())
    names = stored(keyed.groupBy("name", "key").agg(F.count(F.lit(1)).alias("name_rows")), "names")
    keys = stored(names.select("key").distinct(), "name-keys")
    pairs = None
    for order in orders:
        more = neighbours(keys, order(F.col("key")), window)
        pairs = more if pairs is None else pairs.unionByName(more)
    levels = stored(compared(pairs.distinct(), comparisons), "compared")
    weights = fit(_patterns(levels, comparisons), [c.levels for c in comparisons], rounds)
    scored = _adjusted(weighted(levels, weights, comparisons), keys, weights, comparisons, words)
    links = stored(scored.where(F.col("weight") >= math.log2(probability / (1 - probability))).select("a", "b", "weight"), "name-links")
    roots = connected(links)
    best = links.select(F.explode(F.array("a", "b")).alias("key"), "weight").groupBy("key").agg(F.round(F.max("weight"), 6).alias("match_weight"))
    placed = (names.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("cluster", F.coalesce("root", "key")).drop("root")
              .join(best, "key", "left"))
    placed = stored(placed, "clustered")
    sizes = placed.groupBy("cluster").agg(
        F.sum("name_rows").alias("cluster_rows"), F.count(F.lit(1)).alias("cluster_names"), F.count_distinct("key").alias("cluster_keys"),
        F.min(F.struct((-F.col("name_rows")).alias("rows"), "name"))["name"].alias("representative"))
    return placed.join(sizes, "cluster").select(
        "name", "key", "cluster", "name_rows", "cluster_rows", "cluster_names", "cluster_keys", "representative",
        edit_ratio("name", "representative").alias("similarity"), "match_weight")
