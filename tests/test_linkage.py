"""Learned match weights against a brute-force fit over pairs; clusters against union-find."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.text import normalize_text
from shelfmark.operators import linkage

WORDS = "harbor meadow copper lantern willow orchard thunder velvet pebble amber stone river".split()


def spelt(rng, n):
    named = {}
    for k in range(n):
        base = f"{WORDS[k % 12]} {''.join(rng.choice('abcdefghijklmnop') for _ in range(8))} press"
        named[k] = {base}
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(base))
            named[k].add(rng.choice([base[:at] + base[at + 1:], base.upper() + ",", base.replace(" press", " presss")]))
    return list(named.values())


@pytest.fixture(scope="module")
def names():
    return spelt(random.Random(9), 60)


def test_weights_equal_a_fit_over_pairs():
    """The same rounds with one term per pair instead of per pattern."""
    rng = random.Random(2)
    levels = (3, 2)
    pairs = [(rng.choice([0, 0, 1, 2]), rng.choice([0, 0, 1])) for _ in range(300)] + [(2, 1)] * 60
    got = linkage.fit({p: pairs.count(p) for p in set(pairs)}, levels, rounds=25)

    def share(weights, k):
        return [(sum(w for p, w in weights if p[k] == x) + 0.5) / (sum(w for _, w in weights) + 0.5 * levels[k]) for x in range(levels[k])]
    u = [share([(p, 1) for p in pairs], k) for k in (0, 1)]
    m, prior = [[4**x * 3 / (4**n - 1) for x in range(n)] for n in levels], 0.1
    for _ in range(25):
        post = []
        for p in pairs:
            yes = prior * m[0][p[0]] * m[1][p[1]]
            no = (1 - prior) * u[0][p[0]] * u[1][p[1]]
            post.append((p, yes / (yes + no)))
        prior = (sum(w for _, w in post) + 0.5) / (len(pairs) + 1)
        m, u = [share(post, k) for k in (0, 1)], [share([(p, 1 - w) for p, w in post], k) for k in (0, 1)]
    assert abs(got.prior - prior) < 1e-9
    for a, b in zip([*got.match, *got.other], [*m, *u]):
        assert all(abs(x - y) < 1e-9 for x, y in zip(a, b))
    assert got.of((2, 1)) > 0 > got.of((0, 0))


def test_neighbours_are_bounded_and_complete(spark, names):
    keys = sorted({n.lower() for same in names for n in same})
    frame = spark.createDataFrame([(k,) for k in keys], "key string").repartition(7)
    got = {tuple(r) for r in linkage.neighbours(frame, F.reverse("key"), 3).collect()}
    ordered = sorted(keys, key=lambda k: k[::-1])
    assert got == {tuple(sorted((ordered[i], ordered[i + d]))) for i in range(len(ordered)) for d in (1, 2, 3) if i + d < len(ordered)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{k:03d}" for k in range(150)]
    links = [(nodes[k], nodes[k + 1]) for k in range(60)] + [tuple(rng.sample(nodes[70:], 2)) for _ in range(50)] + [(nodes[149], nodes[k]) for k in range(120, 140)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in linkage.connected(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_names_of_different_keys_are_linked(spark, names):
    of = {n: k for k, same in enumerate(names) for n in same}
    rows = [(n,) for n in of for _ in range(3 if n.islower() and n.endswith(" press") else 1)] + [(None,), ("",)]
    out = linkage.linked_clusters(spark.createDataFrame(rows, "p string"), "p", normalize_text("p"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    got = {r["name"]: r for r in out.collect()}
    assert set(got) == {*of, ""}
    together, apart, wrong = 0, 0, 0
    for a, b in itertools.combinations([n for n in got if n], 2):
        same = got[a]["cluster"] == got[b]["cluster"]
        if of[a] == of[b]:
            together, apart = together + same, apart + (not same)
        else:
            wrong += same
    assert together > 20 * apart and wrong < together / 20
    some = [r for r in got.values() if r["cluster_keys"] > 1]
    assert some and all(r["match_weight"] >= math.log2(9) - 1e-6 for r in some)
    assert all(r["cluster"] <= r["key"] for r in got.values())


def test_equal_rare_words_weigh_more(spark):
    keys = spark.createDataFrame([(f"common word{k}",) for k in range(50)] + [("common odd",), ("odd common",), ("word1 common",)], "key string")
    weights = linkage.fit({(3, 3, 1): 5, (0, 1, 0): 60, (0, 0, 0): 90}, (4, 4, 2))
    pairs = spark.createDataFrame([("common odd", "odd common"), ("common word1", "word1 common"), ("common word1", "common word2")], "a string, b string")
    levels = linkage.compared(pairs, linkage.COMPARISONS)
    plain = {r["b"]: r["weight"] for r in linkage.weighted(levels, weights, linkage.COMPARISONS).collect()}
    out = {r["b"]: r["weight"] for r in linkage._adjusted(linkage.weighted(levels, weights, linkage.COMPARISONS), keys, weights, linkage.COMPARISONS, "words").collect()}
    top = weights.other[1][3]
    assert abs(out["odd common"] - plain["odd common"] - math.log2(top / (2 / 53))) < 1e-9
    assert out["common word2"] == plain["common word2"]


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "p string")
    assert linkage.linked_clusters(none, "p", normalize_text("p")).count() == 0
    one = linkage.linked_clusters(spark.createDataFrame([("Knopf",), ("Knopf",)], "p string"), "p", normalize_text("p")).collect()
    assert [(r["name"], r["cluster"], r["name_rows"], r["match_weight"]) for r in one] == [("Knopf", "knopf", 2, None)]
