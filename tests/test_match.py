"""Fuzzy matching: the documented examples and the cutoff."""

import random

import pytest

from shelfmark.functions.similarity import jaro_winkler
from shelfmark.operators import match

GAZ = ["Bloomsbury Publishing", "HarperCollins", "Random House", "Elsevier", "Crown Publishing Group",
       "Penguin Books", "Simon & Schuster", "Scholastic", "Hachette Book Group"]
RAW = ["Bloomsbury,", "Crowell ; HarperCollins,", "Knopf : distributed by Random House,",
       "American Elsevier Pub. Co.", "Totally Unknown Press", None]


def test_name_map_examples(spark):
    g = spark.createDataFrame([(x,) for x in GAZ], "publisher string")
    r = spark.createDataFrame([(x,) for x in RAW], "publisher string")
    got = {row.publisher: row.official_publisher for row in match.build_name_map(r, "publisher", g, "publisher")
           .collect()}
    assert got == {"Bloomsbury,": "Bloomsbury Publishing", "Crowell ; HarperCollins,": "HarperCollins",
                   "Knopf : distributed by Random House,": "Random House",
                   "American Elsevier Pub. Co.": "Elsevier"}


def test_candidates_are_top_k(spark):
    g = spark.createDataFrame([(f"press number {i}",) for i in range(30)], "publisher string")
    r = spark.createDataFrame([("press number 7",)], "publisher string")
    cand = match.match_candidates(r, g, "publisher", "publisher", k=10).collect()
    assert len(cand) == 10
    assert sorted(c.rank for c in cand) == list(range(1, 11))
    assert [c.official for c in cand if c.rank == 1] == ["press number 7"]


def _brute_candidates(names, official, k):
    from math import log

    def toks(x):
        out = []
        for t in "".join(c if c.isalnum() or c == "_" else " " for c in x.lower()).split():
            if len(t) > 3 and t.endswith("s") and not t.endswith("ss"):
                t = t[:-3] + "y" if len(t) > 4 and t.endswith("ies") else t[:-1]
            out.append(t)
        return set(out)

    off = {o: toks(o) for o in set(official) if o is not None}
    df = {}
    for t in (t for s in off.values() for t in s):
        df[t] = df.get(t, 0) + 1
    out = set()
    for n in set(names) - {None}:
        scores = [(-round(sum(log(1 + len(off) / df[t]) for t in sorted(s & toks(n))), 9), o)
                  for o, s in off.items() if s & toks(n)]
        out |= {(n, o, r, rank) for rank, (r, o) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("rare", [0, 2, 12, 1000])
def test_candidates_are_exact_for_every_split(spark, rare):
    rng = random.Random(3)
    common, rest = ["press", "books", "and", "house"], [f"word{i}" for i in range(25)]
    def name():
        words = [w for w in common if rng.random() < 0.5] + rng.sample(rest, rng.choice([0, 0, 1, 2]))
        rng.shuffle(words)
        return " ".join(words) or "unknown"
    official, names = [name() for _ in range(120)] + [None], [name() for _ in range(80)] + [None, "", "zzz", "press"]
    g, r = (spark.createDataFrame([(x,) for x in xs], "p string") for xs in (official, names))
    got = match.match_candidates(r, g, "p", "p", k=4, rare_names=rare).collect()
    want = _brute_candidates(names, official, 4)
    assert {(c["name"], c.official, c["rank"]) for c in got} == {(n, o, k) for n, o, _, k in want}
    score = {(n, o): -r for n, o, r, _ in want}
    assert all(abs(c.relevance - score[c["name"], c.official]) < 2e-9 for c in got)


def test_candidates_of_empty_tables(spark):
    full, none = spark.createDataFrame([("press",)], "p string"), spark.createDataFrame([], "p string")
    assert match.match_candidates(none, full, "p", "p").count() == 0
    assert match.match_candidates(full, none, "p", "p").count() == 0


def test_cutoff_is_inclusive(spark):
    from shelfmark.functions.similarity import best_ratio

    df = spark.createDataFrame([("ed plate", "red plate", 0.0, 1)],
                               "name string, official string, relevance double, rank int")
    s = df.select(best_ratio("name", "official").alias("s")).first().s
    assert s == 89
    assert match.best_match(df, 89).count() == 1 and match.best_match(df, 90).count() == 0


def test_jaro_winkler_matches_duckdb(spark):
    import duckdb

    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abcdé 😀") for _ in range(rng.randint(0, 12)))
    pairs = [("martha", "marhta"), ("", "abc"), ("abc", "abc"), ("", ""), (None, "a"), ("dixon", "dicksonx"), ("a", "b")]
    pairs += [(text().encode("ascii", "ignore").decode(), text().encode("ascii", "ignore").decode()) for _ in range(200)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", jaro_winkler("a", "b").alias("s")).collect()
    con = duckdb.connect()
    for r in got:
        if r.a is None:
            assert r.s is None
            continue
        want = 1.0 if r.a == r.b else con.execute("SELECT jaro_winkler_similarity(?, ?)", [r.a, r.b]).fetchone()[0]
        assert abs(r.s - want) < 1e-9, (r.a, r.b)


def test_duplicate_clusters_no_pairs(spark):
    from shelfmark.functions.text import normalize_text
    df = spark.createDataFrame([("Schocken Books,",), ("Schocken books",), ("Knopf",), ("Knopf",)], "p string")
    out = {r.name: r for r in match.duplicate_clusters(df, "p", normalize_text("p")).collect()}
    assert out["Schocken Books,"].cluster_names == 2 and out["Knopf"].name_rows == 2
    assert abs(out["Knopf"].tf_weight - 1.0) < 1e-9
    assert out["Knopf"].similarity == 100 and abs(out["Knopf"].match_weight - 1.0) < 1e-9
    # one comma and one capital letter of 15 places differ from the representative (ties: the smaller name)
    assert out["Schocken books"].representative == "Schocken Books," and out["Schocken books"].similarity == 87
    assert abs(out["Schocken books"].match_weight - 0.87) < 1e-9
    assert match.duplicate_clusters(df.limit(0), "p", normalize_text("p")).count() == 0
