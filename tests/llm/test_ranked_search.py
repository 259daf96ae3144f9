"""Operator 13 against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from shelfmark.llm import ranked_search
from tests.llm.conftest import WORDS, passage

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    """Sorted (item, rank, doc, score) of every item row."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for (doc, bag), n in zip(bags, sizes):
            score = 0
            for t, times in asked.items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * n * n_docs // total
                    score += times * w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def got(index, items, **options):
    return sorted(map(tuple, ranked_search.search(index, items, **options).select("item_id", "rank", "doc", "score").collect()), key=str)


ITEMS = [(1, "amber12 river3 stone4 Amber12"), (2, None), (3, ""), (4, "nosuchword"), (5, "one two"), (6, "ONE!two-été"),
         (7, passage(2, 12)), (8, " ".join(w + "1" for w in WORDS)), (8, "one"), (None, "shared line"), (9, "common " * 40 + "rare5")]


@pytest.mark.parametrize("budget,growth,k", [(1, 2, 3), (40, 3, 10), (4096, 8, 10)])
def test_same_as_scoring_every_document(spark, awkward, monkeypatch, budget, growth, k):
    monkeypatch.setattr(ranked_search, "GROWTH", growth)
    rng = random.Random(3)
    more = [(1000 + n, "common " * rng.randint(1, 4) + " ".join(rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 30)))
             + f" rare{rng.randint(0, 20)}") for n in range(150)]
    more += [(2000 + n, "common one two") for n in range(30)]  # ties beyond the k-th place
    docs = awkward.select("doc_id", "text", "score", "key").unionByName(
        spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True).repartition(5)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, rank string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(ranked_search.index(docs), items, budget=budget, k=k) == brute(rows, ITEMS, k)


def test_early_close_reads_less(spark, monkeypatch):
    """A query with one telling word closes before the lists of its common words are read to the end."""
    docs = [(n, "common words everywhere " * 3 + ("telling" if n < 20 else "")) for n in range(400)]
    read = []
    one = ranked_search._round

    def watched(*args):
        after, seen = one(*args)
        read.append((after.where("_closed").count(), seen.count()))
        return after, seen
    monkeypatch.setattr(ranked_search, "_round", watched)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "telling common words")], "item_id bigint, text string")
    out = got(ranked_search.index(frame), items, budget=16)
    assert out == brute(docs, [(1, "telling common words")], 10)
    assert read == [(1, 20)]


def test_empty_tables_and_text_ids(spark, nothing):
    items = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert got(ranked_search.index(nothing), items) == []
    docs = spark.createDataFrame([("b", "one"), ("a", "one"), ("c", "two")], "doc_id string, text string")
    index = ranked_search.index(docs)
    assert [r[2] for r in got(index, items)] == ["a", "b"]
    assert got(index, items.where("false")) == []
