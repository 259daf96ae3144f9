"""Operator 12: bins by brute force, exact round trip of the ids."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfmark.llm import best_fit
from shelfmark.llm.queries_rows import op12_best_fit, tokenizer_path


def plain_best_fit(sizes, length, open_bins):
    closed, live = [], []
    for k, size in enumerate(sizes):
        fits = [b for b in live if sum(sizes[i] for i in b) + size <= length]
        if fits:
            target = max(fits, key=lambda b: sum(sizes[i] for i in b))
        else:
            if len(live) == open_bins:
                fullest = max(live, key=lambda b: sum(sizes[i] for i in b))
                live.remove(fullest)
                closed.append(fullest)
            target = []
            live.append(target)
        target.append(k)
        if sum(sizes[i] for i in target) == length:
            live.remove(target)
            closed.append(target)
    return closed, live


@pytest.mark.parametrize("open_bins", [1, 3, 1000])
def test_bins_fill_as_plain_best_fit(open_bins):
    rng = random.Random(open_bins)
    for _ in range(40):
        sizes = [rng.choice([rng.randint(1, 100), rng.randint(40, 60), 100]) for _ in range(rng.randint(0, 120))]
        got, want = best_fit.best_fit(sizes, 100, open_bins), plain_best_fit(sizes, 100, open_bins)
        fills = lambda bins: sorted(sum(sizes[k] for k in b) for b in bins)  # noqa: E731  bins of one size are alike
        assert fills(got[0]) == fills(want[0]) and fills(got[1]) == fills(want[1])
        assert sorted(k for part in got for b in part for k in b) == list(range(len(sizes)))
        assert len(got[1]) <= open_bins


def test_cuts():
    assert best_fit.cut(10, 10) == [(0, 10)] and best_fit.cut(1, 10) == [(0, 1)]
    assert best_fit.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert best_fit.cut(30, 10) == [(0, 10), (10, 10), (20, 10)]


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(tokenizer_path())
    return lambda t: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4")


def holds(rows, texts, ids_of, length):
    """Every id of every document in one piece; sequences without gaps; only long documents cut.  Returns the sequences' fills."""
    want = defaultdict(int)
    for doc_id, text in texts:
        ids = ids_of(text)
        for n, (start, size) in enumerate(best_fit.cut(len(ids), length)):
            want[doc_id, n, start, size, zlib.crc32(ids[start:start + size].tobytes())] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return [sum(n for _, n in parts) for parts in sequences.values()]


@pytest.mark.parametrize("group,fan,bins", [(3, 2, 2), (4096, 16, 1024)])
def test_round_trip(awkward, nothing, ids_of, monkeypatch, group, fan, bins):
    monkeypatch.setattr(best_fit, "FAN", fan)
    rows = best_fit.pack(awkward, tokenizer_path(), length=128, group=group, open_bins=bins).collect()
    holds(rows, [(r["doc_id"], r["text"]) for r in awkward.collect()], ids_of, 128)
    assert best_fit.pack(nothing, tokenizer_path()).count() == 0


def test_ids_of_any_type_and_clashing_columns(spark, ids_of):
    docs = spark.createDataFrame([("a-1", "one two", 5, "x"), (None, "three", 6, "y"), ("a-1", None, 7, "z")],
                                 "name string, body string, piece int, _row string")
    out = best_fit.pack(docs, tokenizer_path(), id_col="name", text_col="body")
    rows = [dict(r.asDict(), doc_id=r["name"]) for r in out.collect()]
    holds(rows, [("a-1", "one two"), (None, "three"), ("a-1", None)], ids_of, 2048)


def test_query_packs_tightly(spark, sf_small, ids_of):
    rows = op12_best_fit(spark, sf_small).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    fills = holds(rows, texts, ids_of, 2048)
    assert len(fills) <= 1.01 * sum(fills) / 2048 + 1
