"""Operator 5 against all pairs, and the components helper against union-find."""

import random

import numpy as np
import pytest

from shelfmark.llm import byte_words as bw, near_dup
from shelfmark.llm.components import components
from tests.llm.conftest import passage

TOP = 2**63 - 1


def shingle_set(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in (text or "").translate(fold).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ")
             .replace("\r", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Component of every (id, text): the smallest id linked to it."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = [TOP if i is None else i for i, _ in rows]
    low = {}
    for k in range(len(rows)):
        low[find(k)] = min(low.get(find(k), TOP), ids[k])
    return sorted((ids[k], len(sets[k]), low[find(k)]) for k in range(len(rows)))


def got(docs):
    return sorted((r["_id"], r["_n"], r["_component"]) for r in near_dup.with_groups(docs).collect())


def family(rng, base, copies, edits):
    words = base.split()
    out = []
    for _ in range(copies):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small_group", [32, 2])
def test_same_groups_as_all_pairs(spark, awkward, monkeypatch, small_group):
    monkeypatch.setattr(near_dup, "SMALL_GROUP", small_group)  # 2: larger groups go through blocks
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = random.Random(5)
    texts = [t for k, (n, e) in enumerate([(80, 2), (300, 12), (700, 20), (1500, 30)])
             for t in family(rng, passage(50 + k, n), 14, e)]
    texts += [" ".join(t.split()[k:]) for k, t in enumerate(texts[:20])]
    more = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    docs = awkward.select("doc_id", "text").unionByName(more)
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("small_group", [32, 2])
def test_templates_are_no_near_copies(spark, monkeypatch, small_group):
    """Texts that share most of their words, some of them near copies of each other."""
    monkeypatch.setattr(near_dup, "SMALL_GROUP", small_group)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = random.Random(8)
    texts = []
    for k in range(90):
        common = passage(70, 70 if k % 2 else 95)
        own = " ".join(f"own{k}x{j}" for j in range(30 if k % 2 else 12))
        texts.append(f"{common} {own}")
        if k % 9 == 0:
            texts += family(rng, texts[-1], 2, 2)
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(docs) == brute(list(enumerate(texts)))


def test_rare_shingles_lose_no_pair(spark):
    """Any two sets at the threshold share one of the rarest shingles that are kept of each."""
    rng = random.Random(3)
    sets = {}
    for k in range(60):
        base = sets[rng.randrange(k)] if k and rng.random() < 0.6 else rng.sample(range(400), rng.randint(1, 60))
        sets[k] = sorted({x if rng.random() < 0.95 else rng.randrange(400) for x in base})
    frame = spark.createDataFrame(list(sets.items()), "_node bigint, _set array<bigint>")
    kept = {k: set() for k in sets}
    for r in near_dup._by_rare_shingles(frame.select("_node"), frame).collect():
        kept[r["_node"]].add(r["_band"])
    near = [(a, b) for a in sets for b in range(a) if 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))]
    assert near and all(kept[a] & kept[b] for a, b in near)
    assert sum(map(len, kept.values())) < 0.3 * sum(map(len, sets.values()))


def test_keep_one(awkward, nothing):
    kept = near_dup.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids.count(None) == 2 and 2 not in ids and 12 not in ids and ids.count(14) == 1
    assert {1, 4, 5, 6, 7, 8, 10, 11, 13} <= set(ids)
    assert near_dup.keep_one(nothing).count() == 0 and near_dup.near_duplicates(nothing).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    for size in (60, 3000):
        common, own = rng.integers(0, 2**63, size).astype(np.uint64), rng.integers(0, 2**63, size // 4).astype(np.uint64)
        a, b = np.sort(common), np.sort(np.concatenate([common, own]))
        truth = len(common) / len(b)
        if size >= near_dup.WIDE:
            ra, rb = near_dup._wide(a), near_dup._wide(b)
        else:
            ra, rb = near_dup._narrow(np.concatenate([a, b]), np.array([0, len(a)]))
        assert abs(near_dup.estimated(ra.tobytes(), rb.tobytes()) - truth) < 0.15


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa
    piece = next(bw.pieces(pa.array(["Ab  cd\tAB", None, "cd ab"])))
    w = bw.words(piece)
    assert list(w.counts()) == [3, 0, 2]
    assert w.hashes[0] == w.hashes[2] == w.hashes[4] and w.hashes[1] == w.hashes[3] != w.hashes[0]


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    for node in list(root):
        assert out.get(node, node) == find(node)
