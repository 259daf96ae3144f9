"""Operators 3, 6 and 10 against brute force."""

import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import licenses, packing, sharding
from shelfmark.llm.queries_rows import tokenizer_path
from tests.llm.conftest import WORDS, passage


# ---- sharding ----------------------------------------------------------------

def test_table_is_even_and_stable():
    names = [f"n{k}" for k in range(12)]
    table = sharding.filled_table(names, 1009)
    assert max(np.bincount(table)) - min(np.bincount(table)) <= 1
    fewer = sharding.filled_table(names[:-1], 1009)
    moved = sum(names[a] != names[b] for a, b in zip(table, fewer))
    assert moved < 1009 * (1 / 12 + 0.12)
    weighted = np.bincount(sharding.filled_table(["a", "b"], 1009, [3, 1]))
    assert abs(weighted[0] / weighted[1] - 3) < 0.05
    for bad in (dict(slots=1000), dict(shards=[]), dict(shards=["a", "a"]), dict(weights=[0] * 12)):
        with pytest.raises(ValueError):
            sharding.filled_table(**({"shards": names, "slots": 1009} | bad))


def test_turns_claim_the_next_free_preference():
    names, slots = ["a", "b", "c"], 13
    rank = {}
    for s in names:
        at, skip = sharding._number(s, "offset") % slots, sharding._number(s, "skip") % (slots - 1) + 1
        rank[s] = [(at + i * skip) % slots for i in range(slots)]
    taken = {}
    while len(taken) < slots:
        for s in names:
            if len(taken) < slots:
                taken[next(x for x in rank[s] if x not in taken)] = s
    assert [names[k] for k in sharding.filled_table(names, slots)] == [taken[i] for i in range(slots)]


def test_every_row_has_a_shard(awkward, nothing, tmp_path):
    placed = sharding.with_shard(awkward)
    assert placed.count() == awkward.count() and placed.where("_shard is null").count() == 0
    assert placed.groupBy("doc_id").agg(F.countDistinct("_shard").alias("n")).where("n > 1").count() == 0
    assert sharding.with_shard(nothing).count() == 0
    sharding.write_shards(awkward, str(tmp_path / "out"), shards=["a", "b"])
    assert awkward.sparkSession.read.parquet(str(tmp_path / "out")).count() == awkward.count()


# ---- packing -----------------------------------------------------------------

@pytest.fixture(scope="module")
def reference_ids():
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(tokenizer_path())
    return lambda t: [*coder.encode(t or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_tokenizer_files(reference_ids):
    ids_of = packing.encoder(tokenizer_path())
    for text in ["plain words, 12 3's", "Été naïve straße \U0001f600", "a<|endoftext|>b <|endoftext|>", " \t\n  x", "\x00\x7f",
                 passage(3, 400), "x" * 5000]:
        assert [*ids_of(text), 0] == reference_ids(text)


@pytest.mark.parametrize("length", [1024, 96])
def test_round_trip(awkward, reference_ids, length):
    docs = awkward.where("doc_id is null or doc_id != 14")
    pieces = packing.pack(docs, tokenizer_path(), length).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    want = {}
    for r in docs.collect():
        want.setdefault((r["doc_id"], len(reference_ids(r["text"]))), []).append(reference_ids(r["text"]))
    assert set(by_doc) == set(want)
    for key, parts in by_doc.items():
        if len(want[key]) > 1:  # two rows without id and of one length: lengths must still add up
            assert sum(p["length"] for p in parts) == key[1] * len(want[key])
            continue
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            ids = np.array(want[key][0][at:at + p["length"]], "<u4")
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids.tobytes())
            at += p["length"]
        assert at == key[1]
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == length or at < length and at & (at - 1) == 0


def test_packing_nothing(nothing):
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        order = grid[np.argsort(packing.hilbert_index(grid, bits))]
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


# ---- licences ----------------------------------------------------------------

def test_alignment_is_increasing_and_maximal_on_unique_words():
    a, b = "a x b y c z d".split(), "q a b c w d e".split()
    pairs = licenses.aligned(a, b)
    assert [a[i] for i, _ in pairs] == ["a", "b", "c", "d"]
    assert all(i < k and j < m for (i, j), (k, m) in combinations(pairs, 2))
    assert licenses.aligned(["x", "x"], ["x", "x"]) == [(0, 0), (1, 1)]
    assert licenses.aligned([], ["x"]) == []


def test_longest_increasing_run_by_brute_force():
    import random
    rng = random.Random(2)
    for _ in range(50):
        pairs = list(enumerate(rng.sample(range(9), 9)))
        best = max(k for k in range(10) if k == 0 or any(
            all(x[1] < y[1] for x, y in zip(c, c[1:])) for c in combinations(pairs, k)))
        assert len(licenses._increasing(pairs)) == best


def test_scan(spark, awkward, nothing):
    filler = passage(8, 500)
    rows = [(200 + k, f"{filler}\n{t}\n{filler}") for k, t in enumerate(licenses.NOTICES.values())]
    rows += [(300, "licensed under the apache license version 2.0"), (301, "MIT license " * 50), (302, "the license under " + filler),
             (303, f"{filler} Released under the MIT License. {filler} Released under the MIT License. {filler}")]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    out = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for k, name in enumerate(licenses.NOTICES):
        assert out[200 + k]["license"] == name and out[200 + k]["coverage"] == 1.0
    assert out[300]["license"] == "apache-2.0" and out[303]["license"] == "mit"
    assert out[301]["license"] is None and out[302]["license"] is None and out[10]["license"] is None and out[6]["coverage"] == 0
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(nothing).count() == 0


def test_windows_lose_no_notice():
    notice = licenses.words_of(licenses.NOTICES["gpl-3.0"])
    for k in range(0, 40):
        text = " ".join(WORDS[i % 12] for i in range(k)) + " " + licenses.NOTICES["gpl-3.0"] + " the end"
        found = licenses.best_match(text, {"gpl": notice})
        assert found == ("gpl", 1.0, k, len(notice))


@pytest.mark.parametrize("name", ["gpl-3.0", "gpl-3.0-header", "mit"])
def test_inserted_words_do_not_hide_a_notice(name):
    notice = licenses.words_of(licenses.NOTICES[name])
    m = len(notice)
    for before in range(0, 2 * m + 1, max(1, m // 12)):  # every way to lie in a grid of m words
        lead = [WORDS[i % 12] for i in range(before)]
        inserted = [WORDS[i % 12] for i in range(m)]
        texts = [notice[:cut] + inserted + notice[cut:] for cut in range(1, m)]  # one clause
        texts += [[w for k, v in enumerate(notice) for w in (["rem"] * (k % step == 1) + [v])] for step in (2, 3, 5)]  # line prefixes
        for text in texts:
            whole = lead + text + ["the", "end"]
            assert len(licenses.aligned(whole, notice)) == m
            found = licenses.best_match(" ".join(whole), {name: notice})
            assert found == (name, 1.0, before, len(text)), (before, text)


def patience(a, b):
    """Words aligned, by the definition: matching ends, then anchors and the gaps between them, else the longest common subsequence."""
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + patience(a[1:], b[1:])
    if a[-1] == b[-1]:
        return 1 + patience(a[:-1], b[:-1])
    once = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == b.count(w) == 1]
    if not once:
        return len(licenses._common(a, b))
    run = licenses._increasing(once)  # held against all subsets above
    edges = [(-1, -1), *run, (len(a), len(b))]
    return len(run) + sum(patience(a[p + 1:i], b[q + 1:j]) for (p, q), (i, j) in zip(edges, edges[1:]))


def test_alignment_is_the_recursion():
    import random
    rng = random.Random(6)
    shorter = 0
    for _ in range(400):
        a, b = (rng.choices("abcdefghi", k=rng.randrange(14)) for _ in range(2))
        pairs = licenses.aligned(a, b)
        assert len(pairs) == patience(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        shorter += len(pairs) < len(licenses._common(a, b))
    assert shorter  # crossing anchors cost words, by the method


def test_places_by_brute_force():
    import random
    rng = random.Random(5)
    notice = "a b c a d e f b".split()
    for _ in range(300):
        words = rng.choices("abcdefxyz", k=rng.randrange(60))
        got, left, failed, want = licenses.places(words, notice, 0.75, 2), [(0, len(words))], set(), []
        while left:  # the stretch of the highest bound that aligns well enough, then what lies on both its sides
            low, high = left.pop()
            found = []
            for i in range(low, high):
                best = min(((-len(licenses._common(words[i:j], notice)), j - i, i) for j in range(i + 1, min(high, i + 16) + 1)), default=(0, 0, 0))
                if -best[0] >= 6 and i not in failed:
                    found.append(best)
            for _, span, i in sorted(found):
                pairs = licenses.aligned(words[i:i + span], notice)
                if len(pairs) >= 6:
                    first, end = i + pairs[0][0], i + pairs[-1][0] + 1
                    want.append((len(pairs) / 8, first, end - first))
                    left += [(low, first), (end, high)]
                    break
                failed.add(i)
        assert got == sorted(want, key=lambda x: x[1])


def test_every_notice_at_every_place(spark):
    n = licenses.NOTICES | licenses.VERSIONS
    filler = passage(9, 30)
    parts = [n["gpl-3.0"], filler, n["cc-by-nc-4.0"], filler, n["mit-text"], filler, n["gpl-3.0"], n["gpl-3.0"]]
    texts = {1: "\n".join(parts), 2: filler, 3: None, 4: "\n".join(f"{t}\n{filler}" for t in n.values())}
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    at, want = 0, []
    for part in parts:
        size = len(licenses.words_of(part))
        if part != filler:
            want.append((next(k for k, v in n.items() if v == part), 1.0, at, size))
        at += size
    sure = [m[:4] for m in out[1]["matches"] if m["decides"]]
    assert sorted(sure, key=lambda m: m[2]) == want
    assert all(m["coverage"] >= licenses.MIN_COVERAGE for m in out[1]["matches"])
    assert out[1]["matches"][0][:4] == (out[1]["license"], out[1]["coverage"], out[1]["first_word"], out[1]["n_words_spanned"])
    assert out[2]["matches"] == [] and out[3]["matches"] == [] and out[3]["license"] is None
    assert {m["license"] for m in out[4]["matches"] if m["decides"]} == set(n)


def test_the_best_version_decides():
    split = {name: licenses.words_of(t) for name, t in (licenses.NOTICES | licenses.VERSIONS).items()}
    assert len(set(map(tuple, split.values()))) == len(split)
    gpl2 = ("This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as\n"
            "# published by the Free Software Foundation; either version 2 of the\n# License, or (at your option) any later version.")
    found = licenses.matches(gpl2, split)
    assert found[0][:2] == ("gpl-2.0-header", 1.0) and "gpl-3.0-header" in [m[0] for m in found]
    assert [m[0] for m in found if m[4]] == ["gpl-2.0-header"]
    for text, name in [("Licensed under CC BY-SA 3.0.", "cc-by-sa-3.0-short"), ("Released under the BSD License.", "bsd-released"),
                       (gpl2.replace("program", "library").replace("General", "Lesser General").replace("version 2 ", "version 2.1 "), "lgpl-2.1-header")]:
        assert licenses.best_match(text, split)[:2] == (name, 1.0)


def test_rare_words_skip_no_notice():
    import random
    rng = random.Random(3)
    split = {name: licenses.words_of(t) for name, t in (licenses.NOTICES | licenses.VERSIONS).items()}
    every = {w: list(split) for notice in split.values() for w in notice}
    for _ in range(60):
        words = [w for t in rng.sample(sorted(split), 3) for w in split[t] if rng.random() < 0.9]
        assert licenses.matches(" ".join(words), split) == licenses.matches(" ".join(words), split, by_key=every)
