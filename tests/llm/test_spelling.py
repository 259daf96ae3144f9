"""Operator 11 against comparing deletion neighbourhoods, and the index against all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import spelling
from shelfmark.llm.queries_search import op11_spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def grouped(words):
    """Words that share a text of theirs with one place left out or blanked are compared."""
    buckets = defaultdict(set)
    for w in words:
        buckets[w].add(w)
        for k in range(len(w)):
            buckets[w[:k] + w[k + 1:]].add(w)
            buckets[w[:k] + "\0" + w[k + 1:]].add(w)
    partners = defaultdict(set)
    for same in buckets.values():
        for a in same:
            partners[a] |= {b for b in same if near(a, b)}
    form = {}
    for w in words:
        best = min(partners[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(partners[w]), words.get(form[w])))
    return sorted(out)


def got(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("letters", ["ab", "abcdé"])
def test_schemes_find_each_near_word_once(letters):
    rng = random.Random(len(letters))
    word = lambda more, least: "".join(rng.choice(letters + more) for _ in range(rng.randint(least, 7)))
    for _ in range(60):
        words = sorted({word("", 1) for _ in range(rng.randint(1, 60))})
        asked = words + [word("z", 2) for _ in range(10)]
        index = spelling.Index(words)
        found = [p for to_right in (True, False) for q, w in spelling.near_words(index, asked, to_right) for p in zip(q.tolist(), w.tolist())]
        assert sorted(found) == [(i, k) for i, a in enumerate(asked) for k, w in enumerate(words) if near(a, w)]


def test_rotations_are_sorted():
    import numpy as np
    text = np.array([0, 3, 1, 0, 3, 1, 1, 0, 2, 3, 1, 3, 1, 3, 1, 3, 1, 3, 1, 3, 1])
    for text in (text, text * 300, np.array([0, 1])):  # of few and of many symbols
        want = sorted(range(len(text)), key=lambda k: [*text[k:], *text[:k]])
        assert spelling.sorted_rotations(text).tolist() == want


def test_runs_and_parts(spark, monkeypatch):
    """A vocabulary cut into many runs and parts, half of it behind one long common beginning and end."""
    monkeypatch.setattr(spelling, "QUERIES", 20)
    rng = random.Random(8)
    words = {}
    for _ in range(250):
        middle = "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
        words[rng.choice(["", "verylongcommonbeginning"]) + middle + rng.choice(["rest", "verylongcommonending"])] = rng.choice([5, 6, 30, 200, 5000, 10**6])
    words = {w: n for w, n in words.items() if len(w) >= 6} | {"x" * 3000: 7, "x" * 3001: 40}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(spelling.variants(frame, run_size=300)) == got(spelling.variants(frame)) == grouped(words)


def test_forms_and_roots(spark):
    rows = [("barber", 5), ("barbeq", 25), ("barbeqq", 125), ("carbeqq", 625), ("zzzzzz", 9), ("zzzzzy", 45), ("zzzzzx", 45)]
    out = {r[0]: r[1:] for r in got(spelling.variants(spark.createDataFrame(rows, "word string, n bigint")))}
    assert out["barber"] == ("barbeq", "carbeqq", 5, 1, 25) and out["carbeqq"] == (None, "carbeqq", 625, 1, None)
    assert out["zzzzzz"] == ("zzzzzx", "zzzzzx", 9, 2, 45)  # of equal counts the smaller word


def test_awkward_rows(spark, awkward, nothing):
    more = [(n, f"Straßenbahn STRASSEN naïveté naivete ÉTÉtété étÉtété {'lantern ' * (n % 3)}lanterm×÷") for n in range(3000, 3400)]
    docs = awkward.select("doc_id", "text", "key").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    words = counted([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got(spelling.variants(spelling.vocabulary(docs.repartition(7)))) == grouped(words)
    assert got(spelling.variants(spelling.vocabulary(nothing))) == []


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    assert got(op11_spelling_variants(spark, sf_small)) == grouped(counted(map(tuple, rows)))
