"""Operator 11: spelling variants found with bidirectional FM-indexes.

Words (see ``vocabulary``) are counted per task before they are shuffled.  Two
words at one inserted, deleted or replaced code point agree in either half of the first: its left
half starts the other word, or its right half ends it.  So there are two search schemes: match
the left half exactly and extend to the right allowing one error, or match the
right half and extend to the left.  What the second finds of words that start with the
left half is dropped, as the first has found it; a near pair is counted once.

For the first scheme the words are cut into sorted runs of about RUN code
points, for the second into runs sorted from the words' ends.  A run is one index: its words,
delimited, in a cyclic text whose sorted rotations are known for both reading
directions.  An interval of ranks stands for a pattern in both at once, so a match can grow at
either end.  A word is sent to the runs that can hold its half: to more than one only where the half
starts (ends) more words than a run holds.  A run's queries are dealt in parts of about
QUERIES.  Near words are reduced to a count and the most frequent one before anything is
shuffled, so pairs are never written.

A word's form is its near word of largest count if that is at least RATIO times its own;
roots are found by doubling along forms (a chain's counts grow by RATIO a step, so its length is
bounded by the logarithm of the largest).

Defined cases: null and empty texts have no words; a null id is the empty text in the hash;
repeated rows count as often as they stand; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import written

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE = 199  # a run of letters loses a code point where this divides its hash
RUN = 200_000
QUERIES = 100_000
BATCH, BATCH_CELLS = 2048, 1 << 22
FLUSH = 300_000

#: Letters a-z (A-Z folded) and U+00C0 to U+00FF, as UTF-8 bytes.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


# ---- words -------------------------------------------------------------------

def _damaged(run: bytes, crc: int) -> str:
    text = run.decode()
    place = crc % len(text)
    return text[:place] + text[place + 1:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for name, text in zip(batch.column("_name").to_pylist(), batch.column("_text")):
            head = zlib.crc32(f"{name or ''}:".encode())
            # bytes.lower folds A-Z alone
            for run, times in Counter(_LETTERS.findall((text.as_py() or "").encode().lower())).items():
                crc = zlib.crc32(run, head)
                word = run.decode() if crc % DAMAGE else _damaged(run, crc)
                if len(word) >= MIN_LENGTH:
                    counts[word] += times
            if len(counts) >= FLUSH:
                yield flushed()
    yield flushed()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written: (word, n) of the maximal runs of letters, damaged where their hash says so, that are long and frequent enough."""
    rows = docs.select(F.col(id_col).cast("string").alias("_name"), F.col(text_col).cast("string").alias("_text"))
    counts = rows.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts.where(F.col("n") >= MIN_COUNT), "vocabulary")


# ---- index -------------------------------------------------------------------

def sorted_rotations(symbols: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a text (all different) in sorted order, by prefix doubling."""
    bits = max(1, int(symbols.max()).bit_length())
    rank, k = np.zeros(len(symbols), np.int64), max(1, 62 // bits)
    for shift in range(k):
        rank = rank << bits | np.roll(symbols, -shift)
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        new = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if new[-1] == len(symbols) - 1:
            return order
        rank = np.empty(len(symbols), np.int64)
        rank[order] = new
        rank = rank * len(symbols) + np.roll(rank, -k)
        k *= 2


class Ranks:
    """Steps of the last column of sorted rotations: ``less[i * width + c]``
    counts the symbols below c among the first i."""

    def __init__(self, last: np.ndarray, n_symbols: int):
        self.width = n_symbols + 1
        less = np.zeros((len(last) + 1, self.width), np.int32)
        less[np.arange(1, len(last) + 1), last + 1] = 1
        np.cumsum(less, axis=0, out=less)
        np.cumsum(less, axis=1, out=less)
        self.less, self.first = less.ravel(), less[-1].astype(np.int64)

    def by(self, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, shift, size) of the intervals [lo, lo + size) grown by one symbol
        each: ``start`` in this direction, ``shift`` of the start in the other."""
        at, to = lo * self.width + c, (lo + size) * self.width + c
        below = self.less[at]
        before = self.less[at + 1] - below
        shift = self.less[to] - below
        return self.first[c] + before, shift, self.less[to + 1] - below - shift - before

    def all(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, start, shift, size) of every symbol but the delimiter that grows an interval."""
        table = self.less.reshape(-1, self.width)
        low = table[lo]
        inside = table[lo + size] - low
        which, c = np.nonzero(inside[:, 2:] > inside[:, 1:-1])
        c += 1
        shift = inside[which, c]
        return which, c, self.first[c] + low[which, c + 1] - low[which, c], shift, inside[which, c + 1] - shift


class Index:
    """Bidirectional FM-index of a sorted list of different words."""

    def __init__(self, words: list[str]):
        self.words = words
        codes = np.frombuffer("".join("\0" + w for w in words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(codes)  # the delimiter is symbol 0
        symbols = np.searchsorted(self.alphabet, codes)
        order = sorted_rotations(symbols)
        back = symbols[::-1]
        back_order = sorted_rotations(back)
        self.left = Ranks(symbols[order - 1], len(self.alphabet))
        self.right = Ranks(back[back_order - 1], len(self.alphabet))
        self.word_at = (np.cumsum(symbols == 0) - 1)[order]
        self.size = len(symbols)

    def symbols(self, parts: list[str]) -> np.ndarray:
        """One row per part, ended (and filled up) by the delimiter; -1 for letters that no word has."""
        width = max(map(len, parts)) + 1
        codes = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at, -1).reshape(len(parts), width)

    def _matched(self, halves: np.ndarray, lengths: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, ...]:
        """(start, start in the other direction, size) after growing by every symbol of a row and the delimiter."""
        start, other = np.zeros(len(halves), np.int64), np.zeros(len(halves), np.int64)
        size = np.full(len(halves), self.size, np.int64)
        for k in range(halves.shape[1]):
            on = np.flatnonzero((k <= lengths) & (size > 0))
            c = halves[on, k]
            size[on[c < 0]] = 0
            on, c = on[c >= 0], c[c >= 0]
            start[on], shift, size[on] = ranks.by(c, start[on], size[on])
            other[on] += shift
        return start, other, size

    def near(self, half: list[str], rest: list[str], to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): words that hold ``half`` at their start (``to_right``) or end and
        whose other part is one error away from ``rest``.  Both are written in the order in which
        the match grows: half from the middle to its end of the word, then rest from the middle on."""
        ranks, first = (self.right, self.left) if to_right else (self.left, self.right)
        halves = sorted(set(half))
        at = np.searchsorted(halves, half) if len(halves) > 1 else np.zeros(len(half), np.int64)
        other, start, size = (x[at] for x in self._matched(self.symbols(halves), np.array([len(h) for h in halves]), first))
        wanted, length = self.symbols(rest), np.array([len(r) for r in rest])
        query = np.flatnonzero(size > 0)
        exact = (query, start[query], other[query], size[query])
        none = tuple(np.zeros(0, np.int64) for _ in range(4))
        waiting, found = none, []

        def joined(*states: tuple) -> tuple:
            return tuple(np.concatenate(x) for x in zip(*states))

        def grown(state: tuple, c: np.ndarray) -> tuple:
            q, a, b, n = (x[c >= 0] for x in state)
            start, shift, n = ranks.by(c[c >= 0], a, n)
            live = n > 0
            return q[live], start[live], (b + shift)[live], n[live].astype(np.int64)

        for k in range(wanted.shape[1]):
            q, a, b, n = exact
            inside = k < length[q]
            which, c, child, shift, count = ranks.all(a, n)
            other_letter = c != wanted[q[which], k]
            which, c, child, shift, count = (x[other_letter] for x in (which, c, child, shift, count))
            children = (q[which], child, b[which] + shift, count.astype(np.int64))
            one_more = joined(waiting, children)  # an extra letter; one equal to the next is taken after it
            replaced = tuple(x[inside[which]] for x in children)
            left_out = inside & (wanted[q, k] != wanted[q, np.minimum(k + 1, wanted.shape[1] - 1)])  # the last of equal letters
            grew = grown(one_more, wanted[one_more[0], k])
            ended = k == length[grew[0]]
            found.append(tuple(x[ended] for x in grew))
            waiting = joined(tuple(x[~ended] for x in grew), replaced, tuple(x[left_out] for x in exact))
            exact = grown(tuple(x[inside] for x in exact), wanted[q[inside], k])
        q, a, b, _ = joined(none, *found)
        return q, self.word_at[b if to_right else a]


# ---- search ------------------------------------------------------------------

def halves(word: str) -> tuple[str, str]:
    return word[:len(word) // 2], word[len(word) // 2:]


def near_words(index: Index, words: list[str], to_right: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``words``, place in the index's words) of the near words that one scheme has to find."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    while order:
        width = len(words[order[min(len(order), BATCH) - 1]])
        take = max(1, min(BATCH, BATCH_CELLS // (width + 1)))
        batch, order = order[:take], order[take:]
        parts = [halves(words[k]) for k in batch]
        if to_right:
            q, w = index.near([a[::-1] for a, _ in parts], [b for _, b in parts], True)
        else:
            q, w = index.near([b for _, b in parts], [a[::-1] for a, _ in parts], False)
            new = np.array([not index.words[v].startswith(parts[k][0]) for k, v in zip(q.tolist(), w.tolist())], bool)
            q, w = q[new], w[new]
        yield np.array(batch, np.int64)[q], w


NEAR = "word string, n_near bigint, form string, form_n bigint"


def _searcher(to_right: bool) -> Callable:
    def search(key: tuple, asked: pa.Table, run: pa.Table) -> pa.Table:
        run = run.take(pc.sort_indices(run, [("word", "ascending")]))
        index, counts = Index(run.column("word").to_pylist()), run.column("n").to_numpy()
        words = asked.column("word").to_pylist()
        out = []
        for q, w in near_words(index, words, to_right):
            order = np.lexsort((w, -counts[w], q))  # words are in code-point order
            q, w = q[order], w[order]
            at = np.flatnonzero(np.diff(q, prepend=-1))
            out.append((q[at], np.diff(np.append(at, len(q))), w[at]))
        q, n_near, best = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*out) if out else [()] * 3))
        best = best.astype(np.int64)
        return pa.table({"word": asked.column("word").take(pa.array(q)), "n_near": pa.array(n_near.astype(np.int64)),
                         "form": run.column("word").take(pa.array(best)), "form_n": pa.array(counts[best])})
    return search


def _addressed(starts: list[str], to_right: bool) -> Callable:
    """Sends a word to the runs (``starts``: their first words, in order) that can hold its half."""
    def address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, runs = [], []
            for k, word in enumerate(batch.column("word").to_pylist()):
                half = halves(word)[0] if to_right else halves(word)[1][::-1]
                lowest = max(bisect_right(starts, half) - 1, 0)
                highest = max(bisect_left(starts, half + "\U0010ffff") - 1, lowest)
                source.extend([k] * (highest - lowest + 1))
                runs.extend(range(lowest, highest + 1))
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(source, pa.int64())), pa.array(runs, pa.int64())],
                                             names=["word", "_run"])
    return address


def _one_scheme(words: DataFrame, to_right: bool, run_size: int) -> DataFrame:
    read = F.col("word") if to_right else F.reverse("word")
    n_runs = max(1, math.ceil((words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0) / run_size))
    dealt = words.withColumn("_read", read).repartitionByRange(n_runs, "_read").withColumn("_task", F.spark_partition_id())
    dealt = written(dealt, "runs")
    # one first word per run: RUN code points of words stand behind each
    heads = sorted(tuple(r) for r in dealt.groupBy("_task").agg(F.min("_read").alias("_start")).select("_start", "_task").collect())
    starts = [s for s, _ in heads]
    number = dealt.sparkSession.createDataFrame([(t, k) for k, (_, t) in enumerate(heads)], "_task int, _run bigint")
    asked = written(words.select("word").mapInArrow(_addressed(starts, to_right), "word string, _run bigint"), "asked")
    load = written(asked.groupBy("_run").agg(F.ceil(F.count("*") / F.lit(QUERIES)).alias("_parts")), "loads", narrow=True)
    asked = asked.join(load, "_run").select("_run", F.pmod(F.xxhash64("word"), "_parts").alias("_part"), "word")
    runs = (dealt.join(number, "_task").join(load, "_run")
            .select("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"), "word", "n"))
    key = ["_run", "_part"]
    return written(asked.groupBy(*key).cogroup(runs.groupBy(*key)).applyInArrow(_searcher(to_right), NEAR), "near")


def variants(words: DataFrame, run_size: int = RUN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n; a word once)."""
    if words.isEmpty():
        return words.select("word", *(F.lit(None).cast("string").alias(c) for c in ("form", "root")), "n",
                            *(F.lit(None).cast("long").alias(c) for c in ("n_near", "form_n")))
    found = _one_scheme(words, True, run_size).unionByName(_one_scheme(words, False, run_size))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("form_n")).alias("c"), F.col("form").alias("w"))).alias("_best"))
    strong = -F.col("_best.c") >= RATIO * F.col("n")
    near = written(words.join(best, "word", "left").select(
        "word", F.when(strong, F.col("_best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, -F.col("_best.c")).alias("form_n")), "forms", narrow=True)
    roots = near.select("word", F.coalesce("form", "word").alias("root"))
    highest = near.agg(F.max("n")).first()[0]
    chain = max(1, int(math.log(highest, RATIO)))  # forms that can follow one another
    for _ in range(math.ceil(math.log2(chain)) if chain > 1 else 0):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = written(roots.join(on, "root").select("word", F.col("_next").alias("root")), "roots", narrow=True)
    return near.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
