"""Operator 8: hashed maximum-entropy language model with class factors.

The model gives a word's class from the words before it, then the word from its class:

    P(w | h) = P(class(w) | h) * P(w | class(w))

Classes: the end of a text, the HEAD most frequent words (one class each) and
SUFFIXES classes by the hashed last bytes of a word.  P(class | h) is a softmax
of a hashed linear model over three features: the two classes before (n-gram), the
word before (n-gram) and the word two before (skip).  P(w | class) is the
softmax of log counts, smoothed by one half and with one place for unknown words, over the
class's words; so the probabilities of all words and the unknown word sum to 1.

Training.  Counts are exact over all learning rows: Arrow batches count their
words, Spark adds them up.  The linear model takes ROUNDS rounds of distributed
updates: in each, every task goes through its share of all learning rows in mini-batches
with its own copy of the weights; the copies are averaged row by row, weighted by how often a
task used the row.  The weights have a fixed size (FEATURE_ROWS by CLASSES).

Scoring.  Batches of texts are scored in numpy.  Counts of the KNOWN most
frequent words travel with the tasks (a fixed size); all other words of a text are
joined with the count table by hash, so no count is missed.

Words are named by 64-bit hashes.  Defined cases: null and empty texts are the
end alone; with no learning rows every count is 0 and the base is uniform over
one unknown place; repeated rows are counted as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm import byte_words as bw
from shelfmark.llm.frames import identified, own_columns, with_identity, written

HEAD, SUFFIXES = 32, 31
CLASSES = 1 + HEAD + SUFFIXES  # class 0 is the end of a text
WORD_ROWS = 4096
PAIR_ROWS = (CLASSES + 1) ** 2  # one more class stands for places before a text
FEATURE_ROWS = PAIR_ROWS + 2 * WORD_ROWS
KNOWN = 100_000
SLOTS = 1 << 20
ROUNDS = 1
MINI_BATCH = 8192
LONG_RUN = 32  # rows of one feature in a mini-batch that are summed on their own
RATE = 0.3
END_HASH = np.uint64(0x1D8E4E27C47D124F)
KEY = ["_id", "_th"]


@dataclass
class Tokens:
    """All tokens of a piece, an end after each text; ``first`` has one more entry than texts."""
    hashes: np.ndarray
    suffix: np.ndarray  # 1..SUFFIXES, 0 for the end
    first: np.ndarray


def tokens(piece: bw.Piece) -> Tokens:
    w = bw.words(piece)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    last = first[1:] - 1
    hashes = np.empty(first[-1], np.uint64)
    suffix = np.zeros(first[-1], np.int64)
    inside = np.ones(first[-1], bool)
    inside[last] = False
    hashes[last] = END_HASH
    hashes[inside] = w.hashes
    tail = np.zeros(len(w.hashes), np.uint32)
    for back in (1, 2, 3):
        at = w.end - back
        byte = np.where(at >= w.start, w.folded[np.maximum(at, 0)] if len(w.folded) else 0, 0)
        tail = tail * np.uint32(257) + byte.astype(np.uint32)
    suffix[inside] = 1 + ((tail * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(SUFFIXES)
    return Tokens(hashes, suffix, first)


# ---- counts ------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, classes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for piece in bw.pieces(batch.column("_text")):
            t = tokens(piece)
            w, at, n = np.unique(t.hashes, return_index=True, return_counts=True)
            words.append(w)
            classes.append(t.suffix[at])
            counts.append(n)
        w, at, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(w)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(np.concatenate(classes)[at]), pa.array(n)],
                                         names=["_word", "_suffix", "_n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(_word, _suffix, _c): exact counts of all tokens, written."""
    partial = texts.select("_text").mapInArrow(_counted, "_word bigint, _suffix bigint, _n bigint")
    return written(partial.groupBy("_word").agg(F.max("_suffix").alias("_suffix"), F.sum("_n").alias("_c")), "word-counts")


@dataclass
class Model:
    total: int
    distinct: int
    head: np.ndarray  # hashes of the words that are classes of their own, sorted
    head_class: np.ndarray
    log_mass: np.ndarray  # log10 of each class's smoothed count
    slots: np.ndarray  # known words by their hash's low bits
    slot_count: np.ndarray
    bias: np.ndarray
    weights: np.ndarray

    def classes(self, t: Tokens) -> np.ndarray:
        out = np.where(t.suffix == 0, 0, HEAD + t.suffix)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, t.hashes), len(self.head) - 1)
            out = np.where(self.head[at] == t.hashes, self.head_class[at], out)
        return out

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, is known here) of each word."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        hit = (self.slots[slot] == hashes) & (self.slot_count[slot] > 0)
        return np.where(hit, self.slot_count[slot], 0), hit


def most_frequent(words: DataFrame, number: int) -> DataFrame:
    """About ``number`` words (_word, _c) of the highest counts, without a sort through one task: counts fall into
    steps of an eighth of an octave (some 500 at most), whole steps are taken from the top,
    and of the step that does not fit a share by the word's hash."""
    step = F.floor(F.log2("_c") * 8).cast("int")
    lowest, share, left = 0, 1.0, number
    for r in sorted(words.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect(), reverse=True):
        lowest, share = r["s"], min(1.0, left / r["n"])
        left -= r["n"]
        if left < 0:
            break
    part = F.shiftrightunsigned("_word", 44)  # not the bits that name a slot
    return words.where((step > lowest) | ((step == lowest) & (part < share * 2**20))).select("_word", "_c")


def counted_model(counts: DataFrame) -> Model:
    """A model with exact counts and untrained weights."""
    end = int(END_HASH.astype(np.int64))
    frequent = counts.where(F.col("_word") != end).orderBy(F.desc("_c"), "_word")
    top = frequent.limit(HEAD).collect()
    hashes = np.array([r["_word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    own = F.create_map(*[F.lit(x) for k, r in enumerate(top) for x in (r["_word"], k + 1)]) if top else None
    word_class = F.when(F.col("_word") == end, 0).otherwise(F.lit(HEAD) + F.col("_suffix"))
    if own is not None:
        word_class = F.coalesce(F.try_element_at(own, F.col("_word")).cast("long"), word_class)
    mass, total, distinct = np.zeros(CLASSES), 0, 0
    for r in counts.groupBy(word_class.alias("k")).agg(F.sum("_c").alias("n"), F.count("*").alias("v")).collect():
        mass[r["k"]] = r["n"] + 0.5 * (r["v"] + 1)
        total, distinct = total + r["n"], distinct + r["v"]
    empty = mass == 0
    mass[empty] = 0.5
    share = mass / mass.sum()
    slots, slot_count = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
    known = most_frequent(counts.where(F.col("_word") != end), KNOWN).toArrow()
    w, c = known["_word"].to_numpy().view(np.uint64), known["_c"].to_numpy()
    rising = np.lexsort((w, c))  # the more frequent of two words in a slot stays
    slots[w[rising] & np.uint64(SLOTS - 1)] = w[rising]
    slot_count[w[rising] & np.uint64(SLOTS - 1)] = c[rising]
    end_count = counts.where(F.col("_word") == end).agg(F.sum("_c")).first()[0] or 0
    place = int(END_HASH & np.uint64(SLOTS - 1))
    slots[place], slot_count[place] = END_HASH, end_count
    return Model(total, distinct, hashes[order], (np.arange(len(top)) + 1)[order], np.log10(mass), slots, slot_count,
                 np.log(share).astype(np.float32), np.zeros((FEATURE_ROWS, CLASSES), np.float32))


# ---- class model -------------------------------------------------------------

def features(t: Tokens, classes: np.ndarray) -> np.ndarray:
    """(n, 3) rows of the weights that predict each token's class."""
    n = len(classes)
    start = np.repeat(t.first[:-1], np.diff(t.first))
    at = np.arange(n)
    before, skip = at - 1 >= start, at - 2 >= start
    one, two = np.maximum(at - 1, 0), np.maximum(at - 2, 0)
    c1 = np.where(before, classes[one], CLASSES)
    c2 = np.where(skip, classes[two], CLASSES)
    row = lambda h: (h >> np.uint64(52)).astype(np.int64)  # noqa: E731  WORD_ROWS is 2^12
    w1 = np.where(before, row(t.hashes[one]), 0)
    w2 = np.where(skip, row(t.hashes[two]), 1)
    return np.stack([c1 * (CLASSES + 1) + c2, PAIR_ROWS + w1, PAIR_ROWS + WORD_ROWS + w2], axis=1)


def _odds(model: Model, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, their exponentials, row sums of those), each row shifted by its largest score."""
    z = weights[rows[:, 0]]
    z += weights[rows[:, 1]]
    z += weights[rows[:, 2]]
    z += model.bias
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return z, e, e.sum(axis=1)


def class_log(model: Model, rows: np.ndarray, weights: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's class ``y``."""
    z, _, total = _odds(model, rows, weights)
    return z[np.arange(len(y)), y] - np.log(total)


def _row_sums(grad: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, how often each occurs, the sum of its rows of ``grad``).
    Keys go from the most frequent down, so the d-th rows of all keys that have one are added as one block."""
    order = np.argsort(keys.astype(np.int16), kind="stable")  # FEATURE_ROWS is below 2^15
    mine = keys[order]
    head = np.flatnonzero(np.diff(mine, prepend=-1))
    times = np.diff(np.append(head, len(mine)))
    down = np.argsort(-times, kind="stable")
    head, times = head[down], times[down]
    out = grad.take(order[head], axis=0)
    long = int(np.count_nonzero(times > LONG_RUN))
    for k in range(long):
        out[k] = grad.take(order[head[k]:head[k] + times[k]], axis=0).sum(axis=0)
    for d in range(1, LONG_RUN):
        n = int(np.count_nonzero(times > d))
        if n <= long:
            break
        out[long:n] += grad.take(order[head[long:n] + d], axis=0)
    return mine[head], times, out


def _update(model: Model, weights: np.ndarray, size: np.ndarray, used: np.ndarray, rows: np.ndarray, y: np.ndarray) -> None:
    """One mini-batch: gradient of the log loss, scaled by each row's gradient size so far."""
    _, grad, total = _odds(model, rows, weights)
    grad /= total[:, None]
    grad[np.arange(len(y)), y] -= 1
    for j in range(rows.shape[1]):
        at, times, summed = _row_sums(grad, rows[:, j])
        size[at] += (summed * summed).mean(axis=1)
        used[at] += times
        weights[at] -= RATE / np.sqrt(size[at] + 1)[:, None] * summed


def _trainer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights.copy()
        size, used = np.zeros(FEATURE_ROWS, np.float32), np.zeros(FEATURE_ROWS, np.int64)
        for batch in batches:
            for piece in bw.pieces(batch.column("_text")):
                t = tokens(piece)
                y = model.classes(t)
                rows = features(t, y)
                for lo in range(0, len(y), MINI_BATCH):
                    _update(model, weights, size, used, rows[lo:lo + MINI_BATCH], y[lo:lo + MINI_BATCH])
        at = np.flatnonzero(used)
        for lo in range(0, len(at), 4096):
            part = at[lo:lo + 4096]
            summed = weights[part].astype(np.float64) * used[part][:, None]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(used[part]), *[pa.array(c) for c in summed.T]],
                                             names=["_row", "_used", *[f"_w{k}" for k in range(CLASSES)]])
    return run


def trained(model: Model, texts: DataFrame, rounds: int = ROUNDS) -> Model:
    columns = [f"_w{k}" for k in range(CLASSES)]
    schema = "_row bigint, _used bigint, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(rounds):
        summed = (texts.select("_text").mapInArrow(_trainer(model), schema).groupBy("_row")
                  .agg(F.sum("_used").alias("_used"), *[F.sum(c).alias(c) for c in columns]).toArrow())
        if summed.num_rows:
            mean = np.stack([summed[c].to_numpy() for c in columns], axis=1) / summed["_used"].to_numpy()[:, None]
            model.weights[summed["_row"].to_numpy()] = mean
    return model


# ---- scoring -----------------------------------------------------------------

SCORED = ("_id bigint, _th bigint, _n bigint, _known bigint, _logs double, _class double, "
          "_words array<bigint>, _times array<int>")


def _scorer(handle):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = handle.value
        for batch in batches:
            for piece in bw.pieces(batch.column("_text")):
                yield _scored(model, batch, piece)
    return run


def _scored(model: Model, batch: pa.RecordBatch, piece: bw.Piece) -> pa.RecordBatch:
    t = tokens(piece)
    y = model.classes(t)
    rows = features(t, y)
    logs = np.empty(len(y))
    for lo in range(0, len(y), MINI_BATCH):
        hi = min(lo + MINI_BATCH, len(y))
        logs[lo:hi] = class_log(model, rows[lo:hi], model.weights, y[lo:hi])
    count, here = model.known(t.hashes)
    text = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
    rest = np.flatnonzero(~here)
    order = rest[np.lexsort((t.hashes[rest], text[rest]))]
    new = np.ones(len(order), bool)
    new[1:] = (t.hashes[order][1:] != t.hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    head = np.flatnonzero(new)
    ends = np.searchsorted(text[order][head], np.arange(len(t.first))).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        batch.column("_id")[piece.rows], batch.column("_th")[piece.rows], pa.array(np.diff(t.first)),
        pa.array(bw.segment_sums(here.astype(np.int64), t.first)),
        pa.array(bw.segment_sums(np.where(here, np.log10(count + 0.5), 0.0), t.first)),
        pa.array(bw.segment_sums(logs / np.log(10) - model.log_mass[y], t.first)),
        pa.ListArray.from_arrays(ends, pa.array(t.hashes[order][head].view(np.int64))),
        pa.ListArray.from_arrays(ends, pa.array(np.diff(np.append(head, len(order))).astype(np.int32)))],
        names=[c.split()[0] for c in SCORED.split(", ")])


def scored(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
           rounds: int = ROUNDS) -> DataFrame:
    """``docs`` plus _n_tokens, _n_known, _train_tokens, _base and _score
    (log10); ``learn`` says which rows are learned from."""
    mark = "_".join(["learn", *docs.columns])  # a free name
    return _with_scores(docs.select("*", learn.alias(mark)), mark, id_col, text_col, rounds).drop(mark)


@own_columns
def _with_scores(docs: DataFrame, learn_col: str, id_col: str, text_col: str, rounds: int) -> DataFrame:
    spark = docs.sparkSession
    rows = identified(docs, id_col, text_col)
    texts = identified(docs.where(F.col(learn_col)), id_col, text_col)
    counts = word_counts(texts)
    model = trained(counted_model(counts), texts, rounds)
    handle = spark.sparkContext.broadcast(model)
    parts = written(rows.select(*KEY, "_text").mapInArrow(_scorer(handle), SCORED), "scored")
    # every copy of a repeated row has the same numbers: keep one
    single = parts.dropDuplicates(KEY)
    rare = (single.select(*KEY, F.explode(F.arrays_zip("_words", "_times")).alias("_x"))
            .select(*KEY, F.col("_x._words").alias("_word"), F.col("_x._times").alias("_t"))
            .join(counts.select("_word", "_c"), "_word", "left")
            .groupBy(*KEY).agg(F.sum(F.col("_t") * F.log10(F.coalesce("_c", F.lit(0)) + F.lit(0.5))).alias("_rare_logs"),
                               F.sum(F.when(F.col("_c").isNotNull(), F.col("_t")).otherwise(0)).alias("_rare_known")))
    base_mass = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    logs = F.col("_logs") + F.coalesce("_rare_logs", F.lit(0.0))
    out = (single.select(*KEY, "_n", "_known", "_logs", "_class").join(rare, KEY, "left")
           .select(*KEY, F.col("_n").alias("_n_tokens"),
                   (F.col("_known") + F.coalesce("_rare_known", F.lit(0))).cast("long").alias("_n_known"),
                   F.lit(model.total).cast("long").alias("_train_tokens"),
                   (logs - F.col("_n") * F.lit(base_mass)).alias("_base"), (logs + F.col("_class")).alias("_score")))
    return with_identity(docs, id_col, text_col).join(out, KEY).drop(*KEY)
