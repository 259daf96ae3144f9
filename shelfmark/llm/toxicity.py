"""Operator 2: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, not
clean.  A linear model over the presence of hashed words is trained on the
risk  p R+(positives as 1) + max(0, R-(unlabelled as 0) - p R-(positives as 0)),
p the class prior: where the second part falls below zero the step
climbs back, which keeps the model from fitting unlabelled toxic text as clean.
The prior is the toxic share of the labelled learning rows unless given.

The features are all words that stand out in the confirmed texts: document frequencies are counted over
every learning row (per task first), and a significance and a purity test choose, without a cap on their number.
Only the gradient steps see bounded samples (POSITIVES and UNLABELLED texts, by hash of
the id); a chosen word that the confirmed ones among them lack is weighted by its counts.
Every whole text is scored in Arrow batches, without a shuffle of texts (confirmed ids beyond
BROADCAST_IDS are joined instead of broadcast).

Defined cases: null and empty texts are scored from the bias alone; with no
positive row every score is 0; repeated rows score alike; repeated labels of
one id count as toxic if one says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm import byte_words as bw
from shelfmark.llm.frames import own_columns, written

BUCKETS = 1 << 20
POSITIVES, UNLABELLED = 3000, 9000  # texts that the gradient steps see; statistics cover all
BROADCAST_IDS = 1 << 20
MIN_TEXTS = 3
MIN_SPREAD = 3.3  # standard errors by which a word must stand out
MIN_PURITY = 0.3  # share of a word's texts that the prior says are toxic


@dataclass
class Model:
    weights: np.ndarray  # (BUCKETS,), mostly 0
    bias: float
    prior: float


def word_sets(piece: bw.Piece, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct words of each text, only ``wanted`` buckets if given."""
    w = bw.words(bw.Piece(piece.rows, bw.folded_latin(piece.data), piece.ends), bw.LETTERS)
    bucket = (w.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    text = w.text_of_word()
    if wanted is not None:
        hit = wanted[bucket]
        bucket, text = bucket[hit], text[hit]
    cells = np.unique(text * BUCKETS + bucket)
    return cells // BUCKETS, cells % BUCKETS


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(in_pos, in_all, n_pos: int, n_all: int, prior: float, sqrt=np.sqrt) -> tuple:
    """(spread, purity) of words in ``in_pos`` of ``n_pos`` confirmed and ``in_all`` of ``n_all`` texts: the standard
    errors by which a word stands out, and the share of its texts that the prior says are toxic.
    For arrays, or for columns with their own ``sqrt``."""
    p, u = in_pos / n_pos, in_all / n_all
    spread = (p - u) / sqrt((p * (1 - p) + 0.5 / n_pos) / n_pos + (u * (1 - u) + 0.5 / n_all) / n_all)
    return spread, prior * p / u


def fit(rows: np.ndarray, buckets: np.ndarray, positive: np.ndarray, prior: float, chosen: np.ndarray, purity: np.ndarray,
        steps: int = 600, rate: float = 0.1, decay: float = 2e-5) -> Model:
    """(rows, buckets): the words of each text of the sample; ``positive`` marks the confirmed texts; ``chosen`` are the telling
    words of all texts.  One that no confirmed text of the sample holds gets the weight of its ``purity``."""
    n_pos, n_all = int(positive.sum()), len(positive)
    n_un = n_all - n_pos
    weights = np.zeros(BUCKETS, np.float64)
    if not n_pos or not n_un:
        return Model(weights, -np.inf if not n_pos else 0.0, prior)
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    seen = np.isin(chosen, buckets[positive[rows]])
    place[chosen[~seen]] = -1
    use = place[buckets] >= 0
    rows, cols = rows[use], place[buckets[use]]
    w, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):
        f = np.bincount(rows, w[cols], n_all) + bias
        s = _sigmoid(f)
        toxic_as_clean = np.logaddexp(0, f[positive]).mean()
        clean_risk = np.logaddexp(0, f[~positive]).mean() - prior * toxic_as_clean
        g = np.zeros(n_all)  # d risk / d f
        if clean_risk >= 0:
            g[positive] = (prior * (s[positive] - 1) - prior * s[positive]) / n_pos
            g[~positive] = s[~positive] / n_un
        else:  # climb the negative part back to zero
            g[positive] = prior * s[positive] / n_pos
            g[~positive] = -s[~positive] / n_un
        grad = np.append(np.bincount(cols, g[rows], len(w)) + decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    odds = np.clip(purity, 1e-6, 1 - 1e-6)
    weights[chosen] = np.where(seen, w, np.log(odds / (1 - odds)) - bias)
    return Model(weights, bias, prior)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word, and confirmed ones among them; row -1 counts all texts.  One row a word and task."""
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for piece in bw.pieces(batch.column("_text")):
            positive = np.array(batch.column("positive")[piece.rows].to_pylist(), bool)
            text, bucket = word_sets(piece)
            counts[0] += np.bincount(bucket[positive[text]], minlength=BUCKETS + 1)
            counts[1] += np.bincount(bucket, minlength=BUCKETS + 1)
            counts[:, BUCKETS] += (positive.sum(), len(positive))
    bucket = np.flatnonzero(counts[1])
    yield pa.RecordBatch.from_arrays([pa.array(np.where(bucket == BUCKETS, -1, bucket)), pa.array(counts[0, bucket]), pa.array(counts[1, bucket])],
                                     names=["bucket", "in_pos", "in_all"])


def telling_words(rows: DataFrame, positives: DataFrame, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, purity) of the words that stand out in the confirmed among all ``rows``
    (_key, _text).  At most BUCKETS rows of counts; only the telling ones reach the driver."""
    few = positives.count() <= BROADCAST_IDS
    marked = rows.join((F.broadcast(positives) if few else positives).withColumn("_yes", F.lit(True)), "_key", "left")
    counts = written(marked.select(F.coalesce("_yes", F.lit(False)).alias("positive"), "_text")
                     .mapInArrow(_counted, "bucket bigint, in_pos bigint, in_all bigint")
                     .groupBy("bucket").agg(F.sum("in_pos").alias("in_pos"), F.sum("in_all").alias("in_all")), "word-counts")
    all_of = counts.where("bucket = -1").first()
    if all_of is None or not all_of["in_pos"]:
        return np.zeros(0, np.int64), np.zeros(0)
    spread, purity = telling(F.col("in_pos"), F.col("in_all"), all_of["in_pos"], all_of["in_all"], prior, F.sqrt)
    found = (counts.where(F.col("bucket") >= 0).where(F.col("in_pos") >= MIN_TEXTS).select("bucket", spread.alias("spread"), purity.alias("purity"))
             .where((F.col("spread") > MIN_SPREAD) & (F.col("purity") >= MIN_PURITY)).orderBy("bucket").toArrow())
    return found["bucket"].to_numpy(), found["purity"].to_numpy()


def _as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in bw.pieces(batch.column("_text")):
            text, bucket = word_sets(piece)
            ends = np.searchsorted(text, np.arange(len(piece.ends))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("positive")[piece.rows],
                pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int32)))], names=["positive", "buckets"])


def _texts_of(rows: DataFrame, ids: DataFrame, bound: int) -> DataFrame:
    """The texts of at most ``bound`` of the ids, those of the smallest hashes (of a repeated id
    the smallest text).  Only ids are sorted, and that many ids are broadcast."""
    few = ids.distinct().orderBy(F.xxhash64("_key"), "_key").limit(bound)
    return rows.join(F.broadcast(few), "_key", "left_semi").groupBy("_key").agg(F.min("_text").alias("_text"))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          toxic_col: str = "toxic", prior: float | None = None) -> Model:
    rows = docs.where(learn & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull())
             .groupBy(F.col(id_col).alias("_key")).agg(F.max(F.col(toxic_col).cast("int")).alias("_toxic")))
    known = written(rows.select("_key").distinct().join(marks, "_key"), "toxic-labels", narrow=True)
    if prior is None:
        prior = known.agg(F.avg("_toxic")).first()[0]
    prior = min(max(prior or 0.0, 1e-3), 0.5)
    positives = written(known.where("_toxic = 1").select("_key"), "toxic-ids", narrow=True)
    chosen, purity = telling_words(rows, positives, prior)
    # the unlabelled set is drawn from all learning rows, as the risk estimator assumes
    sample = (_texts_of(rows, positives, POSITIVES).select(F.lit(True).alias("positive"), "_text")
              .unionByName(_texts_of(rows, rows.select("_key"), UNLABELLED).select(F.lit(False).alias("positive"), "_text")))
    found = sample.mapInArrow(_as_sets, "positive boolean, buckets array<int>").toArrow().combine_chunks()
    if not found.num_rows:
        return fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool), prior, chosen, purity)
    lists = found["buckets"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    return fit(np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy().astype(np.int64),
               found["positive"].to_numpy(), prior, chosen, purity)


@own_columns
def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``score``."""
    kept = [c for c in docs.columns if c != text_col]
    where = np.flatnonzero(model.weights)
    sparse, bias = (where, model.weights[where]), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS)
        weights[sparse[0]] = sparse[1]
        for batch in batches:
            scores = [np.zeros(0)]
            for piece in bw.pieces(batch.column("_text")):
                text, bucket = word_sets(piece, weights != 0)
                scores.append(_sigmoid(np.bincount(text, weights[bucket], len(piece.ends) - 1) + bias)
                              if np.isfinite(bias) else np.zeros(len(piece.ends) - 1))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(np.concatenate(scores))],
                                             names=[*kept, "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).cast("string").alias("_text"))
    types = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*[f"`{c}` {types[c]}" for c in kept], "score double"]))
