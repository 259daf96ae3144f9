"""Operator 1: hierarchical language identification.

A text's features are the frequencies of its hashed byte pairs and triples.
A linear one-versus-rest classifier predicts the language family; within the family,
linear support vector machines (squared hinge), one for each pair of its
languages, vote, and the language of the largest summed margin wins.  Languages
of no listed family form one of their own.

Training rows are a bounded sample: at most TRAIN_ROWS in all and an equal
bound per language, chosen by text hash.  Only their feature counts reach the
driver (at most DIM numbers a row).  Prediction reads every whole text in Arrow batches, without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null languages are not learned from; without any learnable row all texts are
``und``; repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfmark.llm import byte_words as bw
from shelfmark.llm.frames import own_columns

DIM = 8192
TRAIN_ROWS = 2000
UNKNOWN = "und"

#: Language families by two-letter code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "indo-aryan": ("hi", "bn", "mr", "pa", "gu", "ur", "ne"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "semitic": ("ar", "he", "am", "mt"),
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang.lower().split("-")[0] in langs), lang)


def gram_buckets(piece: bw.Piece) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, first): hashed pairs and triples that lie inside one text."""
    data = bw._FOLD[piece.data].astype(np.uint32)
    n = len(data)
    end = np.repeat(piece.ends[1:], np.diff(piece.ends))
    at = np.arange(n)
    out, text = [], []
    code = data.copy()
    for size, salt in ((2, 0x85EBCA6B), (3, 0xC2B2AE35)):
        if n < size:
            continue
        code = code[:n - size + 1] * np.uint32(257) + data[size - 1:]
        inside = at[:n - size + 1] + size <= end[:n - size + 1]
        out.append(((code * np.uint32(2654435761) + np.uint32(salt)) >> np.uint32(19))[inside])
        text.append(np.searchsorted(piece.ends, at[:n - size + 1][inside], "right") - 1 if len(piece.ends) > 2 else
                    np.zeros(int(inside.sum()), np.int64))
    buckets = np.concatenate(out) if out else np.zeros(0, np.uint32)
    rows = np.concatenate(text) if text else np.zeros(0, np.int64)
    return buckets.astype(np.int64), rows


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None  # (families, DIM + 1)
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, list[tuple[int, int, np.ndarray]]] = field(default_factory=dict)


def svm(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Weights (last one the bias) of a squared-hinge linear classifier, y in {-1, 1}."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    v, rate = w.copy(), 0.5 / max(float((x * x).sum(axis=1).mean()), 1e-9)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        step = v - rate * (decay * v - 2 * x.T @ (weight * y * slack))
        v, w = step + (t / (t + 3)) * (step - w), step
    return w


def fit(langs: list[str], counts: np.ndarray) -> Model:
    """``counts``: gram counts, one row a text."""
    if not langs:
        return Model()
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    scale = 1 / np.sqrt(share.mean(axis=0) + 1e-4)
    x = np.concatenate([share * scale, np.ones((len(share), 1))], axis=1).astype(np.float32)
    unscale = np.concatenate([scale, [1.0]])
    lang, family = np.array(langs), np.array([family_of(s) for s in langs])
    model = Model(families=sorted(set(family)))
    model.family_weights = np.stack([svm(x, np.where(family == f, 1, -1).astype(np.float32)) * unscale for f in model.families])
    for f in model.families:
        names = sorted(set(lang[family == f]))
        model.languages[f] = names
        model.pairs[f] = []
        for i, j in combinations(range(len(names)), 2):
            rows = (lang == names[i]) | (lang == names[j])
            model.pairs[f].append((i, j, svm(x[rows], np.where(lang[rows] == names[i], 1, -1).astype(np.float32)) * unscale))
    return model


def _margin(weights: np.ndarray, buckets: np.ndarray, rows: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return np.bincount(rows, weights[buckets], n) / total + weights[DIM]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def predict(model: Model, piece: bw.Piece) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of every text of a piece."""
    n = len(piece.ends) - 1
    names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
    if not model.families:
        return names, scores
    buckets, rows = gram_buckets(piece)
    total = np.maximum(np.bincount(rows, minlength=n), 1)
    margins = np.stack([_margin(w, buckets, rows, n, total) for w in model.family_weights])
    family = margins.argmax(axis=0)
    for f, name in enumerate(model.families):
        texts = np.flatnonzero(family == f)
        if not len(texts):
            continue
        langs = model.languages[name]
        votes = np.zeros((len(langs), n))
        mine = (family == f)[rows]
        for i, j, w in model.pairs[name]:
            m = np.tanh(_margin(w, buckets[mine], rows[mine], n, total))
            votes[i] += m
            votes[j] -= m
        best = votes.argmax(axis=0)[texts]
        names[texts] = np.array(langs, object)[best]
        inner = _sigmoid(4 * votes.max(axis=0)[texts] / max(len(langs) - 1, 1)) if len(langs) > 1 else 1.0
        scores[texts] = _sigmoid(4 * margins[f, texts]) * inner
    return names, scores


# ---- Spark -------------------------------------------------------------------

def training_sample(docs: DataFrame, learn: Column, lang_col: str, text_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` rows (lang, _text), as even over languages as their numbers of different texts allow; none is there twice."""
    usable = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("_text")).withColumn("_h", F.xxhash64("_text"))
    sizes = usable.select("lang", "_h").distinct().groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()
    cap = max(1, rows // max(len(sizes), 1))
    fraction = F.lit(0.0)
    for r in sizes:
        fraction = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, (1.3 * cap + 30) / r["count"]))).otherwise(fraction)
    drawn = usable.where(F.pmod("_h", F.lit(1_000_003)) < fraction * 1_000_003).groupBy("lang", "_h").agg(F.min("_text").alias("_text"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("_h", "_text"))
    return drawn.withColumn("_r", rank).where(F.col("_r") <= cap).select("lang", "_text")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in bw.pieces(batch.column("_text")):
            buckets, rows = gram_buckets(piece)
            n = len(piece.ends) - 1
            cells, counts = np.unique(rows * DIM + buckets, return_counts=True)
            ends = np.searchsorted(cells, np.arange(n + 1) * DIM).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("lang")[piece.rows], pa.ListArray.from_arrays(ends, pa.array((cells % DIM).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))], names=["lang", "buckets", "counts"])


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text") -> Model:
    found = (training_sample(docs, learn, lang_col, text_col)
             .mapInArrow(_counted, "lang string, buckets array<int>, counts array<int>").toArrow())
    dense = np.zeros((found.num_rows, DIM), np.float32)
    for k, (b, c) in enumerate(zip(found["buckets"], found["counts"])):
        dense[k, b.values.to_numpy()] = c.values.to_numpy()
    return fit(found["lang"].to_pylist(), dense)


@own_columns
def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``lang_pred`` and ``score``."""
    kept = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            names, scores = [], []
            for piece in bw.pieces(texts):
                n, s = predict(model, piece)
                letter = np.concatenate([[0], np.cumsum(bw.LETTERS[piece.data] & (piece.data >= 65) & (piece.data < 128))])
                plain = letter[piece.ends[1:]] > letter[piece.ends[:-1]]
                for k in np.flatnonzero(~plain):
                    if not has_letter(texts[piece.rows.start + int(k)].as_py()):
                        n[k], s[k] = UNKNOWN, 0.0
                names.extend(n)
                scores.extend(s)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept, "lang_pred", "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).cast("string").alias("_text"))
    types = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    return rows.mapInArrow(run, f"{schema}{', ' if schema else ''}lang_pred string, score double")
