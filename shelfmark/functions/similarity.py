"""String similarity for fuzzy name matching.

Edit-based ratios are native expressions built on ``levenshtein``.  Jaro-Winkler
has no built-in, so it is an Arrow-batched pandas UDF; it is only ever applied
to candidate pairs produced by a token join, never to a cross product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.util import as_col


def preprocess(c) -> Column:
    """Lower-case, every non-word character -> blank, strip (ASCII and
    Unicode letters and digits are word characters)."""
    return F.trim(F.lower(F.regexp_replace(as_col(c), r"(?U)\W", " ")))


def tokens(c) -> Column:
    """Blank-separated tokens of a preprocessed string, empty tokens dropped."""
    return F.filter(F.split(as_col(c), " +"), lambda t: t != "")


def edit_ratio(a, b) -> Column:
    """0..100: ``100 * (1 - levenshtein / longer length)``, rounded; two empty
    strings score 100."""
    a, b = as_col(a), as_col(b)
    longest = F.greatest(F.length(a), F.length(b))
    return (F.when(longest == 0, F.lit(100))
            .otherwise(F.round(F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b) / longest)).cast("int")))


def token_sort_ratio(a, b) -> Column:
    def key(x):
        return F.array_join(F.array_sort(tokens(x)), " ")

    return edit_ratio(key(a), key(b))


def token_set_ratio(a, b) -> Column:
    """Ratio of the shared-token core against each side's extension."""
    ta, tb = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    inter = F.array_join(F.array_sort(F.array_intersect(ta, tb)), " ")
    only_a = F.array_join(F.array_sort(F.array_except(ta, tb)), " ")
    only_b = F.array_join(F.array_sort(F.array_except(tb, ta)), " ")
    t1 = F.trim(F.concat_ws(" ", inter, only_a))
    t2 = F.trim(F.concat_ws(" ", inter, only_b))
    return F.greatest(edit_ratio(inter, t1), edit_ratio(inter, t2), edit_ratio(t1, t2))


def best_ratio(a, b) -> Column:
    """M2 default score: best of plain, token-sort and token-set ratio on
    preprocessed text."""
    pa, pb = preprocess(a), preprocess(b)
    return F.greatest(edit_ratio(pa, pb), token_sort_ratio(pa, pb), token_set_ratio(pa, pb))


def _codes(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(n, longest) code points, 0 where a text has ended, and the lengths."""
    size = texts.str.len().to_numpy(dtype=np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    out = np.zeros((len(texts), max(int(size.max(initial=0)), 1)), dtype=np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def jaro_winkler_scores(a: pd.Series, b: pd.Series, prefix_weight: float = 0.1) -> np.ndarray:
    """Jaro-Winkler of each pair of texts; the loop is over character places, not over pairs."""
    (x, nx), (y, ny) = _codes(a), _codes(b)
    n, wide = len(x), y.shape[1]
    window = np.maximum(np.maximum(nx, ny) // 2 - 1, 0)
    place = np.arange(wide)
    used = np.zeros(y.shape, dtype=bool)
    took = np.zeros(x.shape, dtype=bool)
    rows = np.arange(n)
    for i in range(x.shape[1]):
        near = (np.abs(place - i) <= window[:, None]) & (place < ny[:, None]) & (i < nx)[:, None]
        free = near & ~used & (y == x[:, i:i + 1])
        hit = free.any(axis=1)
        used[rows[hit], free[hit].argmax(axis=1)] = True
        took[hit, i] = True
    m = took.sum(axis=1)
    # the k-th matched character of either side, next to each other: both lists have the same lengths
    differ = x[took] != y[used]
    swaps = np.bincount(np.repeat(rows, m), differ, n).astype(np.int64) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (m / nx + m / ny + (m - swaps) / m) / 3.0
    jaro = np.where(m == 0, 0.0, jaro)
    width = min(4, x.shape[1], wide)
    same = (x[:, :width] == y[:, :width]) & (x[:, :width] != 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    score = np.where(jaro > 0.7, jaro + prefix * prefix_weight * (1.0 - jaro), jaro)
    return np.where((a == b).to_numpy(), 1.0, score)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity 0..1 (prefix weight 0.1, up to 4 characters,
    boost only above 0.7); NULL where either text is."""
    known = (a.notna() & b.notna()).to_numpy()
    out = pd.Series(np.nan, index=a.index, dtype="float64").astype(object).where(known, None)
    if known.any():
        out[known] = jaro_winkler_scores(a[known].reset_index(drop=True), b[known].reset_index(drop=True))
    return out.astype("Float64")
