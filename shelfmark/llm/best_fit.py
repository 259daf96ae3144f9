"""Operator 12: bounded-space online best-fit packing of whole documents.

A document of at most ``length`` ids is one piece; a longer one is cut into
pieces of ``length``, the first of which may be shorter.  Pieces are dealt at random into
groups of about GROUP.  In a group they arrive longest first, one at a time,
at a packer that keeps at most OPEN_BINS bins: a bitset has bit f set while a
bin with f free ids is open, so the fullest bin with room is the lowest bit from
the piece's length on.  A full bin closes; where a new bin would be one
too many, the fullest one closes first.

The bins still open when a group ends close if at most a hundredth of them is
free.  The pieces of the others go to the next level, where FAN groups meet in
one, until a single group is left; so the number of groups, and hence of tasks,
costs next to no padding.  Every group holds a bounded number of short rows (no texts), each level
is a written table, and a group's result depends on its rows only.

Ids are those of operator 6's ``encoder``, then END_ID.

Defined cases: null and empty texts are the single end id; repeated rows are
packed once each; ids of any type are given back, null as null; an empty table gives
no rows; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from shelfmark.llm.frames import written
from shelfmark.llm.packing import END_ID, encoder

LENGTH = 2048
OPEN_BINS = 1024
GROUP = 4096
FAN = 16

_PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
_PLACE = [("sequence_id", T.LongType()), ("offset", T.LongType())]


def cut(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids."""
    if total <= length:
        return [(0, total)]
    first = total % length
    starts = [0] * (first > 0) + list(range(first, total, length))
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], total])]))


def _cutter(path: str, length: int) -> Callable:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            source, rows = [], []
            for k, text in enumerate(batch.column("_text")):
                text = text.as_py()
                ids = np.concatenate([np.array(ids_of(text), "<u4"), end]) if text else end
                for n, (start, size) in enumerate(cut(len(ids), length)):
                    source.append(k)
                    rows.append((n, start, size, zlib.crc32(ids[start:start + size].tobytes())))
            columns = list(zip(*rows)) or [[]] * 4
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc").take(at), batch.column("_row").take(at),
                 *(pa.array(c, pa.int32() if name == "piece" else pa.int64()) for c, (name, _) in zip(columns, _PIECE))],
                names=["_doc", "_row", *(name for name, _ in _PIECE)])
    return pieces


def best_fit(sizes: list[int], length: int, open_bins: int) -> tuple[list[list[int]], list[list[int]]]:
    """Bins (lists of places in ``sizes``, which arrive in order): those closed
    on the way, and those open at the end."""
    closed: list[list[int]] = []
    by_free: dict[int, list[list[int]]] = {}
    bits = n_open = 0

    def taken(free: int) -> list[int]:
        nonlocal bits
        bins = by_free[free]
        out = bins.pop()
        if not bins:
            bits ^= 1 << free
        return out

    for k, size in enumerate(sizes):
        fits = bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            chosen = taken(free)
        else:
            if n_open == open_bins:
                closed.append(taken((bits & -bits).bit_length() - 1))
                n_open -= 1
            chosen, free, n_open = [], length, n_open + 1
        chosen.append(k)
        free -= size
        if free:
            by_free.setdefault(free, []).append(chosen)
            bits |= 1 << free
        else:
            closed.append(chosen)
            n_open -= 1
    return closed, [b for bins in by_free.values() for b in bins]


def _packer(length: int, open_bins: int, level: int, last: bool) -> Callable:
    def pack(group: pa.Table) -> pa.Table:
        order = pc.sort_indices(group, [("length", "descending"), ("_row", "ascending"), ("piece", "ascending")])
        group = group.take(order)
        sizes = group.column("length").to_pylist()
        closed, rest = best_fit(sizes, length, open_bins)
        for b in rest:
            if last or length - sum(sizes[k] for k in b) <= length // 100:
                closed.append(b)
        sequence, offset = [None] * len(sizes), [None] * len(sizes)
        first = level << 58 | group.column("_g")[0].as_py() << 22
        for n, b in enumerate(closed):
            at = 0
            for k in b:
                sequence[k], offset[k] = first + n, at
                at += sizes[k]
        for name, values in zip(("sequence_id", "offset"), (sequence, offset)):
            group = group.set_column(group.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return group
    return pack


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, open_bins: int = OPEN_BINS, group: int = GROUP,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: <id_col>, piece, start, length, ids_crc32 (the piece), sequence_id, offset (its place)."""
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"),
                       F.monotonically_increasing_id().alias("_row"))
    schema = T.StructType([T.StructField("_doc", rows.schema["_doc"].dataType), T.StructField("_row", T.LongType()),
                           *(T.StructField(n, t) for n, t in _PIECE)])
    pieces = written(rows.mapInArrow(_cutter(tokenizer_path, length), schema), "pieces")
    groups = max(1, math.ceil(pieces.count() / group))
    waiting = pieces.withColumn("_g", F.pmod(F.xxhash64("_row", "piece"), F.lit(groups)))
    waiting = waiting.withColumns({n: F.lit(None).cast(t) for n, t in _PLACE})
    packed, level = None, 0
    while True:
        out = written(waiting.groupBy("_g").applyInArrow(_packer(length, open_bins, level, groups == 1), waiting.schema), "packed")
        done = out.where("sequence_id IS NOT NULL")
        packed = done if packed is None else packed.unionByName(done)
        if groups == 1:
            break
        level, groups = level + 1, math.ceil(groups / FAN)
        waiting = out.where("sequence_id IS NULL").withColumn("_g", F.floor(F.col("_g") / FAN))
    return packed.select(F.col("_doc").alias(id_col), *(n for n, _ in _PIECE), *(n for n, _ in _PLACE))
