"""Operator 6: sequence packing in space-filling-curve order.

A document's hashed word vector is projected to DIMS dimensions by random
signs (bits of the word hashes), each coordinate is spread over BITS bits, and
the Hilbert index of the point is the sort key.  Rows are range-partitioned and
sorted by that key; each task then tokenizes its rows in order and
lays the ids end to end, cutting a sequence at every ``length`` ids, so
neighbours on the curve share sequences.  A task's last, incomplete sequence is cut into
powers of two, which need no padding.  Tasks stream: one batch of texts and one
open sequence are in memory.  The sort order is total, so a task that is run
again after a loss gives the same sequences.

Ids are those of the tokenizer file (its special tokens are recognised in
texts, none is added); they are looked up with the same vocabulary as ranks,
which gives the same ids faster; a test compares the two.

Defined cases: null and empty texts are the single end id; repeated rows are
packed once each; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm import byte_words as bw
from shelfmark.llm.frames import identified, shuffle_partitions

LENGTH = 1024
END_ID = 0
DIMS, BITS = 4, 15

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, hilbert bigint")


# ---- tokenizer ---------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids for a byte-level BPE tokenizer file."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    coder = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        if any(s in text for s in special):
            return coder.encode(text, allowed_special="all")
        return coder.encode_ordinary(text)
    return ids


# ---- curve -------------------------------------------------------------------

def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of integer points (n, dims), each coordinate below 2^bits."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations from the coarsest level down
        low = bit - 1
        for d in range(dims):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(on, low, swap)
            x[d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[dims - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> b) & 1)
    return out


def curve_keys(texts: pa.Array) -> np.ndarray:
    """Hilbert key of every text: mean word vector, DIMS random signs a word."""
    keys = []
    for piece in bw.pieces(texts):
        w = bw.words(piece)
        n = np.maximum(w.counts(), 1)
        point = np.empty((len(n), DIMS))
        for d in range(DIMS):
            sign = ((w.hashes >> np.uint64(7 + 11 * d)) & np.uint64(1)).astype(np.int64) * 2 - 1
            mean = bw.segment_sums(sign, w.first) / n
            point[:, d] = 0.5 + 0.5 * np.tanh(4 * mean)
        keys.append(hilbert_index(np.minimum(point * (1 << BITS), (1 << BITS) - 1), BITS))
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("_key", pa.array(curve_keys(batch.column("_text")), pa.int64()))


# ---- packing -----------------------------------------------------------------

class _Open:
    """The sequence being filled, and the rows of those that are done."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.parts: list[tuple] = []  # (doc_id, start, ids, doc_tokens, key)
        self.filled = 0
        self.done: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray, key: int) -> None:
        at = 0
        while at < len(ids):
            take = min(self.length - self.filled, len(ids) - at)
            self.parts.append((doc_id, at, ids[at:at + take], len(ids), key))
            at, self.filled = at + take, self.filled + take
            if self.filled == self.length:
                self.close([self.length])

    def close(self, sizes: list[int]) -> None:
        """Write the open parts as sequences of the given sizes."""
        parts = iter(self.parts)
        left: tuple | None = None
        for size in sizes:
            offset = 0
            while offset < size:
                doc_id, start, ids, total, key = left or next(parts)
                head, rest = ids[:size - offset], ids[size - offset:]
                self.done.append((doc_id, start, len(head), zlib.crc32(head.tobytes()), total, self.sequence, offset, key))
                offset += len(head)
                left = (doc_id, start + len(head), rest, total, key) if len(rest) else None
            self.sequence += 1
        self.parts, self.filled = [], 0

    def finish(self) -> None:
        self.close([1 << b for b in range(self.filled.bit_length() - 1, -1, -1) if self.filled >> b & 1])

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.done)) or [[]] * 8
        self.done = []
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _packer(path: str, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        end = np.array([END_ID], "<u4")
        state = _Open(length, TaskContext.get().partitionId() << 33)
        for batch in batches:
            texts, keys, docs = batch.column("_text"), batch.column("_key").to_pylist(), batch.column("doc_id").to_pylist()
            for k, doc_id in enumerate(docs):
                text = texts[k].as_py()
                ids = np.concatenate([np.array(ids_of(text), "<u4"), end]) if text else end
                state.add(doc_id, ids, keys[k])
                if len(state.done) >= 20_000:
                    yield state.taken()
            yield state.taken()
        state.finish()
        yield state.taken()
    return pack


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece (see PIECES): ``start`` and ``length`` in the
    document's ids, ``sequence_id`` and ``offset`` where it lies."""
    rows = identified(docs.withColumnRenamed(id_col, "doc_id"), "doc_id", text_col)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "_id", "_th", "_text")
    keyed = rows.mapInArrow(_keyed, "doc_id bigint, _id bigint, _th bigint, _text string, _key bigint")
    order = ["_key", "_id", "_th"]
    return (keyed.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
            .select("doc_id", "_text", "_key").mapInArrow(_packer(tokenizer_path, length), PIECES))


def unpacked(pieces: DataFrame) -> DataFrame:
    """Per document: ids counted over its pieces and whether they join without gaps (a check of a packing)."""
    spans = F.array_sort(F.collect_list(F.struct("start", "length")))
    joined = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: F.when(a == x["start"], a + x["length"]).otherwise(F.lit(-1)))
    return pieces.groupBy("doc_id").agg(joined.alias("joined"), F.max("doc_tokens").alias("doc_tokens"))
