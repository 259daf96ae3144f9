"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes that are not white space, A-Z folded, and is named by
a 64-bit hash: its blocks of eight bytes are each mixed with their place in the
word, summed, and mixed with the length (most words are one block).  Texts are taken in
pieces of about ``PIECE_BYTES`` so that working arrays stay small; a text is
never cut, so a longer one is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 400_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of words where punctuation also separates: letters, digits, and all of other scripts.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs data[start:end] (none empty)."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block_at = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    total = mix(mix(block_at[start] & _FIRST_BYTES[np.minimum(size, 8)]) ^ _STEP)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8
        first = np.cumsum(more) - more
        place = np.arange(more.sum()) - np.repeat(first, more) + 1
        at = np.repeat(start[long], more) + 8 * place
        block = block_at[at] & _FIRST_BYTES[np.minimum(np.repeat(end[long], more) - at, 8)]
        total[long] += np.add.reduceat(mix(mix(block) ^ mix((place + 1).astype(np.uint64) * _STEP)), first)
    return mix(total + size.astype(np.uint64))


@dataclass
class Piece:
    """Some neighbouring texts: ``rows`` are their places in the batch,
    ``data`` their bytes and ``ends`` where each text starts and ends."""
    rows: slice
    data: np.ndarray
    ends: np.ndarray


def pieces(texts: pa.Array) -> Iterator[Piece]:
    """Null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE_BYTES, "right")) - 1)
        yield Piece(slice(row, stop), data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row])
        row = stop


def folded_latin(data: np.ndarray) -> np.ndarray:
    """The bytes with the accented capitals of Latin-1 (two bytes each) made small."""
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return np.where(capital, data + np.uint8(32), data)


@dataclass
class Words:
    """Hashes of all words of a piece, in order; ``first`` (one more entry than
    texts) says where each text's words start.  ``start`` and ``end`` are byte places."""
    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    folded: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def words(piece: Piece, inside: np.ndarray | None = None) -> Words:
    """``inside`` marks the bytes of words; by default all but white space."""
    folded = _FOLD[piece.data]
    solid = ~_WHITE[folded] if inside is None else inside[folded]
    n = len(folded)
    head = np.empty(n, bool)
    tail = np.empty(n, bool)
    if n:
        head[0], tail[-1] = solid[0], solid[-1]
        head[1:] = solid[1:] & ~solid[:-1]
        tail[:-1] = solid[:-1] & ~solid[1:]
        inner = piece.ends[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        head[inner] = solid[inner]
        tail[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    hashes = run_hashes(folded, start, end)
    return Words(hashes, np.searchsorted(start, piece.ends), start, end, folded)


_PLACE = seeds(64, 99)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): all k-word runs of each text; a text of fewer words,
    but some, gives its whole sequence."""
    n = len(w.hashes)
    count = w.counts()
    whole = np.zeros(n, np.uint64)
    last = max(n - k + 1, 0)
    for j in range(k):
        if last:
            whole[:last] += mix(w.hashes[j:j + last] * _PLACE[j])
    size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(w.first[:-1] - first[:-1], size) + np.arange(first[-1])
    out = mix(whole[at] + np.uint64(k))
    for t in np.flatnonzero((count > 0) & (count < k)):
        c = int(count[t])
        part = mix(w.hashes[w.first[t]:w.first[t] + c] * _PLACE[:c])
        out[first[t]] = mix(part.sum(dtype=np.uint64, keepdims=True) + np.uint64(c))[0]
    return out, first


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[t]:first[t + 1]], zero where that is empty."""
    running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return running[first[1:]] - running[first[:-1]]
