"""Operator 10: licence scans by patience alignment.

A licence notice is found in a text by aligning words: anchors are the words
that occur once in both sides; the longest increasing run of anchors is kept, the
gaps between neighbouring anchors are aligned in the same way, and ends that
match word by word are added.  A gap without anchors is aligned by its longest common subsequence.  Coverage is the
share of the notice's words that are aligned.

A place of a notice is a stretch of the text of at most SPREAD times the notice's
length whose alignment covers at least MIN_COVERAGE.  Stretches are proposed by a bound: they start at an
occurrence of one of the notice's first words, wherever it stands, and end where
the longest common subsequence with the notice (counted bit-parallel), which no alignment exceeds, stops growing; so words put between those of the
notice neither cut it nor change its coverage.  The stretch of the highest bound is aligned first (then of
fewer words spanned, then the earlier one), and the text on both sides of a place is searched on.

Every notice is returned at every place; of overlapping ones the best decides.  VERSIONS
names the other versions of each family, since a notice of another version can reach MIN_COVERAGE too.

Bounds leave out work and no place: a share MIN_COVERAGE of the notice's words must occur in the text, so
one of its rarest words does; a place begins with a word that leaves enough of the notice; and a window gains at most the notice's
words that enter it.  Work is per row (Arrow batches), without a shuffle.

Defined cases: null, empty and licence-free texts give a null licence and coverage 0;
of equal coverages the longer notice and then the smaller name wins; repeated rows are scanned alike;
a notice whose words stand further apart than SPREAD allows is not counted as that notice.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MIN_COVERAGE = 0.8
SPREAD = 3  # a place has at most so many times the notice's words

#: Public licence notices, by a short name.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _gnu(what: str, licence: str, version: str, later: bool = True) -> str:
    version += "" if version == "1" else " of the License"
    return (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} "
            "as published by the Free Software Foundation, " +
            (f"either version {version}, or (at your option) any later version." if later else f"version {version}."))


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
       "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_CC_FORM = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}

#: The other versions of these families, so that the best one decides.
VERSIONS = {
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": _gnu("program", _AGPL, "3"),
    "agpl-3.0-only-header": _gnu("program", _AGPL, "3", later=False),
    **{f"apache-{v}": f"Licensed under the Apache License, Version {v}." for v in ("1.0", "1.1")},
    "apache-1.1-software": "Licensed under the Apache Software License, Version 1.1.",
    "apache-released": "Released under the Apache License.",
    "bsd-3-clause-text": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                         "products derived from this software without specific prior written permission",
    "bsd-4-clause-text": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    **{f"bsd-{n}-clause": f"Released under the BSD {n}-Clause License." for n in (2, 3, 4)},
    "bsd-released": "Released under the BSD License.",
    "cc0-1.0": "Licensed under CC0 1.0.",
    "cc0-1.0-text": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    **{f"cc-{k}-{v}-short": f"Licensed under CC {k.upper()} {v}." for k in _CC for v in _CC_FORM if (k, v) not in {("by-nc", "4.0"), ("by-sa", "4.0")}},
    **{f"cc-{k}-{v}-text": f"This work is licensed under a Creative Commons {name if v == '4.0' else name.replace('Derivatives', 'Derivs')} {v} {form} License."
       for k, name in _CC.items() for v, form in _CC_FORM.items() if (k, v) != ("by", "4.0")},
    **{f"gpl-{v}": f"This work is licensed under the GNU General Public License, version {v[0]}." for v in ("1.0", "2.0")},
    **{f"gpl-{v}-header": _gnu("program", _GPL, v[0]) for v in ("1.0", "2.0")},
    **{f"gpl-{v}-only-header": _gnu("program", _GPL, v[0], later=False) for v in ("1.0", "2.0", "3.0")},
    "isc-released": "Released under the ISC License.",
    **{f"lgpl-{v}": f"This work is licensed under the GNU Lesser General Public License, version {n}." for v, n in (("2.1", "2.1"), ("3.0", "3"))},
    "lgpl-2.0": "This work is licensed under the GNU Library General Public License, version 2.",
    "lgpl-2.0-header": _gnu("library", "Library General Public License", "2"),
    "lgpl-2.0-only-header": _gnu("library", "Library General Public License", "2", later=False),
    **{f"lgpl-{v}-header": _gnu("library", _LGPL, n) for v, n in (("2.1", "2.1"), ("3.0", "3"))},
    **{f"lgpl-{v}-only-header": _gnu("library", _LGPL, n, later=False) for v, n in (("2.1", "2.1"), ("3.0", "3"))},
    **{f"mpl-{v}": f"The contents of this file are subject to the Mozilla Public License Version {v} (the \"License\"); you may not use "
                   "this file except in compliance with the License." for v in ("1.0", "1.1")},
}

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by their first) whose seconds increase."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before.append(ends[pile - 1] if pile else -1)
        tops[pile:pile + 1] = [b]
        ends[pile:pile + 1] = [k]
    run = []
    k = ends[-1] if ends else -1
    while k >= 0:
        run.append(pairs[k])
        k = before[k]
    return run[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence, as pairs."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Increasing pairs (i, j) with a[i] == b[j] by patience alignment."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        if not anchors:
            out.extend((a0 + i, b0 + j) for i, j in _common(a[a0:a1], b[b0:b1]))
            continue
        out.extend(anchors)
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        work.extend((p + 1, i, q + 1, j) for (p, q), (i, j) in zip(edges, edges[1:]))
    return sorted(out)


def _needed(m: int, min_coverage: float) -> int:
    return next((k for k in range(1, m + 1) if k / m >= min_coverage), m + 1)


def places(words: list[str], notice: list[str], min_coverage: float = MIN_COVERAGE, spread: float = SPREAD):
    """[(coverage, first word, words spanned)] of all places of the notice that do not overlap, in the order of the text."""
    m = len(notice)
    need = _needed(m, min_coverage)
    masks = {w: sum(1 << i for i, v in enumerate(notice) if v == w) for w in set(notice)}
    heads = set(notice[:m - need + 1])  # the first aligned word leaves ``need`` words from it on
    at = [i for i, w in enumerate(words) if w in masks]
    bits = [masks[words[i]] for i in at]
    full, width = (1 << m) - 1, max(m, int(spread * m))

    def longest(k: int, stop: int) -> tuple[int, int]:
        """(words in common, place after the last of them) of the stretch from at[k], below at[stop]."""
        free, length, end = full, 0, at[k]
        for j in range(k, stop):
            hit = free & bits[j]
            if hit:
                free = ((free + hit) | (free - hit)) & full
                now = m - free.bit_count()
                if now > length:
                    length, end = now, at[j] + 1
                    if now == m:
                        break
        return length, end

    heap, limit, seen = [], 0, 0  # limit: no more words in common than this, for a window that ends at hit ``seen``
    stop = 0
    for k, start in enumerate(at):
        while stop < len(at) and at[stop] < start + width:
            stop += 1
        if words[start] not in heads or stop - k < need or seen and limit + stop - seen < need:
            continue
        limit, end = longest(k, stop)
        seen = stop
        if limit >= need:
            heap.append((-limit, end - start, start, k))
    heapify(heap)
    taken: list[tuple[int, int, int]] = []  # (first word, place after the last, words aligned), sorted
    while heap:
        _, span, start, k = heappop(heap)
        after = bisect_left(taken, (start + 1,))
        if after and taken[after - 1][1] > start:
            continue
        if after < len(taken) and taken[after][0] < start + span:
            length, end = longest(k, bisect_left(at, taken[after][0]))
            if length >= need:
                heappush(heap, (-length, end - start, start, k))
            continue
        pairs = aligned(words[start:start + span], notice)
        if len(pairs) < need:
            continue
        taken.insert(after, (start + pairs[0][0], start + pairs[-1][0] + 1, len(pairs)))
    return [(n / m, start, end - start) for start, end, n in taken]


def _by_key(notices: dict[str, list[str]], min_coverage: float) -> dict[str, list[str]]:
    """Names by the words of which a text with the notice must hold one: the rarest, one more than may be missing."""
    shared = Counter(w for notice in notices.values() for w in set(notice))
    out: dict[str, list[str]] = {}
    for name, notice in notices.items():
        may_miss = len(notice) - _needed(len(notice), min_coverage)
        for word, n in sorted(Counter(notice).items(), key=lambda x: (shared[x[0]], -len(x[0]), x[0])):
            out.setdefault(word, []).append(name)
            may_miss -= n
            if may_miss < 0:
                break
    return out


def matches(text: str, notices: dict[str, list[str]], min_coverage: float = MIN_COVERAGE, by_key: dict[str, list[str]] | None = None,
            spread: float = SPREAD):
    """[(name, coverage, first word, words spanned, decides)] of all notices at all their places, the best first.

    ``decides`` marks those that overlap no better one that decides.
    """
    by_key = _by_key(notices, min_coverage) if by_key is None else by_key
    words = words_of(text)
    known = set(words)
    found = []
    for name in {name for w in by_key.keys() & known for name in by_key[w]}:
        notice = notices[name]
        if sum(w in known for w in notice) >= _needed(len(notice), min_coverage):
            found += [(-coverage, -len(notice), name, first, span) for coverage, first, span in places(words, notice, min_coverage, spread)]
    out, won = [], []  # won: (first word, place after the last) of those that decide, sorted
    for coverage, _, name, first, span in sorted(found):
        after = bisect_left(won, (first + span,))
        decides = not after or won[after - 1][1] <= first
        if decides:
            won.insert(after, (first, first + span))
        out.append((name, -coverage, first, span, decides))
    return out


def best_match(text: str, notices: dict[str, list[str]], min_coverage: float = MIN_COVERAGE):
    """(name, coverage, first word, words spanned) of the best notice, or None."""
    found = matches(text, notices, min_coverage)
    return found[0][:4] if found else None


_MATCH = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("n_words_spanned", pa.int64()),
                    ("decides", pa.bool_())])


def scan(docs: DataFrame, notices: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE,
         id_col: str = "doc_id", text_col: str = "text", spread: float = SPREAD) -> DataFrame:
    """(<id_col>, license, coverage, first_word, n_words_spanned, matches), one row per input row.

    ``matches`` holds every notice at every place whose coverage reaches the bound, the best first; the columns before it are its first entry.
    """
    split = {name: words_of(text) for name, text in sorted((notices or NOTICES | VERSIONS).items()) if words_of(text)}
    by_key = _by_key(split, min_coverage)
    fields = _MATCH.names

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matches(t.as_py(), split, min_coverage, by_key, spread) if t.is_valid else [] for t in batch.column("_text")]
            best = [f[0][:4] if f else (None, 0.0, None, None) for f in found]
            name, coverage, first, span = zip(*best) if best else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(name, pa.string()), pa.array(coverage, pa.float64()),
                 pa.array(first, pa.int64()), pa.array(span, pa.int64()),
                 pa.array([[dict(zip(fields, m)) for m in f] for f in found], pa.list_(_MATCH))],
                names=[id_col, "license", "coverage", "first_word", "n_words_spanned", "matches"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(look, f"`{id_col}` {kind}, license string, coverage double, first_word bigint, n_words_spanned bigint, "
                           "matches array<struct<license:string,coverage:double,first_word:bigint,n_words_spanned:bigint,decides:boolean>>")
