"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Templates and texts are read as lower-case runs of ASCII letters and digits.  Of every ``WINDOW`` adjacent
hashed ``GRAM``-word windows the least is a fingerprint, so any shared run of ``GRAM + WINDOW - 1`` words
shares one.  The templates' fingerprints are an inverted index; a text's fingerprints that it knows name a
template and a diagonal.  Diagonals within ``BAND`` of each other are one candidate, which
local alignments in that band turn into matched words and spans, as many as do not overlap: a short line may be
repeated at once.  Findings cover at least
``COVERAGE`` of their template; of overlapping ones the one with most matched words stays.

The index is as large as the given templates and goes to the tasks in the closure; texts are scanned
whole, where they lie, without a shuffle.  Null and empty texts have no findings.  Rows are independent, repeats
included.  Equal templates: the first name in alphabetical order is reported.  A column called ``findings`` is replaced,
other columns are passed on.  Empty tables give empty results.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

GRAM, WINDOW, BAND, COVERAGE = 4, 2, 8, 0.7
MATCH, MISMATCH, GAP = 2, -2, -1

# Notices of public licenses, as they are found in documents.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT-line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_WORD = re.compile("[A-Za-z0-9]+")
_NEVER = np.iinfo(np.int64).max


def winnow(ids: np.ndarray) -> list[tuple[int, int]]:
    """(hash, position) of the fingerprints; windows with an unknown word (0) are never chosen."""
    n = len(ids) - GRAM + 1
    if n < 1:
        return []
    code = np.zeros(n, np.int64)
    known = np.ones(n, bool)
    for k in range(GRAM):
        code = (code * 1_000_003 + ids[k : n + k]) % 2_147_483_647
        known &= ids[k : n + k] > 0
    if not known.any():
        return []
    # scattered, so that the least is a random choice
    code = np.where(known, (code * 48_271) % 2_147_483_647, _NEVER)
    if n < WINDOW:
        return [(int(code[i]), i) for i in np.flatnonzero(known).tolist()]
    view = np.lib.stride_tricks.sliding_window_view(code, WINDOW)
    at = np.unique(np.arange(len(view)) + view.argmin(1))
    return [(int(code[i]), i) for i in at.tolist() if code[i] != _NEVER]


class Index:
    """Templates as word ids, and their fingerprints: hash -> (template, position)."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        texts = [[w.lower() for w in _WORD.findall(templates[n])] for n in self.names]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.words = [np.array([self.ids[w] for w in t], np.int64) for t in texts]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            for code, at in winnow(words):
                self.postings[code].append((t, at))


def align(template: list[int], words: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment within ``band`` of the diagonal word = template + shift.

    (matched words, first word, end word) of ``words``; the earliest of equally good ones.
    """
    best = (0, 0, 0, 0)  # score, matched, first, end
    above: dict[int, tuple[int, int, int]] = {}
    for i, t in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + shift - band), min(len(words), i + shift + band + 1)):
            score, matched, first = above.get(j - 1, (0, 0, j))
            same = words[j] == t
            if score <= 0:
                score, matched, first = 0, 0, j
            cell = (score + (MATCH if same else MISMATCH), matched + same, first)
            for other in (above.get(j), row.get(j - 1)):
                if other and other[0] + GAP > cell[0]:
                    cell = (other[0] + GAP, other[1], other[2])
            if cell[0] > 0:
                row[j] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        above = row
    return best[1:]


def align_all(template: list[int], words: list[int], shift: int, band: int, least: int) -> list[tuple[int, int, int]]:
    """All local alignments in the band of at least ``least`` matched words whose spans do not overlap.

    The best as in `align`, then the best of what lies left and right of it, and so on.  The cells are run
    through word by word, and after a span only as far as alignments from inside it reached:
    no further than three templates.
    """
    size, n = len(template), len(words)
    # of the alignments that end with a word: the best (-score, row, word, matched, first), and the earliest start
    best: list[tuple | None] = [None] * n
    earliest = [n] * n
    taken = bytearray(n)

    def column(j: int, before: dict[int, tuple[int, int, int]]) -> dict[int, tuple[int, int, int]]:
        cells: dict[int, tuple[int, int, int]] = {}
        top, reach = None, n
        for i in range(max(0, j - shift - band), min(size, j - shift + band + 1)):
            score, matched, first = before.get(i - 1, (0, 0, j))
            same = words[j] == template[i]
            cell = (score + (MATCH if same else MISMATCH), matched + same, first)
            for other in (cells.get(i - 1), before.get(i)):
                if other and other[0] + GAP > cell[0]:
                    cell = (other[0] + GAP, other[1], other[2])
            if cell[0] > 0:
                cells[i] = cell
                reach = min(reach, cell[2])
                if cell[1] >= least and (top is None or -cell[0] < top[0]):
                    top = (-cell[0], i, j, cell[1], cell[2])
        best[j], earliest[j] = top, reach
        return cells

    cells: dict[int, tuple[int, int, int]] = {}
    for j in range(n):
        cells = column(j, cells)
    heap = [b for b in best if b]
    heapify(heap)
    found = []
    while heap:
        top = heappop(heap)
        _, _, j, matched, first = top
        if taken[j] or best[j] != top:
            continue
        end = j + 1
        found.append((matched, first, end))
        taken[first:end] = b"\x01" * (end - first)
        cells, j = {}, end
        while j < n and not taken[j] and earliest[j] < end:
            cells = column(j, cells)
            if best[j]:
                heappush(heap, best[j])
            j += 1
    return found


def scan_text(text: str | None, index: Index) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) in code points, end exclusive, by start."""
    if not text:
        return []
    get = index.ids.get
    ids = [get(w.lower(), 0) for w in _WORD.findall(text)]
    seeds = defaultdict(set)
    for code, at in winnow(np.array(ids, np.int64)):
        for template, place in index.postings.get(code, ()):
            seeds[template].add(at - place)
    if not seeds:
        return []
    spots = [m.span() for m in _WORD.finditer(text)]
    found = []
    for template, diagonals in seeds.items():
        words = index.words[template].tolist()
        ordered, start = sorted(diagonals), 0
        for k in range(1, len(ordered) + 1):
            if k < len(ordered) and ordered[k] - ordered[k - 1] <= BAND:
                continue
            low, high = ordered[start], ordered[k - 1]
            start = k
            base = max(0, low - BAND)
            piece = ids[base : high + len(words) + BAND]
            least = next(m for m in range(len(words) + 1) if m / len(words) >= COVERAGE)
            for matched, first, end in align_all(words, piece, (low + high) // 2 - base, BAND + (high - low + 1) // 2, least):
                found.append((-matched, -matched / len(words), template, base + first, base + end))
    # kept spans do not overlap, so only the neighbours of a new one may
    kept: list[tuple] = []
    starts: list[int] = []
    for f in sorted(found):
        at = bisect(starts, f[3])
        if (at == 0 or kept[at - 1][4] <= f[3]) and (at == len(kept) or f[4] <= starts[at]):
            kept.insert(at, f)
            starts.insert(at, f[3])
    return [
        (index.names[t], -coverage, spots[first][0], spots[end - 1][1])
        for _, coverage, t, first, end in kept
    ]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text") -> DataFrame:
    """Add ``findings``, an array of (license, coverage, start, end)."""
    index = Index(TEMPLATES if templates is None else templates)
    fields = [("license", T.StringType()), ("coverage", T.DoubleType()), ("start", T.LongType()), ("end", T.LongType())]
    kind = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields]))
    plain = docs.drop("findings")
    schema = T.StructType([*plain.schema.fields, T.StructField("findings", kind)])
    arrow = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n, _ in fields]
        for batch in batches:
            found = [[dict(zip(names, f)) for f in scan_text(t.as_py(), index)] for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, arrow)], [*batch.schema.names, "findings"])

    return plain.mapInArrow(run, schema)
