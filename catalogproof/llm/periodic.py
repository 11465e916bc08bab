"""Periodic runs of words, found by recompression, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST`` words and three periods long, that
no neighbouring word extends.  ``Grammar`` builds a run-length grammar of many texts at once by recompression: a level
replaces every block of one repeated symbol, the next every pair whose first symbol fell into the left half of
the alphabet and whose second into the right one (halves by a hash of symbol and level), and so on until little shrinks.
A block or pair is named by what it consists of, so equal stretches are parsed alike but for their borders, and the
longest common extension of two places, to the right or to the left, climbs and descends the levels with a step or
two on each.  Names are exact: two symbols are equal only if their words' hashes (64 bits) are.

Candidates stand on a harmonic grid: a run of period p holds, for one multiple i of ``max(LEAST, 3 p) - p``, the places i and
i + p.  There are about n log n / 2 such pairs; those whose words are equal are extended both ways by the grammar,
which gives the run exactly.  A run met from several grid places, or with a multiple of its period, is
reported once, with its smallest period.

Null and blank texts have no words and no runs; ``collapsed`` is then empty.  Rows are independent, repeats included, and nothing is
shuffled.  A text of any length is one grammar, of some hundred bytes a word; short texts share one.  Columns called ``runs`` or
``collapsed`` are replaced.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogproof.llm import words

#: words of a run, and periods, at least
LEAST, PERIODS = 24, 3
#: bytes of text whose words share a grammar; pairs of places looked at together
PORTION, PAIRS = 2 << 20, 1 << 18


class Grammar:
    """Levels of symbols over numbers below 2**30; the first and the last of them occur once and end every extension."""

    def __init__(self, numbers: np.ndarray) -> None:
        #: of each level: symbols, the group (symbol of the next level) of each, the first of each group (one more), are groups blocks?
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]] = []
        s, blocks = numbers.astype(np.int32), True
        names = int(s.max()) + 1
        while True:
            begins = np.ones(len(s), bool)
            if blocks:
                begins[1:] = s[1:] != s[:-1]
            else:
                seed = np.uint64(len(self.levels)) << np.uint64(32)
                left = words.mix(s.astype(np.uint64) + seed) >> np.uint64(63) == 0
                begins[1:] = ~left[:-1] | left[1:]
            first = np.append(np.flatnonzero(begins), len(s)).astype(np.int32)
            self.levels.append((s, (np.cumsum(begins) - 1).astype(np.int32), first, blocks))
            if len(s) == 1:
                break
            size, head = np.diff(first), s[first[:-1]]
            several = np.flatnonzero(size > 1)
            second = size[several] if blocks else s[first[several] + 1]
            kinds, named = np.unique(head[several].astype(np.int64) << 32 | second, return_inverse=True)
            s = head.copy()
            s[several] = names + named
            names, blocks = names + len(kinds), not blocks

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """For each pair of places i < j, how many numbers from there on are equal; with ``back``, how many before.

        A place is climbed with at borders of groups.  Inside a group the symbols must be equal, and as equal symbols stand
        alike in their groups, both reach a border with one step; blocks that have not the same length left end the match.  Going down, each
        level has one symbol, or a part of one block, that still matches.
        """

        def left_over(p: np.ndarray, group: np.ndarray, first: np.ndarray) -> np.ndarray:
            """Symbols of the group from p on, p included (up to p, going back)."""
            g = group[p]
            return p - first[g] + 1 if back else first[g + 1] - p

        way = -1 if back else 1
        x, y, live = i - back, j - back, np.arange(len(i))
        stopped = []
        for s, group, first, blocks in self.levels:
            a, b = left_over(x, group, first), left_over(y, group, first)
            size = np.diff(first)
            whole = (a == size[group[x]]) & (b == size[group[y]])
            step = ~whole & (s[x] == s[y]) & (a == b)
            up = (whole | step) if len(s) > 1 else np.zeros(len(x), bool)
            stopped.append((live[~up], x[~up], y[~up]))
            x, y = x + way * a * step, y + way * b * step
            live, x, y = live[up], group[x[up]], group[y[up]]
            if not len(live):
                break
        live, x, y = (np.zeros(0, np.int64),) * 3
        for level in range(len(stopped) - 1, -1, -1):
            s, group, first, blocks = self.levels[level]
            live, x, y = (np.concatenate([c, d]) for c, d in zip((live, x, y), stopped[level]))
            step = np.minimum(left_over(x, group, first), left_over(y, group, first)) if blocks else 1
            step = np.where(s[x] == s[y], step, 0)
            x, y = x + way * step, y + way * step
            if level:
                below = self.levels[level - 1][2]
                x, y = (below[x + 1] - 1, below[y + 1] - 1) if back else (below[x], below[y])
        out = np.zeros(len(i), np.int64)
        out[live] = way * (x - i[live]) - back
        return out


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place i in it, period p) of the harmonic grid, in slabs of about PAIRS; the run holds i and i + p."""
    texts = np.flatnonzero(sizes >= LEAST)
    most = sizes[texts] // PERIODS
    text = np.repeat(texts, most)
    p = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(LEAST, PERIODS * p) - p
    count = (sizes[text] - p - 1) // step + 1
    upto = np.cumsum(count)
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS)))
        many = count[low:high]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        yield np.repeat(text[low:high], many), nth * np.repeat(step[low:high], many), np.repeat(p[low:high], many)
        low = high


def runs(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period, from the word hashes of texts in a row."""
    none = np.zeros(0, np.int64)
    sizes = np.asarray(sizes, np.int64)
    if not len(hashes) or sizes.max() < LEAST:
        return none, none, none, none
    # a number of its own before, between and after the texts, which ends every extension
    ends = np.cumsum(sizes + 1)
    begin = ends - sizes
    whole = np.full(len(hashes) + len(sizes) + 1, -1, np.int64)
    whole[np.append(0, ends)] = np.arange(len(sizes) + 1) + len(hashes)
    whole[whole < 0] = np.unique(hashes, return_inverse=True)[1]
    grammar, found = None, []
    for text, i, p in _grid(sizes):
        i = i + begin[text]
        alike = np.flatnonzero(whole[i] == whole[i + p])
        if not len(alike):
            continue
        text, i, p = text[alike], i[alike], p[alike]
        grammar = grammar or Grammar(whole)
        behind = grammar.extend(i, i + p, back=True)
        length = behind + grammar.extend(i, i + p) + p
        good = length >= np.maximum(LEAST, PERIODS * p)
        found.append(np.unique(np.stack([text, i - behind - begin[text], length, p], 1)[good], axis=0))
    if not found:
        return none, none, none, none
    rows = np.unique(np.concatenate(found), axis=0)
    fresh = np.ones(len(rows), bool)  # the smallest period of each stretch comes first
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``runs``, an array of (start, length, period) in words by start and period, and ``collapsed``: the words, joined by
    one space, without those that any run holds after its first period."""
    plain = docs.drop("runs", "collapsed").withColumn(text, F.col(text).cast("string"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([*plain.schema.fields, T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.portions(batch, text, PORTION):
                yield _scanned(part, text)

    return plain.mapInArrow(words.returning(scan), schema)


def _scanned(part: pa.RecordBatch, text: str) -> pa.RecordBatch:
    column = part.column(text)
    hashes, sizes = words.hashed(column)
    owner, start, length, period = runs(hashes, sizes)
    bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
    fields = [pa.array(c) for c in (start, length, period)]
    listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    collapsed = []
    for k, value in enumerate(column):
        split = (value.as_py() or "").encode().split()
        low, high = bounds[k], bounds[k + 1]
        if high > low:
            change = np.zeros(len(split) + 1, np.int64)
            np.add.at(change, start[low:high] + period[low:high], 1)
            np.add.at(change, start[low:high] + length[low:high], -1)
            dropped = np.cumsum(change[:-1]) > 0
            split = [w for w, d in zip(split, dropped.tolist()) if not d]
        collapsed.append(b" ".join(split).decode())
    return pa.RecordBatch.from_arrays([*part.columns, listed, pa.array(collapsed, pa.string())], [*part.schema.names, "runs", "collapsed"])
