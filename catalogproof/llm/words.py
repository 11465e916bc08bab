"""Words of texts: the separators they share, and 64-bit word hashes of a whole Arrow batch.

A word is a longest run of characters other than space and U+0009 to U+000D.  Hashing
works on the bytes of many texts at once, in windows of ``WINDOW`` bytes, so its memory
does not grow with a text's length beyond eight bytes a word.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: as a regular expression, for Spark and for DuckDB
WORD = r"[^\x20\x09-\x0D]+"
#: bytes hashed at once
WINDOW = 1 << 20
#: bytes that a worker takes in between two collections of its garbage
COLLECT = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not use, whatever the case."""
    used = {c.lower() for c in df.columns}
    while name in used:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose outputs look random (xor, shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[_SPACE] = 0
_RADIX = np.uint64(0x9FB21C651E98DF25)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more offset at the end)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def portions(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of a column, so that what a batch turns into stays small."""
    rows = max(1, int(batch.num_rows * most / max(most, batch.column(column).nbytes)))
    for low in range(0, batch.num_rows, rows):
        yield batch.slice(low, rows)


_taken = 0


def give_back(taken: int) -> None:
    """Return free memory to the system; collect garbage first after each ``COLLECT`` bytes that this worker took in, in any number of partitions.

    A collection takes some 50 ms however little there is, more than most small partitions.
    """
    global _taken
    _taken += taken
    if _taken >= COLLECT:
        _taken = 0
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc has it, others may not
        ctypes.CDLL(None).malloc_trim(0)


def returning(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``run``, but at the end of a partition the worker, which Spark keeps for the next, gives free memory back to the system.

    ``forget`` drops what the worker remembers beyond the partition.
    """

    def whole(batches: Iterator) -> Iterator:
        taken = 0

        def counted() -> Iterator:
            nonlocal taken
            for batch in batches:
                taken += batch.nbytes
                yield batch

        try:
            yield from run(counted())
        finally:
            if forget is not None:
                forget()
            give_back(taken)

    return whole


def _window(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in these bytes, and their hashes.  ``begins``: where texts start."""
    solid = ~_SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    start[begins] = solid[begins]
    first = np.flatnonzero(start)
    if not len(first):
        return first, np.zeros(0, np.uint64)
    lengths = np.diff(np.append(first, len(data)))
    place = np.arange(first[0], len(data)) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _RADIX))
    values = _BYTE[data[first[0] :]] * power[place]
    return first, mix(np.add.reduceat(values, first - first[0]))


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts in a row, and how many words each text has."""
    data, offsets = utf8(column)
    starts, hashes, low = [], [], 0
    edges = np.unique(offsets)
    while low < len(data):
        high = min(low + WINDOW, len(data))
        if high < len(data):  # end at a text's end or behind a space
            edge = edges[np.searchsorted(edges, high, "right") - 1]
            if edge <= low:
                stop = int(edges[np.searchsorted(edges, low, "right")])
                while high < stop and not _SPACE[data[high - 1]]:
                    high += 1
            else:
                high = int(edge)
        begins = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        first, values = _window(data[low:high], begins)
        starts.append(first + low)
        hashes.append(values)
        low = high
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return words, np.diff(np.searchsorted(start, offsets))


def shingled(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed windows of ``n`` words, sorted within each text, and how many each text has.

    A text of fewer than ``n`` words, but at least one, has one window: all of it.
    """
    docs = np.repeat(np.arange(len(counts)), counts)
    if not len(words):
        return words, np.zeros(len(counts), np.int64)
    ends = np.cumsum(counts)
    value = np.zeros(len(words), np.uint64)
    last = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the text's end
    for k in range(n):
        shifted = np.zeros(len(words), np.uint64)
        shifted[: max(0, len(words) - k)] = words[k:]
        value = np.where(last > k, mix(value * _RADIX + shifted + np.uint64(k + 1)), value)
    first = np.zeros(len(words), bool)
    first[(ends - counts)[counts > 0]] = True
    keep = (last >= n) | first & (np.repeat(counts, counts) < n)
    value, docs = value[keep], docs[keep]
    order = np.lexsort((value, docs))
    value, docs = value[order], docs[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (docs[1:] != docs[:-1])
    return value[fresh], np.bincount(docs[fresh], minlength=len(counts))
