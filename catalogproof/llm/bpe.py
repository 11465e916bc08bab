"""Byte-pair encoding with word ends, and decoding, equal to the tokenizers library.

The vocabulary file's path is a parameter.  Texts are split at the special strings, brought
to NFC, lower-cased and cut at white space; each piece between is cut into pre-tokens, and each
pre-token is merged in a contiguous rank array: part boundaries and the rank of every
adjacent pair stand in two short rows, the smallest rank is found by scanning, its
boundary is deleted, and the two ranks beside it are refreshed.  The new pre-tokens of a batch
are merged together, a row each.  Pre-tokens of more than ``SCAN`` parts keep the ranks in a
heap instead, with the same result.

Rows are independent, so nothing is shuffled; each Python worker remembers the pieces it met, at
most ``REMEMBERED`` at a time.

Null text counts as empty: no ids, an empty decoded text.  Texts may be of any length.  Rows
repeat as they come; other columns are passed on, and an input column that is called like an
output column is replaced.  Empty tables give empty results.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from catalogproof.llm import words

#: parts up to which the smallest rank is found by scanning
SCAN = 64
#: pieces whose ids a worker remembers, and those it merges together
REMEMBERED, TOGETHER = 200_000, 20_000

# Fixed values of the vocabulary's format.
WORD_END = "</w>"
#: for texts up to U+024F: contractions, letters, one numeral, other visible characters
PRE_TOKEN_LATIN = (
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9²³¹¼½¾]"
    r"|[^\sa-zA-Z0-9ªµº²³¹¼½¾\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
)
#: characters whose rules are asked of the library; the first four are white space in Python only
BEYOND_LATIN = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")
#: printable bytes stand for themselves, the others for the code points from 256 on
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

NEVER = sys.maxsize


def _letters() -> list[str]:
    out = {b: chr(b) for b in _PRINTABLE}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(_PRINTABLE)))
    return [out[b] for b in range(256)]


class Ranks:
    """Rank of a pair of tokens, and the token it becomes; of one pair or of arrays of pairs."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        self.one = {a << 32 | b: rank for rank, (a, b) in enumerate(pairs)}
        self.made = np.array(made, np.int64)
        keys = np.fromiter(self.one, np.int64, len(self.one))
        order = np.argsort(keys)
        self._keys, self._rank = np.append(keys[order], NEVER), np.append(order, NEVER)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """NEVER where a pair has no rank, or is behind the end of a word (-1)."""
        key = np.where((a < 0) | (b < 0), -1, a << 32 | b)
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._rank[at], NEVER)


def merge_by_scan(parts: np.ndarray, adjacent: np.ndarray, ranks: Ranks) -> np.ndarray:
    """Merge in each word the adjacent pair of the lowest rank, leftmost first, until none has one.

    A row is a word: the token that begins at each of its boundaries, then -1.  Beside it, in
    ``adjacent``, stand the ranks of its adjacent pairs.  A step does the same in all rows that are not finished.
    """
    done = parts.copy()
    rows = np.arange(len(parts))
    while len(rows) and adjacent.shape[1]:
        i = adjacent.argmin(1)
        lowest = adjacent[np.arange(len(rows)), i]
        more = lowest != NEVER
        done[rows[~more]] = parts[~more]
        rows, parts, adjacent, i, lowest = rows[more], parts[more], adjacent[more], i[more], lowest[more]
        here = np.arange(len(rows))
        parts[here, i] = ranks.made[lowest]
        # delete the boundary between the two: everything behind moves up by one
        behind = np.arange(parts.shape[1]) > i[:, None]
        parts = np.where(behind, np.pad(parts[:, 1:], ((0, 0), (0, 1)), constant_values=-1), parts)
        moved = np.pad(adjacent[:, 1:], ((0, 0), (0, 1)), constant_values=NEVER)
        adjacent = np.where(behind[:, :-1] | (np.arange(adjacent.shape[1]) == i[:, None]), moved, adjacent)
        # refresh the ranks on its two sides
        right = i < adjacent.shape[1]
        adjacent[here[right], i[right]] = ranks.of(parts[here[right], i[right]], parts[here[right], i[right] + 1])
        left = i > 0
        adjacent[here[left], i[left] - 1] = ranks.of(parts[here[left], i[left] - 1], parts[here[left], i[left]])
    return done


def merge_by_heap(parts: list[int], ranks: Ranks) -> list[int]:
    """The same for one long word: n log n instead of n squared."""
    parts = list(parts)
    after = [*range(1, len(parts)), -1]
    before = [*range(-1, len(parts) - 1)]
    heap: list[tuple[int, int]] = []

    def push(i: int) -> None:
        if i >= 0 and (j := after[i]) >= 0:
            rank = ranks.one.get(parts[i] << 32 | parts[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i))

    for i in range(len(parts)):
        push(i)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] < 0 or j < 0 or ranks.one.get(parts[i] << 32 | parts[j]) != rank:
            continue  # one of the two has changed since
        parts[i], parts[j], after[i] = int(ranks.made[rank]), -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        push(before[i])
        push(i)
    return [p for p in parts if p >= 0]


class Vocabulary:
    """A vocabulary with word ends, read from the tokenizers library's file.

    Normal form and pre-tokens of texts beyond Latin letters are asked of the library, whose
    Unicode tables may be of another version than Python's.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids: dict[str, int] = data["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.ranks = Ranks([(ids[a], ids[b]) for a, b in merges], [ids[a + b] for a, b in merges])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in [*ids.items(), *self.special.items()]}
        letters = _letters()
        self._inner = np.array([ids[c] for c in letters], np.int64)
        self._last = np.array([ids[c + WORD_END] for c in letters], np.int64)
        self._byte = {c: b for b, c in enumerate(letters)}
        # ranks of two bytes, inside a word and at its end
        self._inner_ranks = self.ranks.of(self._inner[:, None], self._inner[None])
        self._last_ranks = self.ranks.of(self._inner[:, None], self._last[None])
        self._pre_token = re.compile(PRE_TOKEN_LATIN)
        by_length = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, by_length)) + ")")
        rules = Tokenizer.from_file(path)
        self._normalizer, self._pre_tokenizer = rules.normalizer, rules.pre_tokenizer
        self._ints = list(range(max(self.tokens) + 1))
        self._known: dict[str, dict[str, tuple]] = {"ids": {}, "text": {}}

    def _pre_tokens(self, piece: str) -> list[bytes]:
        if not BEYOND_LATIN.search(piece):
            return [t.encode() for t in self._pre_token.findall(piece)]
        return [bytes(map(self._byte.__getitem__, t)) for t, _ in self._pre_tokenizer.pre_tokenize_str(piece)]

    def merge(self, pre_tokens: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        out: list[list[int]] = [[]] * len(pre_tokens)
        sizes = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        for i in np.flatnonzero(sizes > SCAN).tolist():
            inner, last = self._inner[list(pre_tokens[i][:-1])], self._last[pre_tokens[i][-1]]
            out[i] = merge_by_heap([*inner.tolist(), int(last)], self.ranks)
        least = 0
        for most in (6, 10, 16, 32, SCAN):  # words of like length share a matrix
            at = np.flatnonzero((sizes > least) & (sizes <= most))
            least = most
            if not len(at):
                continue
            bytes_ = np.zeros((len(at), most), np.uint8)
            ends = sizes[at]
            filled = np.arange(most) < ends[:, None]
            bytes_[filled] = np.frombuffer(b"".join([pre_tokens[i] for i in at.tolist()]), np.uint8)
            parts = np.where(filled, self._inner[bytes_], -1)
            rows = np.arange(len(at))
            parts[rows, ends - 1] = self._last[bytes_[rows, ends - 1]]
            adjacent = np.where(filled[:, 1:], self._inner_ranks[bytes_[:, :-1], bytes_[:, 1:]], NEVER)
            pairs = rows[ends > 1]
            end = ends[pairs] - 1
            adjacent[pairs, end - 1] = self._last_ranks[bytes_[pairs, end - 1], bytes_[pairs, end]]
            merged = merge_by_scan(parts, adjacent, self.ranks)
            for i, ids, n in zip(at.tolist(), merged.tolist(), (merged >= 0).sum(1).tolist()):
                out[i] = ids[:n]
        return out

    def learn(self, pieces: set[str], form: str = "ids") -> dict[str, tuple]:
        """For each of ``pieces``: its ids or, in ``form`` text, their number, they in decimal and the decoded text.

        What is made here holds no cycles, so the search for them is put off meanwhile.
        """
        searching = gc.isenabled()
        gc.disable()
        try:
            return self._learn(pieces, form)
        finally:
            if searching:
                gc.enable()

    def _learn(self, pieces: set[str], form: str) -> dict[str, tuple]:
        known = self._known[form]
        if len(known) + len(pieces) > REMEMBERED:
            known = self._known[form] = {p: known[p] for p in pieces if p in known}
        new = [p for p in pieces if p not in known]
        for low in range(0, len(new), TOGETHER):
            part = new[low : low + TOGETHER]
            cut = [[] if p[:1] == " " else self._pre_tokens(p) for p in part]
            ids = iter(self.merge([t for c in cut for t in c]))
            for piece, pre_tokens in zip(part, cut):
                # one int object for each id, however many pieces have it
                found = tuple([self._ints[i] for _ in pre_tokens for i in next(ids)])
                if piece[:1] == " ":
                    found = (self.special[piece[1:]],)
                known[piece] = found if form == "ids" else (len(found), " ".join(map(str, found)), self.decode(found))
        return known

    def pieces(self, text: str) -> list[str]:
        """What white space and special strings separate; special strings with a space before."""
        if "<|" not in text:
            return self._split(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            out += [" " + part] if i % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if BEYOND_LATIN.search(text):
            return self._normalizer.normalize_str(text).split(" ")
        plain = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()
        return plain.split()

    def encode(self, text: str) -> list[int]:
        pieces = self.pieces(text)
        known = self.learn(set(pieces))
        return [i for piece in pieces for i in known[piece]]

    def decode(self, ids) -> str:
        """Tokens with one space between: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@cache
def vocabulary(path: str) -> Vocabulary:
    """One for each worker process."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids``, an array of int, to each row.

    Give ``decoded`` (a column's name) to decode the ids where they arise and add the SHA-256 of the decoded text.
    """
    digests = [decoded] if decoded else []
    plain = docs.drop(ids, *digests)
    schema = T.StructType(
        [
            *plain.schema.fields,
            T.StructField(ids, T.ArrayType(T.IntegerType(), False)),
            *[T.StructField(d, T.StringType()) for d in digests],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in words.portions(batch, text, 1 << 20):
                cut = [v.pieces(t or "") for t in part.column(text).to_pylist()]
                known = v.learn({p for pieces in cut for p in pieces})
                rows = [np.array([i for p in pieces for i in known[p]], np.int32) for pieces in cut]
                sizes = np.cumsum([0, *map(len, rows)])
                flat = np.concatenate([np.zeros(0, np.int32), *rows])
                array = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))
                more = [pa.array([_sha256(v.decode(r.tolist())) for r in rows], pa.string()) for _ in digests]
                yield pa.RecordBatch.from_arrays([*part.columns, array, *more], [*part.schema.names, ids, *digests])

    return plain.mapInArrow(words.returning(run, vocabulary.cache_clear), schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text of an array of ids; a null array counts as empty."""
    plain = encoded.drop(out)
    schema = T.StructType([*plain.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in words.portions(batch, ids, 1 << 20):
                texts = [v.decode(r or ()) for r in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return plain.mapInArrow(run, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digest(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode; add n_tokens, ids_sha256 and decoded_sha256 instead of ids and texts.

    Ids and decoded texts are dropped where they arise, so they never leave the worker.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = docs.drop(*names)
    schema = T.StructType(
        [
            *[f for f in kept.schema.fields if f.name != text],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for part in words.portions(batch, text, 1 << 20):
                cut = [v.pieces(t or "") for t in part.column(text).to_pylist()]
                known = v.learn({p for pieces in cut for p in pieces}, "text")
                n, ids, decoded = [], [], []
                for pieces in cut:
                    found = [k for k in map(known.__getitem__, pieces) if k[0]]
                    n.append(sum([k[0] for k in found]))
                    ids.append(_sha256(" ".join([k[1] for k in found])))
                    decoded.append(_sha256(" ".join([k[2] for k in found])))
                others = [c for c, name in zip(part.columns, part.schema.names) if name != text]
                yield pa.RecordBatch.from_arrays(
                    [*others, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    [f.name for f in schema.fields],
                )

    return kept.withColumn(text, F.col(text).cast("string")).mapInArrow(run, schema)
