"""Token counts that follow edits: a segment tree of pre-tokens for each document.

A text is cut where a visible character is followed by one space and another visible character: no
pre-token spans such a place, so the pieces between are encoded on their own and their counts add up.  ``LEAF``
pieces are a leaf; the nodes of the tree hold the characters and tokens below them.  An edit is found by
descending along the character sums.  The leaves it touches, and neighbours as long as the place between them
is no safe cut any more, are joined, changed, cut anew and encoded; then the sums above them are brought up to date.
All other leaves keep their counts.  Leaves that an edit makes longer than twice ``LEAF`` pieces are split, and the sums laid out anew above them.

`build` gives each document its tree as a column of leaves (text and tokens of each, in order), to be stored with the table; `apply` takes
such a column up, applies another batch of edits and returns the leaves as they are then, so nothing but the edited regions is encoded
again, batch after batch.  `count` does both at once for a text and its edits.

Counts are those of a byte-level BPE vocabulary, given as a file of ranks.

Null texts count as empty.  Edits are (start, end, text) in code points of the text as it is by then, applied in
order; a null list is none, null texts insert nothing, and offsets beyond the text, null or out of order are brought into
its range.  Rows are independent, repeats included: all edits of a document are in its row.  Null leaves are an empty text.  A column called
like an output column is replaced, others stay.  Empty tables give empty results.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogproof.llm import words

LEAF = 32
#: pieces whose counts a worker remembers
REMEMBERED = 500_000
# Fixed value: how the vocabulary's texts are split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    """Token counts of pieces, remembered."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self._known.get(piece)
        if n is None:
            n = len(self._encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[piece] = n
        return n


@cache
def counter(path: str) -> Counter:
    """One for each worker process."""
    return Counter(path)


def pieces(text: str) -> list[str]:
    """The text, cut at every safe place."""
    split = text.split(" ")
    out, piece = [], split[0]
    for word in split[1:]:
        if word and piece and not word[0].isspace() and not piece[-1].isspace():
            out.append(piece)
            piece = " " + word
        else:
            piece += " " + word
    return [*out, piece] if piece else out


def safe(left: str, right: str) -> bool:
    """Whether no pre-token spans the place between two texts."""
    return bool(left) and len(right) > 1 and right[0] == " " and not left[-1].isspace() and not right[1].isspace()


def _leaves(cut: list[str], size: int, counts: Counter) -> list[tuple[str, int]]:
    """(text, tokens) of each ``size`` pieces."""
    parts = [cut[k : k + size] for k in range(0, len(cut), size)]
    return [("".join(p), sum(map(counts.count, p))) for p in parts]


class Tree:
    """Leaves of text under sums of characters and tokens, in heap order."""

    def __init__(self, text: str, counts: Counter, leaves: list[tuple[str, int]] | None = None):
        """Of a text, or of the leaves of one, which are not encoded again."""
        self._counts = counts
        self.encoded = 0  # characters encoded by edits
        self._lay_out(_leaves(pieces(text), LEAF, counts) if leaves is None else leaves)

    def _lay_out(self, leaves: list[tuple[str, int]]) -> None:
        leaves = leaves or [("", 0)]
        self.width = 1 << (len(leaves) - 1).bit_length()
        self.texts = [t for t, _ in leaves] + [""] * (self.width - len(leaves))
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (text, tokens) in enumerate(leaves):
            self.chars[self.width + k] = len(text)
            self.tokens[self.width + k] = tokens
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    @property
    def leaves(self) -> list[tuple[str, int]]:
        """(text, tokens) of every leaf that has text, in order."""
        return [(t, self.tokens[self.width + k]) for k, t in enumerate(self.texts) if t]

    def _sum(self, k: int) -> None:
        for of in (self.chars, self.tokens):
            of[k] = of[2 * k] + of[2 * k + 1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf of a character, and where in it."""
        k = 1
        while k < self.width:
            k *= 2
            if at >= self.chars[k] and self.chars[k + 1]:
                at -= self.chars[k]
                k += 1
        return k - self.width, at

    def _beside(self, k: int, step: int) -> int | None:
        """The next leaf with text."""
        k += step
        while 0 <= k < self.width and not self.texts[k]:
            k += step
        return k if 0 <= k < self.width else None

    def edit(self, start: int | None, end: int | None, text: str | None) -> None:
        n = self.chars[1]
        start = min(max(start or 0, 0), n)
        end = min(max(start if end is None else end, start), n)
        low, before = self._find(max(0, start - 1))
        before += start > 0
        high, after = self._find(max(0, end - 1))
        after += end > 0
        changed = self.texts[low][:before] + (text or "") + self.texts[high][after:]
        while (k := self._beside(low, -1)) is not None and not safe(self.texts[k], changed):
            low, changed = k, self.texts[k] + changed
        while (k := self._beside(high, 1)) is not None and not safe(changed, self.texts[k]):
            high, changed = k, changed + self.texts[k]
        self.encoded += len(changed)
        cut, slots = pieces(changed), high - low + 1
        share = -(-len(cut) // slots)
        if share > 2 * LEAF:
            every = [(t, self.tokens[self.width + k]) for k, t in enumerate(self.texts)]
            around = [[x for x in part if x[0]] for part in (every[:low], every[high + 1 :])]
            self._lay_out([*around[0], *_leaves(cut, LEAF, self._counts), *around[1]])
            return
        new = _leaves(cut, share, self._counts) if cut else []
        for k in range(slots):
            text, tokens = new[k] if k < len(new) else ("", 0)
            self.texts[low + k] = text
            self.chars[self.width + low + k] = len(text)
            self.tokens[self.width + low + k] = tokens
        a, b = (self.width + low) // 2, (self.width + high) // 2
        while a:
            for k in range(a, b + 1):
                self._sum(k)
            a, b = a // 2, b // 2

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)


OUTPUT = ["n_tokens_before", "n_tokens", "n_chars", "encoded_chars"]
_LEAF_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("tokens", T.LongType())])
_ARROW_LEAVES = pa.list_(pa.struct([("text", pa.string()), ("tokens", pa.int64())]))


def _named(leaves: list[tuple[str, int]]) -> list[dict]:
    return [{"text": t, "tokens": n} for t, n in leaves]


def build(docs: DataFrame, path: str, text: str = "text", leaves: str = "leaves") -> DataFrame:
    """Add ``leaves``, the tree of each text, and ``n_tokens``."""
    plain = docs.drop(leaves, "n_tokens")
    schema = T.StructType([*plain.schema.fields, T.StructField(leaves, T.ArrayType(_LEAF_TYPE)), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for part in (p for batch in batches for p in words.portions(batch, text)):
            trees = [Tree(t.as_py() or "", counts) for t in part.column(text)]
            columns = [pa.array([_named(t.leaves) for t in trees], _ARROW_LEAVES), pa.array([t.n_tokens for t in trees], pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, leaves, "n_tokens"])

    return plain.mapInArrow(words.returning(run), schema)


def _edited(tree: Tree, changes: list | None) -> tuple[int, int, int, int]:
    first = tree.n_tokens
    for e in changes or ():
        if e is not None:
            tree.edit(*e.values())
    return first, tree.n_tokens, tree.chars[1], tree.encoded


def _numbers(rows: list[tuple[int, ...]]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(OUTPUT))]


def apply(stored: DataFrame, path: str, leaves: str = "leaves", edits: str = "edits") -> DataFrame:
    """Bring ``leaves`` up to date with another batch of ``edits``, and add the counts before and after and the characters encoded again.

    The text is what the leaves hold (`text_of`); nothing else is read.
    """
    plain = stored.drop(*OUTPUT)
    schema = T.StructType([*plain.schema.fields, *[T.StructField(c, T.LongType()) for c in OUTPUT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for part in (p for batch in batches for p in words.portions(batch, leaves)):
            rows, new = [], []
            for held, changes in zip(part.column(leaves), part.column(edits)):
                tree = Tree("", counts, [(x["text"] or "", x["tokens"] or 0) for x in held.as_py() or () if x])
                rows.append(_edited(tree, changes.as_py()))
                new.append(_named(tree.leaves))
            at = part.schema.get_field_index(leaves)
            kept = [pa.array(new, _ARROW_LEAVES) if k == at else c for k, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays([*kept, *_numbers(rows)], [*part.schema.names, *OUTPUT])

    return plain.mapInArrow(words.returning(run), schema)


def text_of(leaves: Column) -> Column:
    """The text that a tree stands for."""
    return F.array_join(F.transform(leaves, lambda x: x["text"]), "")


def count(docs: DataFrame, path: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Add the counts before and after the edits, the characters encoded again, and the edited text.

    ``edits``: array of (start, end, text).
    """
    plain = docs.drop(*OUTPUT, "edited")
    schema = T.StructType(
        [*plain.schema.fields, *[T.StructField(c, T.LongType()) for c in OUTPUT], T.StructField("edited", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for part in (p for batch in batches for p in words.portions(batch, text)):
            rows, texts = [], []
            for t, changes in zip(part.column(text), part.column(edits)):
                tree = Tree(t.as_py() or "", counts)
                rows.append(_edited(tree, changes.as_py()))
                texts.append(tree.text)
            columns = [*_numbers(rows), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *OUTPUT, "edited"])

    return plain.mapInArrow(words.returning(run), schema)
