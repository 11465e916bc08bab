"""Personal data: candidates of high recall, scored by boosted trees, next to the base patterns.

Base patterns find emails, IP addresses, card and phone numbers; what they find stays.  Looser
generators propose more, overlapping: addresses written with (at) and (dot), numbers with other
separators, phone numbers without a leading plus.  Every candidate gets format and context
features, and gradient-boosted trees score it.  The scores are calibrated on held-out candidates, and a
kind's threshold is the lowest score from which on held-out precision is at least ``PRECISION``.
Accepted candidates that overlap neither a base span nor a better candidate are added.

The trees are fitted on the driver, on at most ``SAMPLE`` different texts (those of the least hashes among texts with two digits or an @, so a
rerun takes the same) and at most ``PER_TEXT`` labelled candidates of each, drawn by hash too: never more than their product comes to the driver,
whatever is repeated and however long a text is.  Nobody labels spans, so the sample is labelled by rule (`judged`): base matches
are positive, and so are disguised addresses, national phone numbers, and base matches disguised; what fails
the check of its kind, dates, and base matches taken apart or cut short are negative; what no rule knows is left out.
All rows are scored, in tasks, with the fitted trees in the closure.

Null texts count as empty: no spans.  Spans are in code points, end exclusive.  Rows are
independent, repeats included; a text of any length is scanned whole, in time proportional to its length: addresses are sought from
their @ outwards, and numbers from the first digit of a run.  Columns called ``base_spans`` or ``spans`` are replaced, others stay.
Empty tables give empty results, and a model without trees, which keeps base spans only.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogproof.llm import words

KINDS = ("email", "ip", "card", "phone")
#: different texts whose candidates the trees are fitted on, and labelled candidates of each, at most
SAMPLE, PER_TEXT = 4000, 200
#: held-out precision that an added span needs
PRECISION = 0.98
SEED = 7

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: base patterns; an email's begins behind its @.  ``++`` keeps what it took, so a failing start costs its own digits only
BASE = {
    "email": re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: propose more than is right; numbers stand between what is no digit
LOOSE = {
    "email": re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .,_/-]{0,2}[0-9]{2,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?:\+ ?[0-9]{1,3}[ .-]?|(?<![0-9]))(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ ./-]{0,2}[0-9]{2,4}){1,4}(?![0-9])"),
}
AT = re.compile("@")
LOOSE_AT = re.compile(r"@|\(at\)|\[at\]")
NATIONAL = re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}")
#: forms of personal data that are known beside the base patterns
KNOWN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+"),
    "phone": re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}([-. ])[0-9]{3}\1[0-9]{4}"),
}
DATE = re.compile(r"[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2(?:[0-9]{2}|[0-9]{4})")
ANY = re.compile(r"[0-9@]|\(at\)|\[at\]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    doubled = [d for x in digits[-2::-2] for d in divmod(2 * int(x), 10)]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def valid(kind: str, text: str) -> bool:
    """Whether a match of a base pattern counts."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    digits = "".join(DIGITS.findall(text))
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def addresses(text: str, at: re.Pattern, domain: re.Pattern, gap: str = "") -> list[tuple[str, int, int]]:
    """Leftmost addresses that do not overlap, found from each ``at`` outwards.

    The local part is the run of its characters before the ``at`` (and before ``gap``), as far as the last match or the last ``at``; so
    every character is looked at once to the left and once to the right.
    """
    out, floor = [], 0
    for m in at.finditer(text):
        if m.start() >= floor:
            local = text[floor : m.start()]
            bare = local.removesuffix(gap)
            start = floor + len(bare.rstrip(LOCAL))
            behind = domain.match(text, m.end()) if start < floor + len(bare) else None
            if behind:
                out.append(("email", start, behind.end()))
            floor = behind.end() if behind else m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start: leftmost matches that do not overlap, failing ones dropped."""
    has_digit = DIGITS.search(text)
    out = addresses(text, AT, BASE["email"]) if "@" in text else []
    for kind, needed in (("ip", has_digit and "." in text), ("card", has_digit), ("phone", "+" in text)):
        if needed:
            out += [(kind, m.start(), m.end()) for m in BASE[kind].finditer(text) if valid(kind, m[0])]
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Proposals of all generators; they overlap."""
    if not ANY.search(text):
        return []
    numbers = [(kind, m.start(), m.end()) for kind in KINDS[1:] for m in LOOSE[kind].finditer(text)]
    return addresses(text, LOOSE_AT, LOOSE["email"], " ") + numbers


FEATURES = (
    "kind length digits separators groups shortest longest first_group plus parens dots dashes spaces at letters luhn octets "
    "national edge_before edge_after symbol_before symbol_after digit_before digit_after word_phone word_other"
).split()
#: words that stand before a number of a kind
PHONE_WORDS = re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|cell|whatsapp|handy|telefon|téléphone|móvil)\W*$")
OTHER_WORDS = re.compile(r"(?i)\b(?:version|v|no|nr|art|section|page|id|order|isbn|invoice|#)\W*$")


def features(text: str, span: tuple[str, int, int]) -> list[float]:
    """What a candidate looks like and what stands around it."""
    kind, start, end = span
    s = text[start:end]
    groups = re.findall(r"[0-9]+", s)
    digits = "".join(groups)
    before, after = text[start - 1 : start], text[end : end + 1]
    lead = text[max(0, start - 16) : start]
    sizes = [len(g) for g in groups] or [0]
    return [
        float(x)
        for x in (
            KINDS.index(kind),
            len(s),
            len(digits),
            sum(not c.isalnum() for c in s),
            len(groups),
            min(sizes),
            max(sizes),
            sizes[0],
            s.count("+"),
            s.count("("),
            s.count("."),
            s.count("-"),
            s.count(" "),
            s.count("@"),
            sum(c.isalpha() for c in s),
            len(digits) >= 13 and luhn(digits),
            len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
            bool(NATIONAL.fullmatch(s)),
            not before or before.isspace(),
            not after or after.isspace() or after in ".,;:!?",
            before in "$€£#%&*|<>=/_" and before != "",
            after in "$€£%=/_" and after != "",
            before.isdigit(),
            after.isdigit(),
            bool(PHONE_WORDS.search(lead)),
            bool(OTHER_WORDS.search(lead)),
        )
    ]


def disguises(kind: str, s: str) -> list[str]:
    """The same datum in a form that the base pattern misses."""
    if kind == "email":
        return [s.replace("@", " (at) ").replace(".", " (dot) "), s.replace("@", "[at]")]
    return [re.sub(r"^\+[0-9]+[ .-]*", "", s)] if kind == "phone" else []


def spoils(kind: str, s: str) -> list[str]:
    """Like it, but no personal datum any more."""
    other_end = s[:-1] + str((int(s[-1]) + 1) % 10) if kind == "card" else ""
    return [s[: len(s) // 2], s.replace("@", "-"), s.replace(".", "-"), re.sub("[0-9]", "", s), other_end]


def judged(kind: str, s: str) -> int | None:
    """1 for a form of personal data that is known, 0 for what cannot be any, None where no rule tells."""
    if kind in KNOWN and KNOWN[kind].fullmatch(s):
        return 1
    digits = "".join(DIGITS.findall(s))
    if kind == "email":
        return 0  # no dot behind it
    if kind == "card":
        if not 13 <= len(digits) <= 19 or not luhn(digits):
            return 0
        return 1 if len(digits) >= 16 else None
    if DATE.fullmatch(s):
        return 0
    if kind == "ip":
        return 0 if "," in s or any(int(g) > 255 for g in re.findall("[0-9]+", s)) else None
    return 0 if not 7 <= len(digits) <= 15 else None


def labelled(text: str) -> tuple[list[list[float]], list[int]]:
    """Features and rule-given labels of a text's candidates, and of base matches disguised and spoilt: ``PER_TEXT`` at most."""
    base = set(base_spans(text))
    found: list[tuple[str, tuple[str, int, int], int]] = []

    def some(spans: Iterable[tuple[str, int, int]], most: int) -> list[tuple[str, int, int]]:
        return sorted(spans, key=lambda c: (zlib.crc32(repr((c, text[c[1] : c[2]])).encode()), c))[:most]

    for c in some({*base, *candidates(text)}, PER_TEXT // 2):
        label = 1 if c in base else judged(c[0], text[c[1] : c[2]])
        if label is not None:
            found.append((text, c, label))
    for kind, start, end in some(base, PER_TEXT // 20):
        s = text[start:end]
        for good, forms in ((True, disguises(kind, s)), (False, spoils(kind, s))):
            for other in sorted({f for f in forms if f and f != s}):
                at = min(20, start)
                changed = text[start - at : start] + other + text[end : end + 20]
                valid_spans = base_spans(changed)
                for c in candidates(changed):
                    if c[1] < at + len(other) and c[2] > at:
                        whole = good and c == (kind, at, at + len(other))
                        known = judged(c[0], changed[c[1] : c[2]]) == 1
                        found.append((changed, c, int(whole or c in valid_spans or known)))
    found = found[:PER_TEXT]
    return [features(t, c) for t, c, _ in found], [y for _, _, y in found]


# --- gradient boosting ------------------------------------------------------------


@dataclass
class Boosted:
    """Trees of depth ``depth`` on binned features, for the log loss; a tree is three arrays in heap order."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.2
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    prior: float = 0.0

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
        bins, width = self._bins(x), 34
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.prior = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.prior)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            column, cut = np.zeros(2**self.depth, np.int64), np.full(2**self.depth, width)
            node = np.ones(len(y), np.int64)
            for level in range(self.depth):
                for k in range(2**level, 2 ** (level + 1)):
                    here = np.flatnonzero(node == k)
                    best = 1e-6
                    for j in range(bins.shape[1]) if len(here) > 1 else ():
                        gs = np.bincount(bins[here, j], g[here], width).cumsum()
                        hs = np.bincount(bins[here, j], h[here], width).cumsum()
                        gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                        at = int(gain.argmax())
                        if gain[at] > best:
                            best, column[k], cut[k] = gain[at], j, at
                node = 2 * node + (bins[np.arange(len(y)), column[node]] > cut[node])
            leaf = node - 2**self.depth
            gs, hs = (np.bincount(leaf, v, 2**self.depth) for v in (g, h))
            value = self.rate * gs / (hs + 1)
            self.trees.append((column, cut, value))
            score += value[leaf]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, rows = self._bins(x), np.arange(len(x))
        out = np.full(len(x), self.prior)
        for column, cut, value in self.trees:
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (bins[rows, column[node]] > cut[node])
            out += value[node - 2**self.depth]
        return out


@dataclass
class Model:
    """Trees, calibration (slope and offset of the score's log odds) and a threshold per kind."""

    trees: Boosted | None = None
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.score(x) + self.offset, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> Model:
    """Trees on two thirds of the rows, calibration and thresholds on the rest."""
    if len(y) < 60 or y.min() == y.max():
        return Model()  # nothing to learn from: only base spans are kept
    held = np.random.default_rng(SEED).random(len(y)) < 1 / 3
    model = Model(Boosted().fit(x[~held], y[~held]))
    score, truth = model.trees.score(x[held]), y[held]
    a, b = 1.0, 0.0
    for _ in range(50):  # Platt's logistic fit, by Newton steps
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - truth) * score).sum() + 1e-3 * (a - 1), (p - truth).sum()])
        hess = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum()]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    model.slope, model.offset = max(a, 1e-3), b
    p = model.probability(x[held])
    for i, kind in enumerate(KINDS):
        own = x[held][:, 0] == i
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(truth[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        ranked = np.append(p[own][order], 0.0)
        # halfway to the next candidate that is no longer accepted
        model.thresholds[kind] = max(0.5, float(ranked[good[-1] : good[-1] + 2].mean())) if len(good) else 2.0
    return model


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` of the different texts that have two digits or an @, the same on every run.

    The least hashes draw them, so copies do not matter; they are labelled in tasks, and only numbers come to the driver,
    at most ``sample * PER_TEXT`` rows.
    """
    likely = docs.select(F.col(text).cast("string").alias("text")).filter(F.col("text").rlike(r"[0-9]{2}|@"))
    likely = likely.withColumn("drawn", F.xxhash64("text"))
    drawn = likely.select("drawn").distinct().orderBy("drawn").limit(sample)
    texts = likely.join(F.broadcast(drawn), "drawn", "left_semi").groupBy("drawn").agg(F.min("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[*x, y] for t in batch.column("text") for x, y in zip(*labelled(t.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["row"])

    rows = texts.mapInArrow(words.returning(run), "row array<double>").toArrow().column("row").to_pylist()
    data = np.array(sorted(rows)).reshape(-1, len(FEATURES) + 1)
    return fit(data[:, :-1], data[:, -1].astype(np.int64))


# --- application -------------------------------------------------------------------


class _Taken:
    """Disjoint stretches in order, for asking whether another overlaps one of them."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda c: c[1]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start

    def add(self, start: int, end: int) -> None:
        k = bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def all_spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: by kind, then start."""
    base = base_spans(text)
    if model.trees is None:
        return base, base
    taken = _Taken(base)
    more = [c for c in candidates(text) if not taken.meets(c[1], c[2])]
    added = []
    if more:
        p = model.probability(np.array([features(text, c) for c in more]))
        for i in sorted(range(len(more)), key=lambda i: (-p[i], more[i][1], -more[i][2])):
            kind, start, end = more[i]
            if p[i] >= model.thresholds.get(kind, 2.0) and not taken.meets(start, end):
                added.append(more[i])
                taken.add(start, end)
    return base, sorted([*base, *added], key=lambda c: (KINDS.index(c[0]), c[1]))


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans``, arrays of (kind, start, end)."""
    plain = docs.drop("base_spans", "spans").withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([*plain.schema.fields, T.StructField("base_spans", _SPANS), T.StructField("spans", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in (p for whole in batches for p in words.portions(whole, text)):
            found = [all_spans(t.as_py() or "", model) for t in batch.column(text)]
            named = [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in f] for f in found]
            columns = [pa.array([n[i] for n in named], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "base_spans", "spans"])

    return plain.mapInArrow(words.returning(run), schema)


def masked(text: str | None, spans: list[tuple[str, int, int]], mask: str = "[{}]") -> str | None:
    """The text with the mark of its kind in place of each span.  Spans of two kinds may overlap: one mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], mask.format(kind.upper())]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, text: str = "text", mask: str = "[{}]") -> DataFrame:
    """Replace all spans in the text, in the same pass that finds them; ``n_spans`` says how many."""
    plain = docs.drop("n_spans").withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([*plain.schema.fields, T.StructField("n_spans", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in words.portions(whole, text)):
            at = batch.schema.get_field_index(text)
            new, counts = [], []
            for t in batch.column(text):
                value = t.as_py()
                spans = all_spans(value or "", model)[1]
                new.append(masked(value, spans, mask))
                counts.append(len(spans))
            columns = [pa.array(new, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*batch.schema.names, "n_spans"])

    return plain.mapInArrow(words.returning(run), schema)
