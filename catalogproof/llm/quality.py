"""Quality rules: base measures of a text, and thresholds that adapt to language and source.

``measure`` adds the base measures.  ``sketch`` summarizes each measure in each (language, source)
group as a quantile sketch: counts in bins whose edges grow by a constant factor, so
every quantile is right within ``ACCURACY`` of its value.  Sketches of parts of the data add up
to the sketch of the whole (`merge`), so they are aggregated before they are shuffled, may be
stored, and a group of any size takes a few hundred rows.  ``thresholds`` turns them into
fences outside the bulk of the group, in place of one fixed cutoff for all: ``REACH`` times the spread from the median.  The spread is the
smaller of the distances to the two quartiles, which junk on one side does not move while it is less than half of the group, and no less than
``SPREADS`` (measures of clean texts that vary a little, or not at all) or ``RELATIVE`` of the median.  A group that is junk for the most
part is held by ``BOUND`` times the fence of its language or of everything, whichever is wider, and a share by ``MOST``.  A group of
fewer than ``least`` documents takes its language's merged sketch, and a language of fewer
that of everything.  ``judge`` joins the fences to the documents and gives a verdict.

Null text has no words.  Null languages and sources are groups of their own.  Rows repeat as they
come.  A column called like an output column is replaced.  Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogproof.llm import words
from catalogproof.operators import scaling

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: words below which a text fails, and the share of repeated words, in percent, above which it does
LEAST_WORDS, MOST_REPEATED = 50, 50

#: relative error of a quantile
ACCURACY = 0.02
GROWTH = math.log((1 + ACCURACY) / (1 - ACCURACY))
#: bin of values too small to matter
ZERO = -(1 << 20)
#: what is sketched: name -> numerator and denominator, as SQL both engines read
RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
}
#: a fence stands so many spreads away from the median; 6 quartile distances are 4 standard deviations of a normal law
REACH = 6.0
#: the least spread of a measure, as such and in proportion to the median
SPREADS = {"word_length": 0.0, "symbol_share": 0.008, "duplicate_lines": 0.005, "repeated_words": 0.05}
RELATIVE = 0.05
#: a group's fence is at most so many times that of its language or of everything, and that of a share at most MOST
BOUND, MOST = 4.0, 0.5
#: measures that have a lower fence too, and are no shares
TWO_SIDED = ("word_length",)
#: documents that a group needs for fences of its own
LEAST_GROUP = 100


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three which occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    often = times[window] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= often
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    split = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return (
        len(split),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(split),
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures and ``base_failed``.  Rows are independent: nothing is shuffled."""
    plain = docs.drop(*MEASURES, "base_failed").withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([*plain.schema.fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in words.portions(batch, text)):
            rows = np.array([measures(t.as_py()) for t in part.column(text)], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(rows[:, k]) for k in range(len(MEASURES))]],
                [*part.schema.names, *MEASURES],
            )

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return plain.mapInArrow(words.returning(run), schema).withColumn("base_failed", failed)


def _bin(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(GROWTH)).cast("bigint")).otherwise(
        F.lit(ZERO).cast("bigint")
    )


def _ratio(name: str) -> Column:
    above, below = RATIOS[name]
    return F.col(above) / F.when(F.col(below) > 0, F.col(below))


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, bin, n): one quantile sketch for each group and measure.

    Texts that fail the base rules are left out, so junk does not widen the fences.
    """
    values = F.array(*[F.struct(F.lit(m).alias("measure"), _bin(_ratio(m)).alias("bin")) for m in RATIOS])
    return (
        measured.filter(~F.col("base_failed"))
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.measure", "v.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of all groups that agree in ``by``, as one."""
    return sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


#: what a sketch is asked for
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, total, q1, median, q3).  A window holds one sketch: a few hundred rows."""
    group = W.partitionBy(*by, "measure")
    upto = group.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = sketches.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(group)})
    value = F.when(F.col("bin") == ZERO, F.lit(0.0)).otherwise(
        2 * F.exp(F.col("bin") * GROWTH) / (math.exp(GROWTH) + 1)
    )
    return ranked.groupBy(*by, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), value)).alias(q) for q, share in QUARTILES.items()],
    )


def _spread(prefix: str = "") -> Column:
    q1, median, q3 = (F.col(prefix + q) for q in QUARTILES)
    least = F.create_map(*[F.lit(x) for kv in SPREADS.items() for x in kv])[F.col("measure")]
    return F.greatest(F.least(q3 - median, median - q1), least, RELATIVE * median)


def thresholds(sketches: DataFrame, least: int = LEAST_GROUP) -> DataFrame:
    """(lang, source, measure, low, high), one row per group and measure; low is null for shares.

    Small groups borrow the merged sketch of their language, or of everything.
    """
    own = _quantiles(sketches, ["lang", "source"])
    columns = ["total", *QUARTILES]
    by_lang = _quantiles(merge(sketches, "lang"), ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("measure").alias("_measure"), *_named("wider", columns)
    )
    overall = _quantiles(merge(sketches), []).select(F.col("measure").alias("_whole"), *_named("all", columns))
    # as many rows as there are languages, and one for each measure
    joined = own.join(
        by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure"))
    ).join(overall, F.col("measure") == F.col("_whole"))

    def of(name: str) -> Column:
        return (
            F.when(F.col("total") >= least, F.col(name))
            .when(F.col("wider_total") >= least, F.col(f"wider_{name}"))
            .otherwise(F.col(f"all_{name}"))
        )

    chosen = joined.withColumns({f"_{q}": of(q) for q in QUARTILES})
    two_sided = F.col("measure").isin(*TWO_SIDED)
    bound = BOUND * F.greatest(*[F.col(f"{p}_median") + REACH * _spread(f"{p}_") for p in ("wider", "all")])
    high = F.least(F.col("_median") + REACH * _spread("_"), bound)
    return chosen.select(
        "lang",
        "source",
        "measure",
        F.when(two_sided, F.col("_median") - REACH * _spread("_")).alias("low"),
        F.when(two_sided, high).otherwise(F.least(high, F.lit(MOST))).alias("high"),
    )


def _named(prefix: str, columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in columns]


def judge(measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add ``kept``: false if the base rules fail or a measure is beyond its group's fences.

    ``fences`` has one row per group and measure and is joined by `scaling.join_dimension`:
    broadcast only when it counts few rows.  A group without a fence keeps what passes the base rules.
    """
    plain = measured.drop("kept")
    key, spread, found = (words.free_name(plain, n) for n in ("group", "spread", "fences"))
    sides = F.struct("low", "high")
    wide = fences.groupBy(F.struct("lang", "source").alias(key)).agg(
        F.struct(*[F.max(F.when(F.col("measure") == m, sides)).alias(m) for m in RATIOS]).alias(found)
    )
    wide = scaling.materialize(wide, "fences")
    keyed = plain.withColumns(
        {
            key: F.struct(F.col(lang).alias("lang"), F.col(source).alias("source")),
            spread: F.xxhash64("n_words", "word_chars", "n_symbols"),
        }
    )
    joined = scaling.join_dimension(keyed, wide, [key], spread)
    beyond = F.lit(False)
    for m in RATIOS:
        fence = F.col(found)[m]
        beyond = beyond | F.coalesce(_ratio(m) > fence["high"], F.lit(False)) | F.coalesce(_ratio(m) < fence["low"], F.lit(False))
    return joined.withColumn("kept", ~(F.col("base_failed") | beyond)).drop(key, spread, found)


def filter_quality(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """All steps: every row with its measures and ``kept``."""
    # measured once for the sketches, where the text is not carried, and once for the verdict
    bare = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    sketches = scaling.materialize(sketch(measure(bare)), "sketches")
    return judge(measure(docs, text), thresholds(sketches), lang, source)
