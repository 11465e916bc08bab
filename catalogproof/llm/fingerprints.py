"""Document fingerprints that can be subtracted and inverted: invertible Bloom lookup sketches.

A text is cut into paragraphs - lines, long ones into blocks of 32 words - which cover
every character.  Each occurrence of a paragraph, numbered among its equals, is an element
of 60 bits, so texts that repeat a line n and n - 1 times share n - 1 of them.  A sketch has ``m`` cells in three parts; an element lies in one cell of each part.  A
cell holds how many elements it has, the xor of them and the xor of their checks.  Sketches of two
versions subtract cell by cell, which leaves the elements they differ in; cells of one element are pure,
and peeling them one part after the other recovers the difference.  Where cells are
left over, the pair is tried again with four times as many cells and other positions.

Cells are rows and their sums are aggregates: a long text is as many rows as it has
paragraphs, peeling is a chain of aggregates on one partitioning, and only pairs that
failed enter the next try.

Null texts count as empty; empty texts have no elements, and two of them are alike.  Rows need a unique
``key``, which is not null; equal texts have equal fingerprints.  Columns other than those asked for are dropped, so none can clash.
Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogproof.operators import scaling

#: words of a block of a long line
BLOCK = 32
#: pieces of a text, which together are the whole text; for Spark and for DuckDB
PIECE = rf"(?:[^ \n]* ){{{BLOCK}}}|[^\n]*\n|[^\n]+"
#: cells of a fingerprint, and of the first sketch that is peeled: multiples of three
CELLS, FIRST = 48, 96
#: how the cells of a retry grow, and the tries before the difference is taken from the elements themselves
GROWTH, TRIES = 4, 9
#: passes over the three parts of a sketch
PASSES = 3

_P = 2147483647
_STEP = 2654435769
#: multipliers of the three positions
_A = (1103515245, 1664525 * 641 + 1, 1597334677)
_B = (69621 * 7919 + 3, 1566083941, 1812433253)


def digests(text: Column) -> Column:
    """60-bit digests of the pieces of a text, in order."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))
    return F.transform(pieces, lambda p: F.conv(F.substring(F.md5(p), 1, 15), 16, 10).cast("bigint"))


def _tagged(digests: str, pair: int, side: int) -> Column:
    return F.transform(
        digests, lambda d: F.struct(d.alias("digest"), F.lit(pair).alias("pair"), F.lit(side).alias("side"))
    )


def elements(df: DataFrame, key: str, columns: list[tuple[str, int, int]]) -> DataFrame:
    """(key, pair, side, element): digests with the number of each among its equals.

    ``columns``: array column of digests, pair and side it stands for.  Partition ``df`` by
    ``key`` before, and nothing is shuffled.
    """
    tagged = F.flatten(F.array(*[_tagged(*c) for c in columns]))
    rows = df.select(key, F.explode(tagged).alias("p")).select(key, "p.*")
    counted = rows.groupBy(key, "pair", "side", "digest").agg(F.count(F.lit(1)).alias("times"))
    numbered = counted.withColumn("before", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)))
    return numbered.select(key, "pair", "side", F.col("digest").bitwiseXOR(F.col("before") * F.lit(_STEP)).alias("element"))


def _check(e: Column) -> Column:
    a, b = F.pmod(e, F.lit(_P)), F.pmod(F.shiftright(e, 20), F.lit(_P))
    return F.pmod(a * b + F.shiftright(e, 7), F.lit(_P))


def _place(e: Column, part: int, m: int, seed: int) -> Column:
    a, b = F.pmod(e, F.lit(_P)), F.pmod(F.shiftright(e, 29), F.lit(_P))
    h = F.pmod(a * F.lit(_A[part]), F.lit(_P)) + F.pmod(b * F.lit(_B[part]) + F.lit(seed * 7919 + part), F.lit(_P))
    return (F.pmod(F.pmod(h * F.lit(48271), F.lit(_P)), F.lit(m // 3)) + part * (m // 3)).cast("bigint")


def _row(cell: Column, found: Column | None, n: Column, ids: Column | None = None, checks: Column | None = None) -> Column:
    """A row of a sketch: a cell (``found`` is null), or something counted or found (ids and checks are 0)."""
    columns = {
        "cell": cell,
        "found": F.lit(None) if found is None else found,
        "n": n,
        "ids": F.lit(0) if ids is None else ids,
        "checks": F.lit(0) if checks is None else checks,
    }
    return F.struct(*[c.cast("bigint").alias(x) for x, c in columns.items()])


def _gather(rows: DataFrame, by: list[str]) -> DataFrame:
    summed = rows.groupBy(*by, "cell", "found").agg(
        F.sum("n").alias("n"), F.bit_xor("ids").alias("ids"), F.bit_xor("checks").alias("checks")
    )
    return summed.filter((F.col("n") != 0) | (F.col("ids") != 0) | (F.col("checks") != 0))


def cells(found: DataFrame, by: list[str], sign: Column, m: int, seed: int) -> DataFrame:
    """(by, cell, found, n, ids, checks): the sketch of the signed elements, cells that are not empty.

    Two rows of cell -2 count the elements of either sign in n.
    """
    e = F.col("element")
    inside = [_row(_place(e, k, m, seed), None, sign, e, _check(e)) for k in range(3)]
    counter = _row(F.lit(-2), F.when(sign > 0, -1).otherwise(-2), F.lit(1))
    return _gather(found.select(*by, F.explode(F.array(*inside, counter)).alias("r")).select(*by, "r.*"), by)


def fingerprint(df: DataFrame, key: str, columns: list[str], m: int = CELLS) -> DataFrame:
    """(key, and one string for each column): a sketch's cells as ``cell:n:ids:checks``, comma-joined."""
    found = elements(df.repartition(F.col(key)), key, [(c, i, 1) for i, c in enumerate(columns)])
    sketch = cells(found, [key, "pair"], F.lit(1), m, 0).filter(F.col("cell") >= 0)
    entry = F.struct("cell", F.concat_ws(":", "cell", "n", "ids", "checks").alias("s"))

    def joined(i: int) -> Column:
        own = F.array_sort(F.collect_list(F.when(F.col("pair") == i, entry)))
        return F.array_join(F.transform(own, lambda x: x["s"]), ",")

    return sketch.groupBy(key).agg(*[joined(i).alias(c) for i, c in enumerate(columns)])


def peel(sketch: DataFrame, by: list[str], m: int, seed: int) -> DataFrame:
    """The sketch with pure cells replaced by the elements they hold (rows with ``found`` >= 0, cell -1)."""
    state = sketch
    for part in [*range(3)] * PASSES:
        e, n = F.col("ids"), F.col("n")
        here = F.col("cell").between(part * (m // 3), (part + 1) * (m // 3) - 1)
        pure = here & (F.abs(n) == 1) & (F.col("checks") == _check(e)) & (F.col("cell") == _place(e, part, m, seed))
        others = [_row(_place(e, k, m, seed), None, -n, e, _check(e)) for k in range(3) if k != part]
        out = F.when(pure, F.array(*others, _row(F.lit(-1), e, n))).otherwise(
            F.array(_row(F.col("cell"), F.col("found"), n, e, F.col("checks")))
        )
        state = _gather(state.select(*by, F.explode(out).alias("r")).select(*by, "r.*"), by)
    return state


def _results(state: DataFrame, by: list[str]) -> DataFrame:
    def count(of: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("found") == of, F.col("n"))), F.lit(0))

    def only(sign: int) -> Column:
        return F.collect_list(F.when((F.col("cell") == -1) & (F.col("n") == sign), F.col("found")))

    return state.groupBy(*by).agg(
        count(-1).alias("n_left"),
        count(-2).alias("n_right"),
        only(1).alias("only_left"),
        only(-1).alias("only_right"),
        F.max(F.col("cell") >= 0).alias("failed"),
    )


def difference(versions: DataFrame, key: str, left: str, rights: list[str], m: int = FIRST) -> DataFrame:
    """(key, pair, n_left, n_right, only_left, only_right, tries), all of array columns of digests.

    ``pair`` is the place in ``rights`` of the column that ``left`` is compared with.  ``versions`` is
    read once per try: pass a written table.  Pairs without any element give no row.
    """
    by, done, again = [key, "pair"], [], None
    columns = [c for i, right in enumerate(rights) for c in ((left, i, 1), (right, i, -1))]
    for attempt in range(TRIES + 1):
        asked = versions.select(key, left, *rights)
        if again is not None:  # a row per key that has a pair to try again
            asked = asked.join(again.select(key).distinct(), key, "left_semi")
        found = elements(asked.repartition(F.col(key)), key, columns)
        if again is not None:
            found = found.join(again.repartition(F.col(key)), by, "left_semi")
        if attempt < TRIES:
            size = m * GROWTH**attempt
            state = peel(cells(found, by, F.col("side"), size, attempt), by, size, attempt)
        else:  # nothing is given up: the elements themselves cancel
            rows = F.array(
                _row(F.lit(-1), F.col("element"), F.col("side")),
                _row(F.lit(-2), F.when(F.col("side") > 0, -1).otherwise(-2), F.lit(1)),
            )
            state = _gather(found.select(*by, F.explode(rows).alias("r")).select(*by, "r.*"), by)
        result = scaling.materialize(_results(state, by).withColumn("tries", F.lit(attempt + 1)), "peeled")
        done.append(result.filter(~F.col("failed")).drop("failed"))
        again = result.filter("failed").select(*by)
        if again.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def likeness(result: DataFrame) -> Column:
    """Shared elements in relation to those of both sides (Dice), 1 for two empty texts."""
    differ = F.size("only_left") + F.size("only_right")
    both = F.col("n_left") + F.col("n_right")
    return F.when(both > 0, (both - differ) / both).otherwise(F.lit(1.0))
