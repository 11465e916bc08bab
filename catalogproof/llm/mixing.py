"""Mix sources to target weights along a curriculum that changes with time.

Each source has a weight schedule over training time 0 to 1, linear between its knots.  The
integral of a schedule is the source's weight; the weights share the budget, and a source
stops at ``max_epochs`` times its size, the excess going to the others by weight until nobody is above.
The normed integral up to time t says which part of a source's target is due by t.  Documents of a
source lie in a fixed random order, end to end, one epoch after the other; the time at
which a document's first word is due - the inverse of that integral - is its training
position.  The mix is range-sorted by position.

Whole documents are taken: all full epochs, then those that fit wholly in what is left of the
target, then the one other document that brings the total nearest to it, if one does.

No source is gathered in one task: the random order is cut into about sqrt(n) buckets of about
sqrt(n) documents, a running sum is kept within buckets and over the buckets' totals.  Only the
table of sources, one row each, is ordered as a whole.

Null sources are one source, last in order; null sizes count as 0.  Documents of size 0 and sources
without words are never taken.  Rows that repeat are documents of their own.  Ties in the random order
are rows equal in key, id and size, which may stand for each other.  Empty tables
give empty results.  Columns that begin with an underscore are the operator's own; an input column
called like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.operators import scaling

OUTPUT = ["source_size", "target", "copies", "taken", "position"]


def source_table(docs: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """(source, source_size, n): one row per source, combined before the shuffle."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0))), F.lit(0)).cast("bigint").alias("source_size"),
        F.count(F.lit(1)).alias("n"),
    )


def integrate(schedule: DataFrame) -> DataFrame:
    """Schedule rows (source, at, weight) -> (source, weight, parts): the integral, and its pieces.

    A piece is (t0, h, w0, w1, before): a trapezoid and the integral up to it.  There are as many as
    the schedule has knots.
    """
    knots = schedule.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").cast("double").alias("at"), F.col("weight").cast("double").alias("weight")))).alias("k")
    )
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("k") - 1),
        lambda i: F.struct(
            F.get("k", i - 1)["at"].alias("t0"),
            (F.get("k", i)["at"] - F.get("k", i - 1)["at"]).alias("h"),
            F.get("k", i - 1)["weight"].alias("w0"),
            F.get("k", i)["weight"].alias("w1"),
        ),
    )
    area = lambda p: (p["w0"] + p["w1"]) / 2 * p["h"]
    total = lambda ps: F.aggregate(ps, F.lit(0.0), lambda a, p: a + area(p))
    cut = knots.filter(F.size("k") > 1).withColumn("p", F.filter(pieces, lambda p: p["h"] > 0))
    parts = F.transform(
        "p",
        lambda p, i: F.struct(
            p["t0"].alias("t0"),
            p["h"].alias("h"),
            p["w0"].alias("w0"),
            p["w1"].alias("w1"),
            total(F.slice("p", F.lit(1), i)).alias("before"),
        ),
    )
    return cut.select("source", total(F.col("p")).alias("weight"), parts.alias("parts"))


def share_out(sources: DataFrame, max_epochs: int, budget: Column | None = None) -> DataFrame:
    """Add ``target``: by weight, none above ``max_epochs`` times its size, the excess reshared.

    In the order in which sources fill up, those that do stop at their cap and the rest
    divide what is left; that is where resharing round by round ends.
    """
    cap = F.col("source_size") * max_epochs
    everything = W.partitionBy()
    filling = everything.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    onwards = filling.rowsBetween(W.currentRow, W.unboundedFollowing)
    total = F.sum("source_size").over(everything) if budget is None else budget
    ranked = sources.filter(F.col("weight") > 0).withColumn("_cap", cap)
    ranked = ranked.withColumns(
        {
            "_left": total - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
            "_weights": F.sum("weight").over(onwards),
        }
    ).withColumn("_full", F.col("_cap") * F.col("_weights") <= F.col("_left") * F.col("weight"))
    # what the first that does not fill up sees holds for all after it
    first = F.first(F.when(~F.col("_full"), F.struct("_left", "_weights")), ignorenulls=True).over(
        filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        first["_left"] * F.col("weight") / first["_weights"]
    )
    return ranked.withColumn("target", target).drop("_cap", "_left", "_weights", "_full")


def due(offset: Column, target: Column, weight: Column, parts: Column) -> Column:
    """The time at which so many words of a source are due: the inverse of the integral."""
    wanted = offset / target * weight
    reached = F.filter(parts, lambda p: p["before"] <= wanted)
    p = F.try_element_at(reached, F.lit(-1))
    rest = wanted - p["before"]
    slope = (p["w1"] - p["w0"]) / p["h"]
    root = F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * slope * rest, F.lit(0.0)))
    step = F.when(rest > 0, F.least(2 * rest / F.nullif(p["w0"] + root, F.lit(0.0)), p["h"])).otherwise(F.lit(0.0))
    return p["t0"] + step


def random_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _offsets(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``_before``: words of the source's documents that precede in the random order.

    ``keyed`` has _group, _key, _id, _size; ``plan`` one row for each _group.
    """
    spread = keyed.withColumn("_spread", F.xxhash64("_key"))
    joined = scaling.join_dimension(spread, plan, ["_group"], "_spread")
    unit = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    buckets = F.coalesce(F.ceil(F.sqrt("_n")), F.lit(1024))  # sources without words are not planned
    bucketed = joined.withColumn("_bucket", F.floor(unit * buckets))
    totals = bucketed.groupBy("_group", "_bucket").agg(F.sum("_size").alias("_sum"))
    behind = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    above = totals.select(
        "_group", "_bucket", F.coalesce(F.sum("_sum").over(behind), F.lit(0)).cast("bigint").alias("_above")
    )
    inside = W.partitionBy("_group", "_bucket").orderBy("_key", "_id", "_size")
    own = F.coalesce(F.sum("_size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    twin = F.lag(F.struct("_key", "_id", "_size")).over(inside) == F.struct("_key", "_id", "_size")
    placed = bucketed.withColumns({"_own": own, "_twin": F.coalesce(twin, F.lit(False))})
    return (
        placed.join(above, ["_group", "_bucket"])
        .withColumn("_before", F.col("_above") + F.col("_own"))
        .drop("_spread", "_bucket", "_above", "_own")
    )


def place(
    docs: DataFrame,
    schedule: DataFrame,
    source: str = "source",
    size: str = "size",
    doc_id: str = "doc_id",
    max_epochs: int = 3,
    seed: int = 0,
) -> DataFrame:
    """Every row of ``docs`` with source_size, target, copies, taken and position (of its first copy)."""
    keyed = docs.drop(*OUTPUT).withColumns(
        {
            "_group": F.struct(F.col(source).alias("source")),
            "_key": random_key(F.col(doc_id), seed),
            "_id": F.col(doc_id),
            "_size": F.coalesce(F.col(size), F.lit(0)).cast("bigint"),
        }
    )
    narrow = scaling.materialize(keyed.select("_group", "_key", "_id", "_size"), "sizes")
    sources = source_table(narrow.select("_group.source", "_size"), size="_size")
    weighted = (
        sources.join(integrate(schedule).withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left")
        .drop("_of")
    )
    targets = share_out(weighted, max_epochs).filter(F.col("source_size") > 0)
    full = F.floor(F.col("target") / F.col("source_size") + 1e-9)
    plan = scaling.materialize(
        targets.select(
            F.struct("source").alias("_group"),
            F.col("n").alias("_n"),
            F.col("source_size").alias("_total"),
            F.col("target").alias("_target"),
            F.col("weight").alias("_weight"),
            F.col("parts").alias("_parts"),
            full.alias("_full"),
            (F.col("target") - full * F.col("source_size")).alias("_rest"),
        ),
        "targets",
    )
    # what the last epoch takes in order, and the one more document that fits best
    running = scaling.materialize(
        _offsets(narrow, plan.drop("_parts", "_weight")).select(
            "_group", "_key", "_id", "_size", "_rest", (F.col("_before") + F.col("_size")).alias("_end")
        ),
        "running",
    )
    filled = running.groupBy("_group").agg(
        F.coalesce(F.max(F.when(F.col("_end") <= F.col("_rest"), F.col("_end"))), F.lit(0)).cast("bigint").alias("_filled")
    )
    gap = F.col("_rest") - F.col("_filled")
    with_filled = scaling.join_dimension(
        running.withColumn("_spread", F.xxhash64("_key")), scaling.materialize(filled, "filled"), ["_group"], "_spread"
    )
    fit = (
        with_filled.filter((F.col("_end") > F.col("_rest")) & (F.abs(gap - F.col("_size")) < gap))
        .groupBy("_group")
        .agg(F.min(F.struct(F.abs(gap - F.col("_size")).alias("miss"), "_key", "_id", "_size")).alias("_fit"))
    )
    plan = scaling.materialize(
        plan.join(filled, "_group", "left").join(
            fit.select("_group", F.col("_fit._key").alias("_fit_key"), F.col("_fit._id").alias("_fit_id"), F.col("_fit._size").alias("_fit_size")),
            "_group",
            "left",
        ),
        "plan",
    )
    placed = _offsets(keyed, plan)
    in_order = F.col("_before") + F.col("_size") <= F.col("_rest")
    is_fit = (
        (F.col("_key") == F.col("_fit_key"))
        & F.col("_id").eqNullSafe(F.col("_fit_id"))
        & (F.col("_size") == F.col("_fit_size"))
        & ~F.col("_twin")
        & ~in_order
    )
    extra = F.when(in_order | F.coalesce(is_fit, F.lit(False)), 1).otherwise(0)
    copies = F.when(F.col("_size") > 0, F.coalesce(F.col("_full"), F.lit(0)) + extra).otherwise(0).cast("int")
    start = F.when(F.coalesce(is_fit, F.lit(False)) & (F.col("_full") == 0), F.col("_filled")).otherwise(F.col("_before"))
    return placed.withColumns({"copies": copies, "_start": start}).select(
        *[c for c in docs.columns if c not in OUTPUT],
        F.coalesce(F.col("_total"), F.lit(0)).alias("source_size"),
        F.coalesce(F.col("_target"), F.lit(0.0)).alias("target"),
        "copies",
        (F.col("copies") * F.col("_size")).alias("taken"),
        F.when(F.col("copies") > 0, due(F.col("_start"), F.col("_target"), F.col("_weight"), F.col("_parts"))).alias(
            "position"
        ),
        "_key",
        "_start",
        "_total",
        "_target",
        "_weight",
        "_parts",
    )


def in_training_order(placed: DataFrame) -> DataFrame:
    """Range-sorted by position; documents that are not taken come last, in ranges of their random key."""
    order = [F.col("position").asc_nulls_last(), F.col("_key")]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, schedule: DataFrame, **options) -> DataFrame:
    """The mix itself: one row for each copy taken, with ``copy`` and its own position, in training order."""
    kept = [c for c in docs.columns if c not in [*OUTPUT, "copy"]]
    copies = (
        place(docs, schedule, **options)
        .filter(F.col("copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("_at", F.col("_start") + F.col("copy") * F.col("_total"))
    )
    at = F.least(due(F.col("_at"), F.col("_target"), F.col("_weight"), F.col("_parts")), F.lit(1.0))
    return in_training_order(copies.select(*kept, "_key", "copy", at.alias("position"))).drop("_key")
