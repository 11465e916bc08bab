"""Building blocks that keep order and group statistics exact on skewed, very large data.

* ``running`` / ``number_within``: running sums, maxima and row numbers inside a group
  that may hold a third of all rows, in windows of bounded size.
* ``global_rank``: order over any sort key, by range partitions.
* ``lookup`` / ``attach_stats``: left joins to one row per key that do not send a hot
  key to one task.
* ``explode_range``: integer ranges far longer than an array may be.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: a key with this many rows is hot, as long as it is among the HOT_KEYS hottest
HOT_ROWS, HOT_KEYS = 100_000, 10_000
#: second keys that the rows of one hot key are dealt over, at most
MOST_COPIES = 4096
#: rows and characters a dimension may have to be broadcast, after both were counted
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 32 << 20
#: bits of the order key per level, lowest first: leaf windows hold at most 2**10 full
#: rows and those above 2**18 totals, wherever in the 63 bits the keys lie
LEVEL_BITS = (10, 17, 18, 18)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's checkpoint folder."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="catalogproof-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage, computed once."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- order inside groups ----------------------------------------------------

_COMBINE = {"sum": F.sum, "max": F.max}


def _merge(kind: str, before: Column, own: Column) -> Column:
    """Value up to here, from what came before the bucket and what is inside it."""
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(own, F.lit(0))
    return F.greatest(before, own)  # ignores nulls


def _bucket_offsets(totals: DataFrame, group: list[str], kinds: dict[str, str], bits: tuple) -> DataFrame:
    """What precedes each bucket: (group, _bucket, one column per measure)."""
    keyed = totals.withColumn("_parent", F.shiftright("_bucket", bits[0]))
    within = W.partitionBy(*group, "_parent").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    local = keyed.select(
        *group, "_bucket", "_parent", *[_COMBINE[k](m).over(within).alias(m) for m, k in kinds.items()]
    )
    if len(bits) == 1:  # the whole key is used up: one parent is left per group
        return local.drop("_parent")
    parents = keyed.groupBy(*group, F.col("_parent").alias("_bucket")).agg(
        *[_COMBINE[k](m).alias(m) for m, k in kinds.items()]
    )
    above = _bucket_offsets(parents, group, kinds, bits[1:]).select(
        *group, F.col("_bucket").alias("_parent"), *[F.col(m).alias(f"_up_{m}") for m in kinds]
    )
    return local.join(above, [*group, "_parent"], "left").select(
        *group,
        "_bucket",
        *[_merge(k, F.col(f"_up_{m}"), F.col(m)).alias(m) for m, k in kinds.items()],
    )


def running(
    df: DataFrame,
    group: list[str],
    order: str,
    measures: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add running sums and maxima (current row included) along an integer key.

    ``order`` must be a unique whole number >= 0 within a group.  Rows are cut into
    buckets of 2**10 keys; only one total per bucket travels up the levels, so no
    window holds more than 1024 full rows however large the group is.
    """
    kinds = {name: kind for name, (kind, _) in measures.items()}
    # a struct equals itself with nulls inside, so windows and joins share one partitioning
    by = ["_group"] if group else []
    keyed = df.withColumns(
        {
            **({"_group": F.struct(*group)} if group else {}),
            "_bucket": F.shiftright(F.col(order).cast("bigint"), LEVEL_BITS[0]),
            **{f"_in_{n}": value for n, (_, value) in measures.items()},
        }
    )
    totals = keyed.groupBy(*by, "_bucket").agg(*[_COMBINE[k](f"_in_{m}").alias(m) for m, k in kinds.items()])
    offsets = _bucket_offsets(totals, by, kinds, LEVEL_BITS[1:]).select(
        *by, "_bucket", *[F.col(m).alias(f"_off_{m}") for m in kinds]
    )
    leaf = W.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = keyed.withColumns({f"_own_{m}": _COMBINE[k](f"_in_{m}").over(leaf) for m, k in kinds.items()})
    return local.join(offsets, [*by, "_bucket"], "left").select(
        *df.columns,
        *[_merge(k, F.col(f"_off_{m}"), F.col(f"_own_{m}")).alias(m) for m, k in kinds.items()],
    )


def number_within(df: DataFrame, group: list[str], order: str, out: str) -> DataFrame:
    """1-based position of each row in its group, by a unique integer key."""
    return running(df, group, order, {out: ("sum", F.lit(1).cast("bigint"))})


def global_rank(df: DataFrame, order: list[str], out: str, weight: str | None = None) -> DataFrame:
    """Add the running total of ``weight`` (default: 1 a row) over one global order.

    Range partitions are written once, so that their numbering is settled, and each is
    numbered on its own above the totals of those before it.  The key should be
    nearly unique: equal keys stay in one range.
    """
    spark = df.sparkSession
    value = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    ranged = materialize(
        df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range")), "ranges"
    )
    # one row per range: as many as there are shuffle partitions
    before = (
        ranged.groupBy("_range")
        .agg(F.sum(value).alias("_n"))
        .select(
            "_range",
            F.coalesce(
                F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
        )
    )
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        ranged.withColumn("_own", F.sum(value).over(inside))
        .join(F.broadcast(before), "_range")
        .withColumn(out, F.col("_before") + F.col("_own"))
        .drop("_range", "_own", "_before")
    )


# --- joins to one row per key -------------------------------------------------


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which null is a key like any other; the left side's keys stay."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def _hottest(counted: DataFrame, keys: list[str], count: str, hot_rows: int) -> DataFrame:
    """(_hot, _copies): at most HOT_KEYS digests of hot keys, whatever the size of the data and the width of the keys.

    ``_copies`` is over how many second keys the rows of a hot key are dealt: about hot_rows / 2
    rows each.  The digests decide ties, so that every evaluation takes the same.
    """
    hot = counted.filter(F.col(count) >= hot_rows).select(F.xxhash64(*keys).alias("_hot"), F.col(count).alias("_n"))
    copies = F.least(F.ceil(F.max("_n") * 2 / hot_rows), F.lit(MOST_COPIES)).cast("int")
    merged = hot.groupBy("_hot").agg(copies.alias("_copies"), F.max("_n").alias("_n"))
    return merged.orderBy(F.col("_n").desc(), "_hot").limit(HOT_KEYS).drop("_n")


def _join_split(df: DataFrame, hot: DataFrame, right: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Left join to ``right``, one row per key, on the key and a second key.

    The second key is a hash of the key and of a number below ``_copies`` of the key: on the left by turns,
    by a hash of ``spread``; on the right one row for each.  Keys that are not hot have one.  Rows without a
    key get a second key of their own.  As both sides compute it from the digest in ``hot`` (bounded, broadcast),
    two keys of one digest are dealt alike, and only equal keys meet.
    """
    values = [c for c in right.columns if c not in keys]

    def dealt(frame: DataFrame, number: Column, tag: str) -> DataFrame:
        marked = frame.withColumn("_digest", F.xxhash64(*keys)).join(
            F.broadcast(hot.withColumnRenamed("_hot", "_digest")), "_digest", "left"
        )
        return marked.withColumn(tag, number)

    turn = F.when(F.col("_copies").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.col("_copies")).cast("int"))
    every = F.explode(F.when(F.col("_copies").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_copies") - 1)))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    second = lambda n: F.xxhash64("_digest", n)
    left = dealt(df, turn, "_turn").withColumn("_second", F.when(no_key, F.xxhash64(spread)).otherwise(second("_turn")))
    # ``_second`` depends on columns of both sides, so the optimiser can neither fold it nor drop it
    other = dealt(right, every, "_turn").select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        F.struct(F.lit(1).alias("_found"), *values).alias("_right"),
        second("_turn").alias("_right_second"),
    )
    on = [F.col(k) == F.col(f"_right_{k}") for k in keys]
    joined = left.join(other, [*on, F.col("_second") == F.col("_right_second")], "left")
    return joined.select(*df.columns, *[F.col("_right")[v].alias(v) for v in values])


def attach_stats(
    df: DataFrame, stats: DataFrame, keys: list[str], count: str, spread: str, hot_rows: int | None = None
) -> DataFrame:
    """Left join per-key statistics whose ``count`` column says how many rows a key has.

    The rows of the hottest keys, at most HOT_KEYS, are dealt over several tasks.
    """
    return _join_split(df, _hottest(stats, keys, count, hot_rows or HOT_ROWS), stats, keys, spread)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """What ``lookup`` needs to know of the keys with many rows; written, for several lookups."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return materialize(_hottest(counted, keys, "_n", hot_rows or HOT_ROWS), "hot")


def lookup(
    df: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: str,
    hot_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with one row per key, whatever the skew of ``df`` and the width of the rows.

    The hot keys of ``df`` are counted first (combined before the shuffle) unless ``hot_keys`` did, and dealt over
    several tasks whether ``right`` has them or not.
    """
    if hot is None:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = _hottest(counted, keys, "_n", hot_rows or HOT_ROWS)
    return _join_split(df, hot, right, keys, spread)


def counted_few(df: DataFrame, max_rows: int | None = None) -> bool:
    """Has the table few enough rows and characters to broadcast?  Counts no further than the limit.

    Pass a table that is cheap to count (a literal or a written one).
    """
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    n, chars = df.limit(limit + 1).agg(F.count(F.lit(1)), size).first()
    return n <= limit and (chars or 0) <= BROADCAST_CHARS


def join_dimension(
    df: DataFrame, dim: DataFrame, keys: list[str], spread: str, max_rows: int | None = None
) -> DataFrame:
    """Left join to a table with one row per key: broadcast if it counts small, else ``lookup``."""
    if counted_few(dim, max_rows):
        return df.join(F.broadcast(dim), keys, "left")
    return lookup(df, dim, keys, spread)


def keep_matching(df: DataFrame, keys: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Inner join to a written table of unique keys, ``key`` being unique in ``df`` too.

    Counted few, the keys are broadcast in a semi join, which Spark moves down to the
    scan: what ``df`` computes is computed for matching rows only.
    """
    if counted_few(keys, max_rows):
        matching = df.join(F.broadcast(keys.select(key)), key, "left_semi")
        return matching.join(F.broadcast(keys), key)
    return df.join(keys, key)


# --- ranges --------------------------------------------------------------------


def explode_range(
    df: DataFrame, low: Column, high: Column, out: str, spread: list[str], block: int = 4096
) -> DataFrame:
    """One row per whole number in ``low..high``, in two steps with a shuffle between.

    Blocks first, then the numbers of each block, so one row's long range is worked
    on by all tasks and no array is longer than (range / block) or block.
    """
    blocks = (
        df.withColumns({"_low": low.cast("bigint"), "_high": high.cast("bigint")})
        .filter(F.col("_low") <= F.col("_high"))
        .withColumn(
            "_block",
            F.explode(F.sequence(F.floor(F.col("_low") / block), F.floor(F.col("_high") / block))),
        )
        # an explicit number keeps the small blocks from being coalesced into one task
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *spread, "_block")
    )
    first = F.greatest(F.col("_low"), F.col("_block") * block)
    last = F.least(F.col("_high"), F.col("_block") * block + (block - 1))
    return blocks.select(*df.columns, F.explode(F.sequence(first, last)).alias(out))
