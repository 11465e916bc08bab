"""Completeness of a paginated catalogue: missing, short and overloaded pages, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.operators import scaling


def chunk_start(page: Column, size: int = fx.CHUNK_PAGES) -> Column:
    return (page - F.pmod(page - 1, F.lit(size))).cast("bigint")


def chunk_end(start: Column, last: Column, size: int = fx.CHUNK_PAGES) -> Column:
    return F.least(start + (size - 1), last).cast("bigint")


def page_profile(rows: DataFrame) -> DataFrame:
    """Rows per page of each category; everything below works on this small table."""
    return rows.groupBy("category", "page").agg(F.count(F.lit(1)).alias("n_rows"))


def page_summary(profile: DataFrame, page_size: int = fx.PAGE_SIZE, *more: Column) -> DataFrame:
    """One row per category: pages, last page, missing, short, overloaded, rows without page.

    ``more`` adds aggregates over the profile's other columns.
    """
    valid = F.col("page") >= 1
    last = F.max("page")
    short_last = F.when(F.max_by("n_rows", "page") < page_size, F.lit(1)).otherwise(F.lit(0))
    return profile.groupBy("category").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_pages"),
        last.cast("bigint").alias("last_page"),
        (F.greatest(last, F.lit(0)) - F.count_if(valid)).cast("bigint").alias("n_missing"),
        # the last page may be short
        (F.count_if(F.col("n_rows") < page_size) - short_last).alias("n_short"),
        F.count_if(F.col("n_rows") > page_size).alias("n_overloaded"),
        F.coalesce(F.sum(F.when(F.col("page") == 0, F.col("n_rows"))), F.lit(0)).alias("n_no_page"),
        *more,
    )


def missing_pages(profile: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(category, last_page, page) for each page of 1..last that has no row.

    The last page is the highest one seen, so lost trailing pages stay invisible unless
    ``expected`` (category, last_page) says how many there should be.
    """
    last = (
        profile.groupBy("category").agg(F.max("page").cast("bigint").alias("last_page"))
        if expected is None
        else expected.select("category", F.col("last_page").cast("bigint"))
    )
    every = scaling.explode_range(last, F.lit(1), F.col("last_page"), "page", ["category"])
    return every.join(profile.select("category", "page"), ["category", "page"], "left_anti").select(
        "category", "last_page", "page"
    )


def short_pages(profile: DataFrame, page_size: int = fx.PAGE_SIZE) -> DataFrame:
    """Pages with fewer rows than they should have; the last of a category may be short."""
    last = profile.groupBy("category").agg(F.max("page").alias("page"))
    return profile.filter(F.col("n_rows") < page_size).join(last, ["category", "page"], "left_anti")


def overloaded_pages(profile: DataFrame, page_size: int = fx.PAGE_SIZE) -> DataFrame:
    return profile.filter(F.col("n_rows") > page_size)


def chunk_status(profile: DataFrame) -> DataFrame:
    """Chunks that have rows: (category, chunk_start, chunk_end, complete, failed).

    Pages below 1 belong to no chunk.  ``failed`` lists at most one chunk's pages.
    """
    last = profile.groupBy("category").agg(F.max("page").cast("bigint").alias("last_page"))
    # the chunk that holds the last page ends there; the others are full
    ends = last.select("category", chunk_start(F.col("last_page")).alias("chunk_start"), "last_page")
    seen = (
        profile.filter(F.col("page") >= 1)
        .groupBy("category", chunk_start(F.col("page")).alias("chunk_start"))
        .agg(F.collect_set(F.col("page").cast("int")).alias("seen"))
    )
    ended = seen.join(ends, ["category", "chunk_start"], "left").withColumn(
        "chunk_end",
        F.coalesce(F.col("last_page"), F.col("chunk_start") + (fx.CHUNK_PAGES - 1)),
    )
    failed = F.array_except(
        F.sequence(F.col("chunk_start").cast("int"), F.col("chunk_end").cast("int")), F.col("seen")
    )
    return ended.select(
        "category",
        "chunk_start",
        "chunk_end",
        (F.size(failed) == 0).alias("complete"),
        failed.alias("failed"),
    )


def chunks_to_redo(profile: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Chunks with a missing page, and those flagged incomplete when they were written."""
    missing = missing_pages(profile)
    start = chunk_start(F.col("page"))
    holes = missing.select("category", start.alias("chunk_start"), chunk_end(start, F.col("last_page")).alias("chunk_end"))
    if flagged is not None:
        holes = holes.unionByName(
            flagged.filter(~F.coalesce(F.col("complete"), F.lit(False))).select(
                "category", "chunk_start", "chunk_end"
            )
        )
    return holes.distinct()


def pending_chunks(totals: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks of 1..total_pages that no complete chunk file covers.

    A category of unknown size (null) yields no chunk here; see ``unmeasured``.
    """
    last = (F.col("total_pages") - 1) / fx.CHUNK_PAGES
    chunks = scaling.explode_range(
        totals.filter(F.col("total_pages") >= 1), F.lit(0), F.floor(last), "_chunk", ["category"]
    )
    start = F.col("_chunk") * fx.CHUNK_PAGES + 1
    planned = chunks.select(
        "category",
        start.cast("bigint").alias("chunk_start"),
        chunk_end(start, F.col("total_pages")).alias("chunk_end"),
    )
    finished = done.filter(F.coalesce(F.col("complete"), F.lit(False))).select("category", "chunk_start")
    return planned.join(finished, ["category", "chunk_start"], "left_anti")


def unmeasured(totals: DataFrame) -> DataFrame:
    """Categories whose size is unknown: they are pending, not empty."""
    return totals.filter(F.col("total_pages").isNull()).select("category")


def failure_streaks(
    attempts: DataFrame, group: list[str], order: str, failed: str, cut: int, bounded: bool = False
) -> DataFrame:
    """Add ``streak`` (failures in a row so far) and ``written_off``.

    At ``cut`` failures in a row the rest of the group is given up: its later attempts
    count as failed.  Works for groups of any length, one whole run included; say
    ``bounded`` where a group is no more than a chunk, and one window serves.
    """
    bad = F.col(failed)
    upto = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)

    def running(df: DataFrame, out: str, kind: str, value: Column) -> DataFrame:
        if bounded:
            return df.withColumn(out, {"sum": F.sum, "max": F.max}[kind](value).over(upto))
        return scaling.running(df, group, order, {out: (kind, value)})

    counted = running(attempts, "_bad", "sum", bad.cast("bigint"))
    streaks = running(counted, "_base", "max", F.when(~bad, F.col("_bad"))).withColumn(
        "streak",
        F.when(bad, F.col("_bad") - F.coalesce(F.col("_base"), F.lit(0))).otherwise(F.lit(0)).cast("bigint"),
    )
    # given up from the attempt after the one that reached the cut first
    reached = streaks.filter(F.col("streak") == cut)
    if bounded:
        hit = F.min(F.when(F.col("streak") == cut, F.col(order))).over(upto)
        marked = streaks.withColumn("_cut_at", hit)
    elif not group:
        marked = streaks.withColumn("_cut_at", reached.agg(F.min(order)).scalar())
    else:
        key = F.struct(*group).alias("_key")
        first = reached.groupBy(key).agg(F.min(order).alias("_cut_at"))
        marked = scaling.lookup(streaks.select("*", key), first, ["_key"], order)
    written_off = F.coalesce(F.col(order) > F.col("_cut_at"), F.lit(False))
    return marked.withColumn("written_off", written_off).select(*attempts.columns, "streak", "written_off")


def splice_recovered(base: DataFrame, recovered: DataFrame, order: str) -> DataFrame:
    """Recovered rows join the end of their own page.

    Adds the sort key: ``category_rank_row`` (first row of the category in ``base``; new
    categories last), then page, then ``is_recovered``, then the row's own order.
    Sort by ``SPLICE_ORDER`` to write the result in sequence.
    """
    ranks = scaling.materialize(
        base.groupBy("category").agg(F.min(order).alias("category_rank_row")), "category-ranks"
    )
    both = base.withColumn("is_recovered", F.lit(False)).unionByName(
        recovered.withColumn("is_recovered", F.lit(True))
    )
    return scaling.join_dimension(both, ranks, ["category"], order)


SPLICE_ORDER = ["category_rank_row", "page", "is_recovered"]
