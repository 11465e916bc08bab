"""Completeness audit, import review and recovery summaries, one row per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.operators import dedupe, pages, scaling


def _verdict(bad):
    return F.when(bad, F.lit("REVIEW")).otherwise(F.lit("OK"))


def audit_report(rows: DataFrame, chunks: DataFrame, page_size: int = fx.PAGE_SIZE) -> DataFrame:
    """Unique ids, pages, gaps, short pages, rows without link and incomplete chunks.

    ``rows`` are those of all chunks as they stand (repeats included) and ``chunks`` the
    flags of the chunk files (category, complete, and chunk_start, without which a line is a chunk).  A category none of whose chunks can
    be read still gets its row, under REVIEW.  The last row, without category, is the total.
    """
    # (category, page, id) once: the rest of the report adds up over it
    cells = rows.groupBy("category", "page", "record_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.col("link"), F.lit("")) == "").alias("n_without_link"),
    )
    per_page = cells.groupBy("category", "page").agg(
        F.sum("n").alias("n_rows"), F.sum("n_without_link").alias("n_without_link")
    )
    ids = (
        cells.select("category", "record_id")
        .distinct()
        .groupBy("category")
        .agg(F.count("record_id").alias("n_unique"))
    )
    summary = pages.page_summary(
        per_page, page_size, F.sum("n_without_link").alias("n_without_link")
    )
    if "chunk_start" in chunks.columns:  # a chunk of several objects counts once
        whole = F.bool_and(F.coalesce("complete", F.lit(False)))
        chunks = chunks.groupBy("category", "chunk_start").agg(whole.alias("complete"))
    flags = chunks.groupBy("category").agg(
        F.count_if(~F.coalesce(F.col("complete"), F.lit(False))).alias("n_incomplete_chunks")
    )
    zero = F.lit(0).cast("bigint")
    names = flags.select("category").union(summary.select("category")).distinct()
    report = (
        scaling.null_safe(
            scaling.null_safe(scaling.null_safe(names, flags, ["category"], "left"), summary, ["category"], "left"),
            ids,
            ["category"],
            "left",
        ).select(
            "category",
            *[
                F.coalesce(F.col(c), zero).alias(c)
                for c in (
                    "n_unique", "n_pages", "last_page", "n_missing", "n_short", "n_without_link",
                    "n_incomplete_chunks",
                )
            ],
        )
    )
    numbers = [c for c in report.columns if c != "category"]
    # per category rows and their total in one rollup; a null category is kept apart by its level
    rolled = report.rollup("category").agg(
        F.grouping("category").cast("int").alias("is_total"),
        *[(F.max(c) if c == "last_page" else F.sum(c)).alias(c) for c in numbers],
    )
    bad = (
        (F.col("n_missing") > 0)
        | (F.col("n_short") > 0)
        | (F.col("n_without_link") > 0)
        | (F.col("n_incomplete_chunks") > 0)
        | (F.col("n_pages") == 0)
    )
    return rolled.withColumn("verdict", _verdict(bad))


def import_review(rows: DataFrame, known: list[str], order: str, page_size: int = fx.PAGE_SIZE) -> DataFrame:
    """What an external table would bring in, per category, each id once."""
    unique = dedupe.keep_first(rows.select("category", "record_id", "page", order), ["category", "record_id"], [order])
    summary = pages.page_summary(pages.page_profile(unique), page_size)
    sizes = rows.groupBy("category").agg(F.count(F.lit(1)).alias("_all"))
    report = scaling.null_safe(summary, sizes, ["category"]).select(
        "category",
        F.col("n_rows").alias("n_unique"),
        (F.col("_all") - F.col("n_rows")).alias("n_duplicated"),
        "n_pages",
        "last_page",
        "n_missing",
        "n_overloaded",
        "n_no_page",
        F.coalesce(F.col("category").isin(known), F.lit(False)).alias("known"),
    )
    bad = (
        (F.col("n_missing") > 0)
        | (F.col("n_duplicated") > 0)
        | (F.col("n_overloaded") > 0)
        | (F.col("n_no_page") > 0)
        | ~F.col("known")
    )
    return report.withColumn("verdict", _verdict(bad))


def import_admit(rows: DataFrame, known: DataFrame, harvested: DataFrame, spread: str, force: bool = False) -> DataFrame:
    """Rows that may be imported: of known categories without chunks of their own.

    ``known`` and ``harvested`` list categories; ``force`` overrides the second rule.
    """
    admitted = known.select("category").distinct().withColumn("_known", F.lit(True))
    if not force:
        admitted = admitted.join(harvested.select("category"), "category", "left_anti")
    admitted = scaling.materialize(admitted, "admitted")
    return scaling.join_dimension(rows, admitted, ["category"], spread).filter("_known").drop("_known")


def category_totals(rows: DataFrame) -> DataFrame:
    """Rows and rows with a link per category, and in total (``is_total``)."""
    linked = F.coalesce(F.col("link"), F.lit("")) != ""
    return rows.rollup("category").agg(
        F.grouping("category").cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(linked).alias("n_with_link"),
    )


def mismatch_rollup(checked: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Link checks per category and in total, as counts and percentages."""
    kinds = ["ok", "mismatch", "no_file", "unreadable"]
    counted = checked.rollup("category").agg(
        F.grouping("category").cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(outcome) == k).alias(f"n_{k}") for k in kinds],
    )
    return counted.withColumns(
        {f"pct_{k}": F.round(F.coalesce(F.try_divide(F.col(f"n_{k}") * 100, F.col("n")), F.lit(0.0)), 4) for k in kinds}
    )


def recovery_summary(asked: DataFrame, attempts: DataFrame, recovered: DataFrame) -> DataFrame:
    """Pages asked, reviewed and failed, and new rows, per category."""
    zero = F.lit(0).cast("bigint")
    wanted = asked.groupBy("category").agg(F.count(F.lit(1)).alias("n_asked"))
    tried = attempts.groupBy("category").agg(
        F.count_if("ok").alias("n_reviewed"), F.count_if(~F.col("ok")).alias("n_failed")
    )
    fresh = recovered.groupBy("category").agg(F.count(F.lit(1)).alias("n_new"))
    return wanted.join(tried, "category", "left").join(fresh, "category", "left").select(
        "category", "n_asked", *[F.coalesce(F.col(c), zero).alias(c) for c in ("n_reviewed", "n_new", "n_failed")]
    )
