"""Yearly lots: state, status, size estimates and assignment of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.operators import dedupe, scaling
from catalogproof.operators.reconcile import stage_status


def lot_counts(files: DataFrame, by: list[str]) -> DataFrame:
    """Per lot: documents, PDFs, markdown and bytes from flags on each manifest row.

    ``files`` carries ``has_pdf``, ``has_md`` and ``length``.
    """
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("has_pdf").alias("n_pdf"),
        F.count_if("has_md").alias("n_md"),
        F.coalesce(F.sum(F.when(F.col("has_pdf"), F.col("length"))), F.lit(0)).alias("bytes_pdf"),
    )


def lot_status(counts: DataFrame, state: DataFrame, per_hour: int = fx.FILES_PER_HOUR) -> DataFrame:
    """Status, backlog and hours left of each year; one row a year on both sides."""
    uploaded = state.filter(F.col("uploaded_at").isNotNull()).select("year", F.lit(True).alias("_up"))
    joined = counts.join(uploaded, "year", "left")
    status = stage_status(
        F.col("n_docs"), F.col("n_pdf"), F.col("n_md"), F.coalesce(F.col("_up"), F.lit(False))
    )
    backlog = F.when(F.col("status") == "pending", F.col("n_docs")).otherwise(F.lit(0)).cast("bigint")
    return joined.withColumn("status", status).select(
        *counts.columns,
        "status",
        backlog.alias("backlog"),
        (backlog / per_hour).alias("eta_hours"),
    )


def half_done_year(counts: DataFrame) -> DataFrame:
    """The newest year that has some of its files but not all."""
    part = (F.col("n_pdf") > 0) & (F.col("n_pdf") < F.col("n_docs"))
    return counts.filter(part).agg(F.max("year").alias("year"))


def estimated_bytes(docs: Column, year: Column) -> Column:
    kb = F.when(year >= fx.MODERN_FROM_YEAR, F.lit(fx.MODERN_KB)).otherwise(F.lit(fx.OLD_KB))
    return docs * kb * 1024


def lot_estimate(docs_per_year: DataFrame, free_bytes: int) -> DataFrame:
    """Expected size of each lot and whether it fits the free space with a margin."""
    size = estimated_bytes(F.col("n_docs"), F.col("year"))
    # whole numbers: the factor 1.3 as 13 / 10
    fits = F.lit(free_bytes).cast("bigint") * 10 >= size * int(fx.SPACE_FACTOR * 10)
    return docs_per_year.select("year", "n_docs", size.alias("est_bytes"), fits.alias("fits"))


def lot_backlog(years: DataFrame, state: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Years in range that are not marked uploaded."""
    if first is not None:
        years = years.filter(F.col("year") >= first)
    if last is not None:
        years = years.filter(F.col("year") <= last)
    return years.join(state.filter(F.col("uploaded_at").isNotNull()).select("year"), "year", "left_anti")


def already_uploaded(years: DataFrame, state: DataFrame) -> DataFrame:
    """Assigned years that need no work any more."""
    return years.select("year").intersect(
        state.filter(F.col("uploaded_at").isNotNull()).select("year")
    )


def upsert_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """One state per year: the row processed last wins, a new one over an old one."""
    both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
    latest = both.withColumn("_at", -F.unix_micros(F.col("processed_at").cast("timestamp")))
    return dedupe.keep_first(latest, ["year"], ["_at", "_age"]).drop("_age", "_at")


def mark_uploaded(state: DataFrame, years: DataFrame, at: Column) -> DataFrame:
    """Set ``uploaded_at`` and ``pending_ocr`` for the years given (year, n_retained)."""
    done = years.select("year", F.col("n_retained").cast("bigint").alias("_kept"))
    return state.join(done, "year", "left").select(
        *[
            {
                "uploaded_at": F.when(F.col("_kept").isNotNull(), at).otherwise(F.col("uploaded_at")),
                "pending_ocr": F.coalesce(F.col("_kept"), F.col("pending_ocr")),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in state.columns
        ]
    )


def assign(df: DataFrame, assignment: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Attach the assignee of each category or year; unknown ones stay null."""
    return scaling.join_dimension(df, assignment, keys, spread)


def assignment_outputs(df: DataFrame, assignment: DataFrame, key: str, scope: list[str] | None = None) -> DataFrame:
    """Rows per output: one output per assignee, and ``all`` only when nothing is left out.

    ``scope`` names the keys of this run; a partial run yields no full output, which
    would be mistaken for the whole corpus.
    """
    in_scope = df if scope is None else df.filter(F.col(key).isin(scope))
    people = F.broadcast(assignment) if scaling.counted_few(assignment) else assignment
    own = in_scope.join(people, key).withColumnRenamed("assignee", "output")
    if scope is not None:
        return own
    return own.unionByName(in_scope.withColumn("output", F.lit("all")).select(own.columns))


def assignment_balance(assigned: DataFrame) -> DataFrame:
    """Documents per assignee, and the spread between the most and the least loaded."""
    per = assigned.groupBy("assignee").agg(F.count(F.lit(1)).alias("n_docs"))
    span = per.agg(F.max("n_docs").alias("_max"), F.min("n_docs").alias("_min"))
    most, least = span.select("_max").scalar(), span.select("_min").scalar()
    return per.withColumn("spread", F.round(most / least, 4))
