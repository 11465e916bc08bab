"""Manifest against what is stored: pending, stale, releasable and retained work.

Inventories hold one row per path and rejects are plain id lists, so semi and anti
joins need no distinct: AQE can then split a skewed side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import quality as ql


def pending(manifest: DataFrame, valid_files: DataFrame, key: str) -> DataFrame:
    """Manifest rows without a valid stored file."""
    return manifest.join(valid_files.select(key), key, "left_anti")


def downloaded(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Manifest rows whose file is stored."""
    return manifest.join(files.select(key), key, "left_semi")


def retry_set(manifest: DataFrame, rejects: list[DataFrame], key: str) -> DataFrame:
    """Manifest rows that any of the reject lists names."""
    failed = rejects[0].select(key)
    for more in rejects[1:]:
        failed = failed.unionByName(more.select(key))
    return manifest.join(failed, key, "left_semi")


def stale_outputs(inputs: DataFrame, outputs: DataFrame, key: str, in_time: str, out_time: str) -> DataFrame:
    """Inputs whose output is missing, or older than the input."""
    made = outputs.select(key, out_time)
    old = F.col(out_time).isNull() | (F.col(out_time) < F.col(in_time))
    return inputs.join(made, key, "left").filter(old)


def reconcile(manifest: DataFrame, pdfs: DataFrame, markdown: DataFrame, pdf_key: str, md_key: str) -> DataFrame:
    """Documents, stored PDFs and markdown per year and category, checked file by file.

    When both keys are the same column one shuffle of the manifest serves both joins.
    Years without any file are left out.
    """
    has_pdf = pdfs.select(pdf_key).withColumn("_pdf", F.lit(True))
    has_md = markdown.select(md_key).withColumn("_md", F.lit(True))
    seen = manifest.join(has_pdf, pdf_key, "left").join(has_md, md_key, "left")
    n_docs = F.count(F.lit(1)).alias("n_docs")
    per = seen.groupBy("year", "category").agg(
        n_docs, F.count("_pdf").alias("n_pdf"), F.count("_md").alias("n_md")
    )
    complete = (F.col("n_pdf") == F.col("n_docs")) & (F.col("n_md") == F.col("n_docs"))
    alive = (
        per.groupBy("year")
        .agg(F.sum(F.col("n_pdf") + F.col("n_md")).alias("_files"))
        .filter("_files > 0")
        .select("year")
    )
    return per.join(alive, "year", "left_semi").select(
        "year",
        "category",
        "n_docs",
        "n_pdf",
        "n_md",
        (F.col("n_docs") - F.col("n_pdf")).alias("missing_pdf"),
        (F.col("n_docs") - F.col("n_md")).alias("missing_md"),
        F.when(complete, F.lit("COMPLETE")).otherwise(F.lit("MISSING")).alias("status"),
    )


def mark_releasable(pdfs: DataFrame, markdown: DataFrame, path: str = "path") -> DataFrame:
    """Flag each stored PDF whose markdown (same path, other suffix) exists."""
    made = markdown.select(F.col(path).alias("_md_path")).withColumn("_made", F.lit(True))
    keyed = pdfs.withColumn("_md_path", ql.md_path(F.col(path)))
    return (
        keyed.join(made, "_md_path", "left")
        .withColumn("releasable", F.col("_made").isNotNull())
        .drop("_md_path", "_made")
    )


def releasable_totals(marked: DataFrame, by: list[str], size: str = "length") -> DataFrame:
    """Files and bytes that may go, files that must stay."""
    ok = F.col("releasable")
    return marked.groupBy(*by).agg(
        F.count_if(ok).alias("n_releasable"),
        F.coalesce(F.sum(F.when(ok, F.col(size))), F.lit(0)).alias("bytes_releasable"),
        F.count_if(~ok).alias("n_retained"),
    )


def stage_status(docs: Column, pdfs: Column, md: Column, uploaded: Column) -> Column:
    """Where a year stands; the first rule that holds wins."""
    share = fx.DONE_SHARE
    return (
        F.when(uploaded, F.lit("uploaded"))
        .when((pdfs >= docs * share) & (md >= pdfs * share), F.lit("ready"))
        .when(pdfs >= docs * share, F.lit("ocr missing"))
        .when(pdfs > 0, F.lit("half done"))
        .otherwise(F.lit("pending"))
    )
