"""Records -> cleaned table -> gate -> manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof.functions import quality as ql
from catalogproof.functions import text as tx
from catalogproof.operators import checks, scaling
from catalogproof.operators.canonical import canonicalize
from catalogproof.operators.dedupe import content_digest, content_duplicates, repeated_ids
from catalogproof.schemas import CATEGORY_COLUMNS, CLEAN_COLUMNS, RECORD_COLUMNS, TEXT_COLUMNS


def clean_records(records: DataFrame, order: str = "row_id") -> DataFrame:
    """Cleaned table: the twelve record columns, the derived ones after them, then ``order``.

    Nothing is removed and no row moves; duplicates and doubts are flagged.
    """
    cleaned = records.withColumns(
        {c: tx.clean_text(F.col(c)) for c in [*TEXT_COLUMNS, "case_no", "link"]}
    )
    cleaned = canonicalize(cleaned, CATEGORY_COLUMNS, order)
    flagged = cleaned.withColumns(
        {
            "summary_had_prefix": tx.had_label(F.col("summary")),
            "summary": tx.strip_label(F.col("summary")),
            "record_id": tx.extract_id(F.col("link")),
            "ruling_date": ql.ruling_date(F.col("ruling_date_raw")),
            "case_year": ql.case_year(F.col("case_no")),
        }
    ).withColumn("year", F.year("ruling_date"))
    derived = flagged.withColumns(
        {
            "summary_useful": ql.summary_useful(F.col("summary")),
            "date_incoherent": ql.date_incoherent(F.col("year"), F.col("case_year")),
            "pdf_path": ql.pdf_path(
                F.col("case_type"), F.col("case_no"), F.col("category"), F.col("record_id"), F.col("year")
            ),
        }
    ).withColumn("md_path", ql.md_path(F.col("pdf_path")))
    # texts are cleaned once: flags, group heads and the result are read from what is written here.  Flags are worked
    # out on ids and digests; the wide rows are joined once, by row id
    written = scaling.materialize(derived.withColumn("_digest", content_digest()), "derived")
    narrow, derived = written.select(order, "record_id", "_digest"), written.drop("_digest")
    flags = content_duplicates(derived, order, digests=narrow).join(
        repeated_ids(narrow, "record_id", order).withColumn("id_repeated", F.lit(True)), order, "full_outer"
    )
    marked = derived.join(flags, order, "left").withColumns(
        {
            "id_repeated": F.coalesce("id_repeated", F.lit(False)),
            "is_content_dup": F.col("dup_group").isNotNull(),
            "is_droppable_copy": F.coalesce("is_droppable_copy", F.lit(False)),
        }
    )
    return marked.select(*RECORD_COLUMNS, *CLEAN_COLUMNS, order)


def manifest(cleaned: DataFrame) -> DataFrame:
    """One row per record with its link and destination paths."""
    return cleaned.select(
        "record_id",
        F.col("link").alias("url"),
        F.col("pdf_path").alias("path"),
        F.col("md_path").alias("path_md"),
        "case_no",
        "ruling_date",
        "year",
        "category",
        "id_repeated",
    )


def publish(before: DataFrame, cleaned: DataFrame, write, order: str = "row_id") -> DataFrame:
    """Write the cleaned table only if every conservation check passes.

    ``write`` receives the cleaned table.  Returns the checks; nothing is written when
    one of them counts a violation.
    """
    settled = scaling.materialize(cleaned, "cleaned")
    result = scaling.materialize(checks.conservation_check(before, settled, order), "checks")
    if result.filter("violations > 0").limit(1).count() == 0:
        write(settled)
    return result
