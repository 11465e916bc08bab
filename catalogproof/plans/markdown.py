"""Documents joined with their catalogue -> markdown, or a reject with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import documents as dx


def triage(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_pages``, ``cleaned``, ``n_chars`` and ``reason`` (null: usable)."""
    cleaned = documents.withColumn("cleaned", dx.strip_boilerplate(F.col(text)))
    return cleaned.withColumns(
        {
            "n_pages": dx.page_count(F.col(text)),
            "n_chars": F.length("cleaned"),
            "reason": dx.reject_reason(F.col(text), F.col("cleaned")),
        }
    )


def rejects(df: DataFrame) -> DataFrame:
    """Documents that need OCR: (record_id, path, reason, url, year), of triaged or converted ones."""
    return df.filter(F.col("reason").isNotNull()).select(
        "record_id", F.col("pdf_path").alias("path"), "reason", F.col("link").alias("url"), "year"
    )


def convert(triaged: DataFrame, keep_header_text: bool = False) -> DataFrame:
    """Every document with its markdown and sections, or with the reason it has none.

    One pass makes both outcomes.  Write the result (``sources.tables.write_converted``)
    and read either part from there: a filter on ``reason`` up here would clean each
    text twice, once for the filter and once for the markdown.
    """
    marks = F.when(F.col("reason").isNull(), dx.section_marks(F.col("cleaned")))
    marked = triaged.withColumn("_marks", marks).withColumn("sections", dx.section_names(F.col("_marks")))
    values = {name: F.col(name) for name in fx.FRONT_MATTER.values() if name != "section_list"}
    values["section_list"] = F.array_join(F.array_distinct("sections"), ", ")
    page = dx.markdown(
        dx.front_matter(values),
        F.col("case_type"),
        F.col("case_no"),
        F.col("summary"),
        dx.sectioned_body(F.col("_marks"), keep_header_text),
    )
    return marked.select(
        "record_id",
        "category",
        "year",
        "pdf_path",
        "md_path",
        "link",
        "reason",
        F.when(F.col("reason").isNull(), page).alias("markdown"),
        "sections",
    )


def section_frequency(sectioned: DataFrame, sections: str = "sections") -> DataFrame:
    """Share of documents that have each section, a document counted once."""
    n_docs = sectioned.agg(F.count(F.lit(1))).scalar()
    found = sectioned.select(F.explode(F.array_distinct(sections)).alias("section"))
    return found.groupBy("section").agg(F.count(F.lit(1)).alias("n_docs")).withColumn(
        "share", F.col("n_docs") / n_docs
    )


def section_rows(documents: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per section of each document; a lead without text is left out."""
    marked = documents.select(*keep, dx.section_marks(F.col(text)).alias("_marks"))
    rows = marked.select(*keep, F.inline(dx.section_parts(F.col("_marks"))))
    return rows.filter(F.col("section").isNotNull() | (F.col("body") != ""))
