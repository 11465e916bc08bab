"""Dates, quality flags, destination paths and stored-file checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import text as tx


def ruling_date(raw: Column) -> Column:
    """Strict day/month/year; anything else is null.

    Dates a nanosecond timestamp cannot hold are null as well, as in the
    established results.
    """
    parsed = F.try_to_timestamp(raw, F.lit("d/M/yyyy")).cast("date")
    day = F.when(raw.rlike(r"^\d{1,2}/\d{1,2}/\d{4}\z"), parsed)
    in_range = day.between(F.lit("1677-09-22").cast("date"), F.lit("2262-04-11").cast("date"))
    return F.when(in_range, day)


def case_year(case_no: Column) -> Column:
    return F.regexp_extract(case_no, r"-(\d{4})$", 1).try_cast("int")


def date_incoherent(year: Column, of_case: Column) -> Column:
    return F.coalesce(year < of_case, F.lit(False))


def summary_useful(summary: Column, min_chars: int = fx.SUMMARY_MIN_CHARS) -> Column:
    return F.coalesce(F.length(summary) >= min_chars, F.lit(False))


def pdf_path(
    case_type: Column, case_no: Column, category: Column, record_id: Column, year: Column
) -> Column:
    """``<category>/<year>/<type>-<number>-<id8>.pdf``; empty parts are left out."""
    kind = F.when(tx.is_blank(case_type), F.lit(fx.NO_CASE_TYPE)).otherwise(case_type)
    number = F.regexp_replace(F.coalesce(case_no, F.lit("")), "[^0-9-]", "")
    short_id = F.left(F.coalesce(record_id, F.lit("")), F.lit(fx.ID_CHARS_IN_PATH))
    name = F.concat_ws(
        "-",
        tx.slug(kind, fx.NO_CATEGORY),
        tx.blank_to_null(number),
        tx.blank_to_null(short_id),
    )
    folder = F.coalesce(year.cast("string"), F.lit(fx.NO_YEAR))
    return F.concat(F.concat_ws("/", tx.slug(category, fx.NO_CATEGORY), folder, name), F.lit(".pdf"))


def md_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.pdf$", ".md")


def id_well_formed(record_id: Column) -> Column:
    return F.coalesce(record_id.rlike(rf"^(?:{fx.ID_FORMAT})\z"), F.lit(False))


def path_well_formed(path: Column) -> Column:
    return F.coalesce(path.rlike(rf"^(?:{fx.PATH_FORMAT})\z"), F.lit(False))


def id_match(link_id: Column, sheet_id: Column) -> Column:
    """Compare the id of the link with the id of the record's own sheet."""
    return (
        F.when(link_id.isNull(), F.lit("no_file"))
        .when(sheet_id.isNull(), F.lit("unreadable"))
        .when(link_id == sheet_id, F.lit("ok"))
        .otherwise(F.lit("mismatch"))
    )


def _holds(content: Column, mark: str) -> Column:
    return F.contains(content, F.lit(mark.encode("ascii")))


def blob_valid(content: Column, length: Column | None = None) -> Column:
    """A stored file counts when it is long enough and starts like a PDF."""
    size = F.length(content) if length is None else length
    head = F.substring(content, 1, len(fx.PDF_HEAD)) == F.lit(fx.PDF_HEAD.encode("ascii"))
    return F.coalesce((size >= fx.PDF_MIN_BYTES) & head, F.lit(False))


def blob_kind(content: Column) -> Column:
    """Scanned, native or mixed, from the image filters and fonts inside."""
    font = _holds(content, fx.FONT_MARK)
    image = F.lit(False)
    for mark in fx.IMAGE_FILTERS:
        image = image | _holds(content, mark)
    return (
        F.when(image & ~font, F.lit(fx.CLASS_SCANNED))
        .when(font & ~image, F.lit(fx.CLASS_NATIVE))
        .when(font & image, F.lit(fx.CLASS_MIXED))
        .otherwise(F.lit(fx.CLASS_UNKNOWN))
    )


def blob_pages(content: Column) -> Column:
    """Page objects in the file, page-tree nodes left out."""
    return F.regexp_count(F.decode(content, "ISO-8859-1"), F.lit(r"/Type ?/Page(?!s)"))
