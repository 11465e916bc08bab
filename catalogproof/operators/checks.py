"""Gate and reports over a table before and after cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogproof.functions import quality as ql
from catalogproof.functions import text as tx
from catalogproof.schemas import CATEGORY_COLUMNS, RECORD_COLUMNS, TEXT_COLUMNS

UNTOUCHED = ["case_no", "ruling_date_raw", "link", "page"]


def _side_by_side(before: DataFrame, after: DataFrame, order: str, columns: list[str]) -> DataFrame:
    extra = [c for c in after.columns if c not in columns and c != order]
    b = before.select(F.col(order).alias("_b"), *[F.col(c).alias(f"b_{c}") for c in columns])
    a = after.select(F.col(order).alias("_a"), *[F.col(c).alias(f"a_{c}") for c in columns], *extra)
    return b.join(a, F.col("_b") == F.col("_a"), "full_outer")


def _rows(counts: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    """One row of named counts -> one row per name."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias(key), F.col(n).cast("bigint").alias(value)) for n in names]
    )
    return counts.select(F.inline(pairs))


def column_order_violations(after: DataFrame, columns: list[str] = RECORD_COLUMNS) -> int:
    """1 when an original column is missing or they do not come first in order."""
    return int(after.columns[: len(columns)] != columns)


def _compact(text: Column) -> Column:
    """A text, or its digest where it is long: equal when the texts are."""
    return F.when(F.length(text) > 64, F.sha2(text, 256)).otherwise(text)


def conservation_check(before: DataFrame, after: DataFrame, order: str = "row_id") -> DataFrame:
    """(check, violations): publish only when every count is zero.

    What a check needs of a text (is it null, does it keep its label) is worked out on
    each side, so the join by row id carries flags and short columns, never the texts.
    Path collisions are counted from the per-path totals.
    """

    def has(c: str) -> Column:
        # a summary that was nothing but its label may become null
        kept = tx.strip_label(F.col(c)) if c == "summary" else F.col(c)
        return kept.isNotNull()

    b = before.select(
        F.col(order).alias("_b"),
        *[has(c).alias(f"had_{c}") for c in RECORD_COLUMNS],
        tx.extract_id(F.col("link")).alias("b_id"),
        *[_compact(tx.blank_to_null(tx.strip(F.col(c).cast("string")))).alias(f"b_{c}") for c in UNTOUCHED],
    )
    spacing = [F.coalesce(F.col(c).rlike(r"(?U)\s\s|[\n\r\t]"), F.lit(False)).cast("int") for c in TEXT_COLUMNS]
    a = after.select(
        F.col(order).alias("_a"),
        *[F.col(c).isNotNull().alias(f"has_{c}") for c in RECORD_COLUMNS],
        F.col("record_id").alias("a_id"),
        *[_compact(F.col(c).cast("string")).alias(f"a_{c}") for c in UNTOUCHED],
        tx.keeps_label(F.col("summary")).alias("label_left"),
        reduce(lambda x, y: x + y, spacing).alias("spacing_left"),
        (~ql.id_well_formed(F.col("record_id"))).alias("id_malformed"),
        (~tx.extract_id(F.col("link")).eqNullSafe(F.col("record_id"))).alias("id_not_of_link"),
        (~ql.path_well_formed(F.col("pdf_path"))).alias("path_malformed"),
    )
    both = b.join(a, F.col("_b") == F.col("_a"), "full_outer")
    paired = F.col("_b").isNotNull() & F.col("_a").isNotNull()

    def violations(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    counts = both.agg(
        F.abs(F.count("_b") - F.count("_a")).alias("row_count"),
        violations(~paired).alias("row_ids"),
        F.lit(column_order_violations(after)).alias("column_order"),
        violations(paired & ~F.col("b_id").eqNullSafe(F.col("a_id"))).alias("id_sequence"),
        reduce(
            lambda x, y: x + y,
            [violations(paired & F.col(f"had_{c}") & ~F.col(f"has_{c}")) for c in RECORD_COLUMNS],
        ).alias("value_lost"),
        violations(F.col("label_left")).alias("label_left"),
        F.coalesce(F.sum("spacing_left"), F.lit(0)).alias("spacing_left"),
        violations(F.col("_a").isNotNull() & F.col("a_id").isNull()).alias("id_null"),
        *[violations(F.col(c)).alias(c) for c in ("id_malformed", "id_not_of_link", "path_malformed")],
        *[violations(paired & ~F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}"))).alias(f"changed_{c}") for c in UNTOUCHED],
    )
    collisions = (
        after.groupBy("pdf_path")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
        .select(F.lit("path_collides").alias("check"), "violations")
    )
    return _rows(counts, counts.columns, "check", "violations").unionByName(collisions)


def spelling_changes(before: DataFrame, after: DataFrame, order: str = "row_id") -> DataFrame:
    """(column, old, new, n): spellings that were unified, per category column."""
    both = _side_by_side(before, after, order, CATEGORY_COLUMNS)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"b_{c}").alias("old"), F.col(f"a_{c}").alias("new"))
            for c in CATEGORY_COLUMNS
        ]
    )
    spelled = both.select(F.inline(pairs)).filter(F.col("old").isNotNull() & ~F.col("old").eqNullSafe(F.col("new")))
    return spelled.groupBy("column", "old", "new").agg(F.count(F.lit(1)).alias("n"))


def _distinct(df: DataFrame, name: str, c: Column) -> DataFrame:
    """Exact distinct count in two combined steps, null left out."""
    return (
        df.select(_compact(c).alias("v"))
        .filter(F.col("v").isNotNull())
        .distinct()
        .agg(F.count(F.lit(1)).cast("bigint").alias("value"))
        .select(F.lit(name).alias("metric"), "value")
    )


def cleaning_report(before: DataFrame, after: DataFrame, order: str = "row_id") -> DataFrame:
    """(metric, value): what cleaning changed, flagged and would have lost."""
    # texts are compared by digest, so that the join by row id carries none
    short = [F.col(order), *[_compact(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in TEXT_COLUMNS]]
    has_summary = F.col("summary").isNotNull().alias("has_summary")
    marks = ["summary_had_prefix", "summary_useful", "date_incoherent", "id_repeated", "is_content_dup", "dup_group",
             "is_droppable_copy", "pdf_path"]
    both = _side_by_side(
        before.select(*short, has_summary), after.select(*short, has_summary, *marks), order, [*TEXT_COLUMNS, "has_summary"]
    )

    def touched(c: str) -> Column:
        return F.count_if(F.col(f"b_{c}") != F.col(f"a_{c}"))

    flags = {
        "prefix_removed": F.count_if("summary_had_prefix"),
        "summary_emptied": F.count_if(F.col("b_has_summary") & ~F.col("a_has_summary")),
        "summary_useful": F.count_if("summary_useful"),
        "date_incoherent": F.count_if("date_incoherent"),
        "id_repeated": F.count_if("id_repeated"),
        "content_duplicates": F.count_if("is_content_dup"),
        "duplicate_groups": F.coalesce(F.max("dup_group") + 1, F.lit(0)),
        "droppable_copies": F.count_if("is_droppable_copy"),
        "rows_without_copies": F.count(F.lit(1)) - F.count_if("is_droppable_copy"),
        "longest_path": F.max(F.length("pdf_path")),
    }
    counts = both.agg(
        *[touched(c).alias(f"cells_changed_{c}") for c in TEXT_COLUMNS],
        *[v.alias(k) for k, v in flags.items()],
    )
    report = _rows(counts, counts.columns, "metric", "value")
    for c in CATEGORY_COLUMNS:
        report = report.unionByName(_distinct(before, f"spellings_before_{c}", F.col(c)))
        report = report.unionByName(_distinct(after, f"spellings_after_{c}", F.col(c)))
    for name, df in (("summaries_before", before), ("summaries_after", after)):
        report = report.unionByName(_distinct(df, name, F.col("summary")))
    folders = (
        after.groupBy(F.regexp_extract("pdf_path", "^(.*)/", 1).alias("folder"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("folders"), F.max("n").alias("largest_folder"))
    )
    return report.unionByName(_rows(folders, folders.columns, "metric", "value"))


def path_collisions(df: DataFrame, case_type: str, case_no: str, by: list[str] | None = None) -> DataFrame:
    """Names made of type and number alone: how many there are and how many files they overwrite."""
    from catalogproof import fixed_values as fx

    name = F.concat(
        tx.slug(F.coalesce(F.col(case_type), F.lit(fx.NO_CASE_TYPE)), fx.NO_CATEGORY),
        F.lit("-"),
        F.coalesce(F.col(case_no), F.lit("")),
    )
    per_name = df.groupBy(*(by or []), name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return per_name.groupBy(*(by or [])).agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_names"),
        (F.sum("n") - F.count(F.lit(1))).alias("n_overwritten"),
        F.count_if(F.col("n") > 1).alias("n_repeated_names"),
    )


def expectations(df: DataFrame, expected: dict[str, int], category: str, category_col: str = "category",
                 key: str = "record_id", year: str = "year") -> DataFrame:
    """(check, expected, actual, ok) for total rows, one category, distinct ids and years.

    Distinct ids may fall short of the rows by five at most.
    """
    per_id = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(category_col) == category).alias("in_category"),
        F.min(year).alias("y0"),
        F.max(year).alias("y1"),
    )
    actual = per_id.agg(
        F.sum("n").alias("rows"),
        F.sum("in_category").alias("category_rows"),
        F.count(key).alias("distinct_ids"),
        F.min("y0").alias("first_year"),
        F.max("y1").alias("last_year"),
    )
    rows = _rows(actual, actual.columns, "check", "actual")
    known = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    total = actual.select(F.col("rows").cast("bigint")).scalar()
    target = F.when(F.col("check") == "distinct_ids", total - 5).otherwise(F.try_element_at(known, F.col("check")))
    ok = F.when(F.col("check") == "distinct_ids", F.col("actual") >= target).otherwise(F.col("actual") == target)
    return rows.select("check", target.alias("expected"), "actual", ok.alias("ok"))


def distinct_profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """(column, n_rows, n_null, n_distinct, is_unique) for each column, null left out of the distinct.

    Values are counted per column before the final totals, so a frequent value costs one
    row per task.  Long texts are compared by digest, so that no text is shuffled.
    """

    def cell(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.struct(F.lit(c).alias("column"), _compact(text).alias("value"))

    cells = df.select(F.inline(F.array(*[cell(c) for c in columns])))
    if approximate:
        return cells.groupBy("column").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("value").isNull()).alias("n_null"),
            F.approx_count_distinct("value").alias("n_distinct"),
        )
    per_value = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        (F.max("n") == 1).alias("is_unique"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Values by frequency, the most frequent first; null left out."""
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
    )
    return counted if top is None else counted.limit(top)


def year_histogram(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Rows per year of the first date column that exists; null stays a group."""
    column = next((c for c in candidates if c in df.columns), None)
    if column is None:
        raise ValueError(f"none of the date columns {candidates} is present")
    return df.groupBy(F.year(column).alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")
