"""First occurrence, content duplicates, repeated ids and first-match lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.functions import text as tx
from catalogproof.operators import scaling
from catalogproof.schemas import CONTENT_COLUMNS


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; null is a key like any other.

    Spark limits each group to one row before the shuffle (WindowGroupLimit), so a key
    with very many copies costs one row per map task.
    """
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def merge_chunks(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of all chunks with each id once per category, the earliest in ``order``."""
    return keep_first(rows, ["category", "record_id"], order)


def repeated_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    """``order`` of every row whose (non-null) key stands on more than one row."""
    narrow = df.select(order, key)
    repeated = (
        narrow.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    return scaling.attach_stats(narrow, repeated, [key], "_n", order).filter(F.col("_n").isNotNull()).select(order)


def mark_repeated(df: DataFrame, key: str, order: str, out: str = "id_repeated") -> DataFrame:
    """Flag every row whose (non-null) key stands on more than one row."""
    flags = repeated_ids(df, key, order).withColumn(out, F.lit(True))
    return df.join(flags, order, "left").select(*df.columns, F.coalesce(out, F.lit(False)).alias(out))


def content_key(columns: list[str] = CONTENT_COLUMNS) -> Column:
    """The compared columns as one text, null apart from blank."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])


def content_digest(columns: list[str] = CONTENT_COLUMNS) -> Column:
    return F.sha2(content_key(columns), 256)


def content_duplicates(
    df: DataFrame, order: str, columns: list[str] = CONTENT_COLUMNS, digests: DataFrame | None = None
) -> DataFrame:
    """(order, dup_group, is_droppable_copy) of the rows that share their content with another.

    Groups are numbered from 0 in the order of their joined content; the row with the
    lowest ``order`` is the one to keep.  Only ``digests`` (order, _digest; written once)
    travel in the shuffles; the content itself is read again just for the first row of
    each group.
    """
    if digests is None:
        digests = scaling.materialize(df.select(order, content_digest(columns).alias("_digest")), "digests")
    keyed = digests.select(order, "_digest")
    groups = scaling.materialize(
        keyed.groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
        .filter("_n > 1"),
        "duplicate-groups",
    )
    content = df.select(F.col(order).alias("_first"), *columns)
    heads = scaling.keep_matching(content, groups, "_first").select(
        "_digest", "_n", "_first", content_key(columns).alias("_key")
    )
    numbered = scaling.global_rank(heads, ["_key"], "_rank").select(
        "_digest", "_n", "_first", (F.col("_rank") - 1).alias("dup_group")
    )
    marked = scaling.attach_stats(keyed, numbered, ["_digest"], "_n", order).filter(F.col("_n").isNotNull())
    return marked.select(order, "dup_group", (F.col(order) != F.col("_first")).alias("is_droppable_copy"))


def mark_content_duplicates(
    df: DataFrame, order: str, columns: list[str] = CONTENT_COLUMNS
) -> DataFrame:
    """Add ``dup_group``, ``is_content_dup`` and ``is_droppable_copy`` to every row."""
    return _with_duplicate_flags(df, content_duplicates(df, order, columns), order)


def _with_duplicate_flags(df: DataFrame, flags: DataFrame, order: str) -> DataFrame:
    """Attach what ``content_duplicates`` found; one join on the unique row id."""
    return df.join(flags, order, "left").select(
        *df.columns,
        "dup_group",
        F.col("dup_group").isNotNull().alias("is_content_dup"),
        F.coalesce("is_droppable_copy", F.lit(False)).alias("is_droppable_copy"),
    )


def new_records(candidates: DataFrame, known: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Candidates whose id is not known yet, each id once."""
    fresh = keep_first(candidates, [key], order)
    return fresh.join(known.select(key), key, "left_anti")


def lookup_first_link(
    export: DataFrame, links: DataFrame, key: str, link: str, order: str, spread: str
) -> DataFrame:
    """Attach the first link known for each case key; ``''`` where there is none.

    A case key may stand for several records, so ``match_count`` tells how many.
    """
    named = links.select(F.col(key), F.struct(F.col(order).alias("o"), F.col(link).alias("l")).alias("_m"))
    first = named.groupBy(key).agg(F.min("_m").alias("_m"), F.count(F.lit(1)).alias("match_count"))
    table = first.select(key, F.col("_m.l").alias(link), "match_count")
    found = scaling.lookup(export, table, [key], spread)
    return found.withColumns(
        {
            link: F.coalesce(F.col(link), F.lit("")),
            "match_count": F.coalesce(F.col("match_count"), F.lit(0).cast("bigint")),
        }
    )


def positional_rename(df: DataFrame, names: list[str], helpers: list[str]) -> DataFrame:
    """Name columns by position (the header is unreadable) and drop helpers that exist."""
    return df.toDF(*names[: len(df.columns)]).drop(*helpers)


def export_with_links(export: DataFrame, harvested: DataFrame, names: list[str], helpers: list[str], order: str, spread: str) -> DataFrame:
    """The official export under record columns, each row with the first link that a harvest has for its case key.

    A null key is one like an empty one; ``order`` orders the harvest, ``spread`` tells rows of the export apart.
    """
    keyed = positional_rename(export, names, helpers)
    links = harvested.select(tx.case_key(F.col("case_type"), F.col("case_no")).alias("case_key"), "link", order)
    found = lookup_first_link(keyed.na.fill("", ["case_key"]), links, "case_key", "link", order, spread)
    kind, number = tx.split_case_key(F.col("case_key"))
    return found.withColumns({"case_type": kind, "case_no": number})
