"""Chunk files: JSON objects holding flags and up to 25 pages of records.

A chunk is named by its category and first page, either in its path
(``<slug>/tramos/p00026-00050.json``) or, in files written here, in its object, which also says which
part of the chunk it is.  ``CHUNK_ORDER`` is the order in which a repeated id counts as first.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof import schemas
from catalogproof.functions import text as tx
from catalogproof.operators import pages, scaling

_NAMES = {**fx.HARVEST_HEADERS, **fx.RECORD_HEADERS}
#: rows of an object; a larger chunk has several
PART_ROWS = 1024
#: total within a category; an object delivered twice is told apart by its file
CHUNK_ORDER = ["category", "chunk_start", "part", "position", "chunk_file"]


@cache
def _slugs() -> dict[str, str]:
    """Slug of each category, by the rules of `tx.slug`."""
    plain = {c: unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode().lower() for c in fx.CATEGORIES}
    return {re.sub("[^a-z0-9]+", "-", p).strip("-") or fx.NO_CATEGORY: c for c, p in plain.items()}


def category_for(slug: Column) -> Column:
    """The category a slug belongs to; an unknown slug stands for itself."""
    pairs = [F.lit(x) for pair in _slugs().items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), slug), slug)


def category_code(category: Column) -> Column:
    """The site's number of a category; null for one it does not know."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in fx.CATEGORIES.items() for x in kv]), category)


def chunk_frame(objects: DataFrame, file: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, flags) of raw chunk objects; works on a stream as well.

    The flags keep a line for an object that could not be read: flattening alone would
    lose it without a trace.  Both name the chunk by ``category`` and ``chunk_start``; a row's own
    category counts for the row.
    """
    slug, first, _ = chunk_range(F.col("chunk_file"))
    folder = tx.blank_to_null(F.regexp_extract("chunk_file", "category_slug=([^/]+)/", 1))
    named = objects.withColumn("chunk_file", file).withColumns(
        {
            "_category": F.coalesce(
                "categoria", F.get("filas", F.lit(0))["Especialidad"], category_for(F.coalesce(slug, folder))
            ),
            "chunk_start": F.coalesce("tramo", first),
            "part": F.coalesce("parte", F.lit(0)),
        }
    )
    corrupt = F.col("_corrupt").isNotNull()
    flags = named.select(
        "chunk_file",
        F.col("_category").alias("category"),
        "chunk_start",
        "part",
        (F.coalesce(F.col("completo"), F.lit(False)) & ~corrupt).alias("complete"),
        F.col("fallidas").alias("failed"),
        F.col("incompletas").alias("short"),
        corrupt.alias("unreadable"),
    )
    place = ["chunk_file", "chunk_start", "part"]
    rows = named.filter(~corrupt).select(*place, F.posexplode("filas").alias("position", "_row")).select(
        *[F.col("_row")[header].alias(name) for header, name in _NAMES.items()], *place, "position"
    )
    return rows, flags


def read_objects(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    return (
        spark.read.schema(schemas.CHUNK_FILE)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def read_chunks(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, flags) of all chunk files under ``path``.

    One object a line, which is how chunk files are written, keeps large files
    splittable; set ``multi_line`` for objects that span lines.
    """
    return chunk_frame(read_objects(spark, path, multi_line), F.col("_metadata.file_path"))


def chunk_range(chunk_file: Column) -> tuple[Column, Column, Column]:
    """(category slug, first page, last page) from ``<slug>/tramos/p00026-00050.json``."""
    pattern = r"([^/]+)/tramos/p(\d+)-(\d+)\.json$"
    return tuple(
        c if i == 0 else c.try_cast("int")
        for i, c in enumerate(tx.blank_to_null(F.regexp_extract(chunk_file, pattern, g)) for g in (1, 2, 3))
    )


def build_chunks(rows: DataFrame, order: str = "row_id") -> DataFrame:
    """Rows -> chunk objects (category, chunk_start, and the keys of a chunk file).

    Pages below 1 belong to no chunk.  A chunk is one object, or one per PART_ROWS rows in
    ``order`` (a unique whole number), all with the same flags, so an overfull page never gathers in one array.
    """
    valid = rows.filter(F.col("page") >= 1).withColumn("chunk_start", pages.chunk_start(F.col("page")))
    status = pages.chunk_status(pages.page_profile(valid)).select(
        "category", "chunk_start", "complete", "failed"
    )
    have = set(rows.columns)
    cell = F.struct(
        *[
            (F.col(name) if name in have else F.lit(None).cast("string")).alias(header)
            for header, name in _NAMES.items()
        ]
    )
    chunk = ["category", "chunk_start"]
    numbered = scaling.number_within(valid, chunk, order, "_nth")
    parts = numbered.groupBy(*chunk, F.floor((F.col("_nth") - 1) / PART_ROWS).cast("int").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_nth").alias("n"), cell.alias("r")))).alias("_rows")
    )
    return scaling.null_safe(parts, status, chunk).select(
        "category",
        "chunk_start",
        F.col("category").alias("categoria"),
        F.col("chunk_start").cast("int").alias("tramo"),
        F.col("part").alias("parte"),
        F.col("complete").alias("completo"),
        F.col("failed").alias("fallidas"),
        F.transform("_rows", lambda r: r["r"]).alias("filas"),
    )


def write_chunks(rows: DataFrame, path: str, order: str = "row_id") -> None:
    """Chunk objects as JSON lines, one folder per category; other categories are left alone."""
    (
        build_chunks(rows, order)
        .withColumn("category_slug", tx.slug(F.col("category"), fx.NO_CATEGORY))
        .drop("category", "chunk_start")
        .hint("rebalance", "category_slug")
        .write.partitionBy("category_slug")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .json(path)
    )
