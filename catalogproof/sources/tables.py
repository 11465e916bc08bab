"""External tables, the manifest, rejects, the journal and file inventories."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogproof import fixed_values as fx
from catalogproof import schemas
from catalogproof.functions import text as tx


def read_headed_csv(spark: SparkSession, path: str, names: list[str], multi_line: bool = False) -> DataFrame:
    """A CSV with a header row, every column as text.

    Say ``multi_line`` where quoted fields may hold line feeds: each file is then one task, whatever its size.
    """
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.csv(path)


def import_external(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, triage) of an external table under the file's own headers.

    Every original column must be there.  Empty rows are skipped; rows without link or
    with a link that holds no id are counted in the triage and left out.
    """
    missing = [h for h in fx.RECORD_HEADERS if h not in table.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    named = table.select(*[F.col(f"`{h}`").cast("string").alias(n) for h, n in fx.RECORD_HEADERS.items()] + [
        F.col(c) for c in table.columns if c not in fx.RECORD_HEADERS
    ])
    rows = named.na.drop("all", subset=schemas.RECORD_COLUMNS)
    classed = link_triage(rows, "link")
    kept = classed.filter(F.col("link_class") == "with_id").drop("link_class")
    blank_filled = kept.na.fill("", subset=[c for c in schemas.RECORD_COLUMNS if c != "page"])
    imported = blank_filled.withColumns(
        {
            "link": tx.strip(F.col("link")),
            "category": tx.strip(F.col("category")),
            "record_id": tx.extract_id(F.col("link"), fx.ID_IN_DOWNLOAD_LINK),
            # a page that is no whole number counts as page 0
            "page": F.coalesce(tx.strip(F.col("page")).try_cast("int"), F.lit(0)),
            "provenance": F.lit(fx.FROM_EXTERNAL),
        }
    )
    return imported, classed.groupBy("link_class").agg(F.count(F.lit(1)).alias("n"))


def link_triage(df: DataFrame, link: str, pattern: str = fx.ID_IN_DOWNLOAD_LINK) -> DataFrame:
    """Class each row by its link: ``with_id``, ``no_link`` or ``odd_link``."""
    c = F.col(link)
    kind = (
        F.when(tx.is_blank(c), F.lit("no_link"))
        .when(c.rlike(pattern), F.lit("with_id"))
        .otherwise(F.lit("odd_link"))
    )
    return df.withColumn("link_class", kind)


def record_table(df: DataFrame) -> DataFrame:
    """The fixed record columns; what is missing becomes ``''``."""
    have = set(df.columns)
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c)
          for c in schemas.RECORD_COLUMNS]
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """CSV under the manifest's file headers."""
    (
        manifest.select(*[F.col(c).alias(h) for c, h in fx.MANIFEST_HEADERS.items()])
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest under the names used here; columns not selected are not parsed."""
    headers = {h: schemas.MANIFEST[c].dataType for c, h in fx.MANIFEST_HEADERS.items()}
    raw = (
        spark.read.schema(T.StructType([T.StructField(h, t, True) for h, t in headers.items()]))
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return raw.select(*[F.col(f"`{h}`").alias(c) for c, h in fx.MANIFEST_HEADERS.items()])


def _balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one folder together, large folders split and small ones merged by AQE.

    Without it every task would leave a file in every folder.
    """
    return df.hint("rebalance", *columns)


def write_by_year(df: DataFrame, path: str) -> None:
    """One folder per year; years not in ``df`` keep what they had."""
    (
        _balanced(df, "year")
        .write.partitionBy("year")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def read_rejects(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(record_id, path, reason, url) of any number of reject files, and (file, n_read, n_broken).

    The files are CSVs headed ``uuid,ruta,motivo,url``; a line that is no reject is
    counted against its file in the second table instead of ending the run.
    """
    schema = "uuid string, ruta string, motivo string, url string, _corrupt string"
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        # every column is parsed, or a short line would pass where few are asked for
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(paths)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    readable = raw.filter(F.col("_corrupt").isNull()).select(
        F.col("uuid").alias("record_id"), F.col("ruta").alias("path"), F.col("motivo").alias("reason"), "url"
    )
    broken = F.col("_corrupt").isNotNull()
    return readable, raw.groupBy("file").agg(
        F.count(F.when(~broken, F.col("uuid"))).alias("n_read"), F.count_if(broken).alias("n_broken")
    )


def write_by_assignee(df: DataFrame, path: str) -> None:
    """One folder per assignee; those not in ``df`` keep what they had."""
    (
        _balanced(df, "output")
        .write.partitionBy("output")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def write_converted(converted: DataFrame, path: str) -> None:
    """Markdown documents and rejects in one pass, as a table by outcome, category and year.

    ``md_path`` names each document; read a part with a filter on the folder columns.
    """
    folders = ["outcome", "category", "year"]
    outcome = F.when(F.col("reason").isNull(), F.lit("markdown")).otherwise(F.lit("reject"))
    (
        _balanced(converted.withColumn("outcome", outcome), *folders)
        .write.partitionBy(*folders)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def append_journal(rows: DataFrame, pages_done: DataFrame, path: str) -> None:
    """Recovered rows and the marks of their pages, as one run of the journal.

    Both are written under the run's own name, and its commit record comes last: a run that dies before has written nothing that
    is read, and its pages are asked for again.
    """
    run = f"r-{uuid.uuid4().hex}"
    rows.write.json(f"{path}/rows/run={run}")
    pages_done.select("category", "page").write.parquet(f"{path}/pages/run={run}")
    rows.sparkSession.createDataFrame([(run,)], "run string").write.mode("append").parquet(f"{path}/commits")


def read_journal(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, pages done) of the runs that were committed, each row as often as it was recovered."""
    done = T.StructType([T.StructField("category", T.StringType()), T.StructField("page", T.LongType())])
    if not holds_table(spark, f"{path}/commits"):
        return spark.createDataFrame([], schema), spark.createDataFrame([], done)
    run = T.StructField("run", T.StringType())
    committed = spark.read.schema(T.StructType([run])).parquet(f"{path}/commits")

    def of_committed(stored: DataFrame) -> DataFrame:
        return stored.join(committed, "run", "left_semi").drop("run")

    return (
        of_committed(spark.read.schema(T.StructType([*schema.fields, run])).json(f"{path}/rows")),
        of_committed(spark.read.schema(T.StructType([*done.fields, run])).parquet(f"{path}/pages")),
    )


def holds_table(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a Parquet table; asked of Spark's reader, which knows every store."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def resume_pending(asked: DataFrame, done: DataFrame) -> DataFrame:
    """Pages still to ask for: those asked less those marked done."""
    return asked.join(done.select("category", "page"), ["category", "page"], "left_anti")


def file_inventory(spark: SparkSession, path: str, pattern: str = "*.pdf", content: bool = False) -> DataFrame:
    """(path, length, modificationTime[, content]) of the files under ``path``.

    Without ``content`` the bodies are never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files if content else files.select("path", "length", "modificationTime")


def folder_totals(inventory: DataFrame) -> DataFrame:
    """Files and bytes per ``<category>/<year>`` folder."""
    where = r"([^/]+)/([^/]+)/[^/]+$"
    return inventory.groupBy(
        F.regexp_extract("path", where, 1).alias("category"), F.regexp_extract("path", where, 2).alias("year")
    ).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
