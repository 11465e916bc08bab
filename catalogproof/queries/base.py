"""Registry, and the recipes that turn the given tables into catalogue data.

Each recipe stands here twice: as DataFrame code and as a SQL common table expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogproof.operators import scaling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, read as it lies, in as many tasks as it has splits."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def when(*cases: tuple[Column, Column], otherwise: Column | None = None) -> Column:
    """The first case that holds."""
    first, *rest = cases
    out = F.when(*first)
    for condition, value in rest:
        out = out.when(condition, value)
    return out if otherwise is None else out.otherwise(otherwise)


# --- identity ---------------------------------------------------------------

LINK_BASE = "https://host/f?uuid="
DOWNLOAD_BASE = "https://host/ServletDescarga?uuid="


def record_id(key: Column) -> Column:
    h = F.md5(key.cast("string"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts])


def sql_record_id(key: str) -> str:
    h = f"md5(CAST({key} AS VARCHAR))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
        f"substr({h},17,4) || '-' || substr({h},21,12))"
    )


# --- SQL spellings of the scalar functions ------------------------------------


def sql_fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def sql_slug(x: str) -> str:
    return f"trim(regexp_replace(lower({sql_fold(x)}), '[^a-z0-9]+', '-', 'g'), '-')"


def sql_clean(x: str) -> str:
    no_control = rf"regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')"
    return rf"nullif(trim(regexp_replace({no_control}, '\s+', ' ', 'g')), '')"


def sql_category_key(x: str) -> str:
    return f"lower(rtrim({sql_fold(x)}, '.'))"


SQL_HAD_LABEL = r"'(?i)^(?:\s*sumilla\s*[.:–—-]+\s*)+'"
SQL_LABEL = r"'(?i)^(?:\s*(?:sumilla\s*)?[.:–—-]+\s*)+'"


def sql_strip_label(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, {SQL_LABEL}, '')), '')"


def sql_extract_id(x: str) -> str:
    return f"nullif(regexp_extract({x}, 'uuid=([0-9a-fA-F-]{{36}})', 1), '')"


def sql_pdf_path(case_type: str, case_no: str, category: str, rid: str, year: str) -> str:
    kind = f"CASE WHEN trim(coalesce({case_type}, '')) = '' THEN 'resolucion' ELSE {case_type} END"
    parts = [
        f"coalesce(nullif({sql_slug(kind)}, ''), 'sin-especialidad')",
        f"nullif(regexp_replace(coalesce({case_no}, ''), '[^0-9-]', '', 'g'), '')",
        f"nullif(substr(coalesce({rid}, ''), 1, 8), '')",
    ]
    return (
        f"coalesce(nullif({sql_slug(category)}, ''), 'sin-especialidad') || '/' || "
        f"coalesce(CAST({year} AS VARCHAR), 'sin-anio') || '/' || concat_ws('-', {', '.join(parts)}) || '.pdf'"
    )


# --- catalogue ----------------------------------------------------------------


def catalogue(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Documents as a paginated catalogue: ten rows a page within each language."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("category"),
        F.col("source").alias("subject"),
        "n_chars",
        *extra,
    )
    numbered = scaling.number_within(docs, ["category"], "row_id", "_seq")
    rid = record_id(F.col("row_id"))
    return numbered.select(
        *docs.columns,
        F.expr("(_seq - 1) div 10 + 1").cast("int").alias("page"),
        rid.alias("record_id"),
        F.concat(F.lit(LINK_BASE), rid).alias("link"),
        (F.col("row_id") % 25 + 2000).cast("int").alias("year"),
    )


SQL_CATALOGUE = f"""catalogue AS (
  SELECT doc_id AS row_id, lang AS category, source AS subject, n_chars, text,
         CAST((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 10 + 1 AS INTEGER) AS page,
         {sql_record_id('doc_id')} AS record_id,
         '{LINK_BASE}' || {sql_record_id('doc_id')} AS link,
         CAST(doc_id % 25 + 2000 AS INTEGER) AS year
  FROM documents)"""


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").withColumnRenamed("doc_id", "row_id")


def harvested(spark: SparkSession, sf: str) -> DataFrame:
    """What a harvest with gaps holds: labelled rows, without every seventh page."""
    kept = catalogue(spark, sf).filter(F.col("page") % 7 != 3)
    return kept.join(labels(spark, sf).select("row_id"), "row_id", "left_semi")


SQL_HARVESTED = f"""{SQL_CATALOGUE},
harvested AS (
  SELECT * EXCLUDE (text) FROM catalogue
  WHERE page % 7 <> 3 AND row_id IN (SELECT doc_id FROM labels))"""


def repeated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Harvested rows with every fifth document harvested twice."""
    rows = harvested(spark, sf)
    again = rows.filter(F.col("row_id") % 5 == 0).withColumn("row_id", F.col("row_id") + 1_000_000_000)
    return rows.unionByName(again)


SQL_REPEATED = f"""{SQL_HARVESTED},
repeated AS (
  SELECT * FROM harvested
  UNION ALL
  SELECT * REPLACE (row_id + 1000000000 AS row_id) FROM harvested WHERE row_id % 5 = 0)"""

def whole_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The whole catalogue, every fifth document twice: the second time a page later, under another subject."""
    rows = catalogue(spark, sf)
    again = rows.filter(F.col("row_id") % 5 == 0).withColumns(
        {
            "row_id": F.col("row_id") + 1_000_000_000,
            "page": F.col("page") + 1,
            "subject": F.concat("subject", F.lit(" again")),
        }
    )
    return rows.unionByName(again)


SQL_WHOLE_REPEATED = f"""{SQL_CATALOGUE},
repeated AS (
  SELECT * EXCLUDE (text) FROM catalogue
  UNION ALL
  SELECT * EXCLUDE (text) REPLACE (row_id + 1000000000 AS row_id, page + 1 AS page, subject || ' again' AS subject)
  FROM catalogue WHERE row_id % 5 = 0)"""

SQL_PROFILE = f"""{SQL_HARVESTED},
profile AS (SELECT category, page, count(*) AS n_rows FROM harvested GROUP BY ALL),
last_pages AS (SELECT category, max(page) AS last_page FROM profile GROUP BY ALL),
missing AS (
  SELECT e.category, CAST(e.last_page AS BIGINT) AS last_page, CAST(e.page AS BIGINT) AS page
  FROM (SELECT category, last_page, unnest(range(1, CAST(last_page + 1 AS BIGINT))) AS page FROM last_pages) e
  LEFT JOIN profile p ON p.category = e.category AND p.page = e.page
  WHERE p.page IS NULL)"""


# --- dirty text and records -------------------------------------------------------


def dirty_text(text: Column, k: Column) -> Column:
    return when(
        (k % 50 == 49, F.lit(" \t ")),
        (k % 4 == 0, F.concat(F.lit("Sumilla:  "), text)),
        (k % 4 == 1, F.concat(F.lit(".- SUMILLA: "), text)),
        (k % 4 == 2, F.replace(text, F.lit("\n"), F.lit("\t\n\n"))),
        otherwise=F.concat(F.lit("\x07  "), text),
    )


def sql_dirty_text(text: str, k: str) -> str:
    return (
        f"CASE WHEN {k} % 50 = 49 THEN ' ' || chr(9) || ' ' WHEN {k} % 4 = 0 THEN 'Sumilla:  ' || {text} "
        f"WHEN {k} % 4 = 1 THEN '.- SUMILLA: ' || {text} "
        f"WHEN {k} % 4 = 2 THEN replace({text}, chr(10), chr(9) || chr(10) || chr(10)) "
        f"ELSE chr(7) || '  ' || {text} END"
    )


def dirty_category(c: Column, k: Column) -> Column:
    return when((k % 7 == 0, F.concat(F.upper(c), F.lit("."))), (k % 11 == 0, F.lower(c)), otherwise=c)


def sql_dirty_category(c: str, k: str) -> str:
    return f"CASE WHEN {k} % 7 = 0 THEN upper({c}) || '.' WHEN {k} % 11 = 0 THEN lower({c}) ELSE {c} END"


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty catalogue records.  Content depends on the text alone, so copied texts make copied records."""
    cat = catalogue(spark, sf, "text")
    k = F.col("n_chars")
    kind = F.element_at(F.array(F.lit("Casación"), F.lit("Apelación"), F.lit("Consulta")), (k % 3 + 1).cast("int"))
    year = k % 25 + 2000
    raw_date = when(
        (k % 13 == 0, F.lit("31/02/2020")),
        (k % 17 == 0, F.lit(None).cast("string")),
        otherwise=F.concat_ws("/", k % 28 + 1, k % 12 + 1, year),
    )
    # every 97th row carries the id of the row before it
    rid = record_id(F.when(F.col("row_id") % 97 == 96, F.col("row_id") - 1).otherwise(F.col("row_id")))
    return cat.select(
        dirty_category(kind, k).alias("case_type"),
        F.concat(F.lpad((k % 5000).cast("string"), 6, "0"), F.lit("-"), year + k % 3 - 1).alias("case_no"),
        F.concat(F.lit("materia  "), (k % 5).cast("string")).alias("subject"),
        dirty_category(F.lit("Ejecutoria Suprema"), k + 1).alias("ruling_type"),
        raw_date.alias("ruling_date_raw"),
        dirty_category(F.concat(F.lit("Sala "), F.col("category")), k + 2).alias("court"),
        F.when(k % 6 == 0, F.lit(" ")).otherwise(F.concat(F.lit("Art.\t"), (k % 9).cast("string"))).alias("rule"),
        dirty_text(F.col("text"), k).alias("summary"),
        F.concat_ws(", ", F.col("category"), (k % 4).cast("string")).alias("keywords"),
        F.concat(F.lit(LINK_BASE), rid).alias("link"),
        dirty_category(F.col("category"), k).alias("category"),
        "page",
        "row_id",
    )


SQL_RECORDS = f"""{SQL_CATALOGUE},
records AS (
  SELECT {sql_dirty_category("CASE n_chars % 3 WHEN 0 THEN 'Casación' WHEN 1 THEN 'Apelación' ELSE 'Consulta' END", 'n_chars')} AS case_type,
         lpad(CAST(n_chars % 5000 AS VARCHAR), 6, '0') || '-' || CAST(n_chars % 25 + 2000 + n_chars % 3 - 1 AS VARCHAR) AS case_no,
         'materia  ' || CAST(n_chars % 5 AS VARCHAR) AS subject,
         {sql_dirty_category("'Ejecutoria Suprema'", '(n_chars + 1)')} AS ruling_type,
         CASE WHEN n_chars % 13 = 0 THEN '31/02/2020' WHEN n_chars % 17 = 0 THEN NULL
              ELSE CAST(n_chars % 28 + 1 AS VARCHAR) || '/' || CAST(n_chars % 12 + 1 AS VARCHAR) || '/' || CAST(n_chars % 25 + 2000 AS VARCHAR) END AS ruling_date_raw,
         {sql_dirty_category("('Sala ' || category)", '(n_chars + 2)')} AS court,
         CASE WHEN n_chars % 6 = 0 THEN ' ' ELSE 'Art.' || chr(9) || CAST(n_chars % 9 AS VARCHAR) END AS rule,
         {sql_dirty_text('text', 'n_chars')} AS summary,
         category || ', ' || CAST(n_chars % 4 AS VARCHAR) AS keywords,
         '{LINK_BASE}' || {sql_record_id('(CASE WHEN row_id % 97 = 96 THEN row_id - 1 ELSE row_id END)')} AS link,
         {sql_dirty_category('category', 'n_chars')} AS category,
         page, row_id
  FROM catalogue)"""


def _sql_forms(column: str) -> str:
    return (
        f"forms_{column} AS (SELECT key, value FROM (SELECT {sql_category_key('value')} AS key, value, "
        f"row_number() OVER (PARTITION BY {sql_category_key('value')} ORDER BY count(*) DESC, value) AS rn "
        f"FROM (SELECT {sql_clean(column)} AS value FROM records) WHERE value IS NOT NULL GROUP BY value) WHERE rn = 1)"
    )


_CONTENT = ["case_type", "case_no", "subject", "ruling_type", "ruling_date_raw", "court", "rule", "summary", "keywords", "category"]
_SQL_KEY = " || chr(31) || ".join(f"coalesce({c}, chr(1))" for c in _CONTENT)

SQL_CLEANED = f"""{SQL_RECORDS},
{", ".join(_sql_forms(c) for c in ("case_type", "ruling_type", "court", "category"))},
unified AS (
  SELECT f1.value AS case_type, {sql_clean('r.case_no')} AS case_no, {sql_clean('r.subject')} AS subject,
         f2.value AS ruling_type, r.ruling_date_raw, f3.value AS court, {sql_clean('r.rule')} AS rule,
         {sql_clean('r.summary')} AS summary0, {sql_clean('r.keywords')} AS keywords, {sql_clean('r.link')} AS link,
         f4.value AS category, r.page, r.row_id
  FROM records r
  LEFT JOIN forms_case_type f1 ON f1.key = {sql_category_key(sql_clean('r.case_type'))}
  LEFT JOIN forms_ruling_type f2 ON f2.key = {sql_category_key(sql_clean('r.ruling_type'))}
  LEFT JOIN forms_court f3 ON f3.key = {sql_category_key(sql_clean('r.court'))}
  LEFT JOIN forms_category f4 ON f4.key = {sql_category_key(sql_clean('r.category'))}),
derived AS (
  SELECT *, {sql_strip_label('summary0')} AS summary, {sql_extract_id('link')} AS record_id,
         CAST(try_strptime(ruling_date_raw, '%d/%m/%Y') AS DATE) AS ruling_date,
         TRY_CAST(nullif(regexp_extract(case_no, '-(\\d{{4}})$', 1), '') AS INTEGER) AS case_year,
         coalesce(regexp_matches(summary0, {SQL_HAD_LABEL}), FALSE) AS summary_had_prefix
  FROM unified),
keyed AS (
  SELECT *, CAST(year(ruling_date) AS INTEGER) AS year, {_SQL_KEY} AS content_key FROM derived),
grouped AS (
  SELECT content_key, min(row_id) AS first_row, row_number() OVER (ORDER BY content_key) - 1 AS dup_group
  FROM keyed GROUP BY content_key HAVING count(*) > 1),
cleaned AS (
  SELECT case_type, case_no, subject, ruling_type, ruling_date_raw, court, rule, summary, keywords, link, category, page,
         record_id, ruling_date, year, case_year, summary_had_prefix,
         coalesce(length(summary) >= 20, FALSE) AS summary_useful,
         coalesce(year < case_year, FALSE) AS date_incoherent,
         count(*) OVER (PARTITION BY record_id) > 1 AND record_id IS NOT NULL AS id_repeated,
         {sql_pdf_path('case_type', 'case_no', 'category', 'record_id', 'year')} AS pdf_path,
         regexp_replace({sql_pdf_path('case_type', 'case_no', 'category', 'record_id', 'year')}, '\\.pdf$', '.md') AS md_path,
         g.dup_group, g.dup_group IS NOT NULL AS is_content_dup,
         coalesce(row_id <> g.first_row, FALSE) AS is_droppable_copy, row_id
  FROM keyed LEFT JOIN grouped g USING (content_key))"""


# --- orders as records --------------------------------------------------------------


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a raw date text, a case number and an id."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    raw = when(
        (k % 13 == 0, F.lit("31/02/2020")),
        (k % 17 == 0, F.lit(None).cast("string")),
        otherwise=F.concat_ws("/", F.dayofmonth(d), F.month(d), F.year(d)),
    )
    number = F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("-"), F.year(d) + k % 3 - 1)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        dirty_category(F.col("o_orderpriority"), k).alias("priority"),
        "o_orderstatus",
        raw.alias("raw_date"),
        number.alias("case_no"),
        record_id(k).alias("record_id"),
        F.year(d).alias("order_year"),
    )


SQL_ORDER_RECORDS = f"""order_records AS (
  SELECT o_orderkey, o_custkey, {sql_dirty_category('o_orderpriority', 'o_orderkey')} AS priority, o_orderstatus,
         CASE WHEN o_orderkey % 13 = 0 THEN '31/02/2020' WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS raw_date,
         lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '-' || CAST(year(o_orderdate) + o_orderkey % 3 - 1 AS VARCHAR) AS case_no,
         {sql_record_id('o_orderkey')} AS record_id,
         CAST(year(o_orderdate) AS INTEGER) AS order_year
  FROM orders)"""
SQL_RULING_DATE = "CAST(try_strptime(raw_date, '%d/%m/%Y') AS DATE)"
SQL_CASE_YEAR = r"TRY_CAST(nullif(regexp_extract(case_no, '-(\d{4})$', 1), '') AS INTEGER)"


def literal_dim(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A dimension that is part of the query text, such as who does which years."""
    return spark.createDataFrame(rows, schema)
