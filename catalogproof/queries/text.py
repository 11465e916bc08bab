"""Text, id, date and path functions, and plain relational queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import quality as ql
from catalogproof.functions import text as tx
from catalogproof.operators import checks, dedupe
from catalogproof.queries.base import (
    DOWNLOAD_BASE,
    LINK_BASE,
    SQL_CASE_YEAR,
    SQL_HAD_LABEL,
    SQL_ORDER_RECORDS,
    SQL_RULING_DATE,
    dirty_text,
    order_records,
    query,
    record_id,
    sql_clean,
    sql_dirty_text,
    sql_extract_id,
    sql_fold,
    sql_pdf_path,
    sql_record_id,
    sql_slug,
    sql_strip_label,
    table,
    when,
)
from catalogproof.sources.tables import link_triage as triage_links

_DIRTY = sql_dirty_text("text", "doc_id")


@query("clean_text", f"SELECT doc_id, {sql_clean(_DIRTY)} AS cleaned FROM documents")
def clean_text(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", tx.clean_text(dirty_text(F.col("text"), F.col("doc_id"))).alias("cleaned"))


#: characters whose folds are longer, beyond the first plane, or none, and what they fold to
_SYMBOLS, _FOLDED = " ⑩ ⑴ ㎏ 𝐀 ½ ﬁ 日", " 10 (1) kg A 12 fi "


@query("fold_ascii", f"SELECT doc_id, {sql_fold('text')} || '{_FOLDED}' AS folded FROM documents")
def fold_ascii(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.fold_ascii(F.concat("text", F.lit(_SYMBOLS))).alias("folded")
    )


@query("fold_exact", f"SELECT doc_id, '{_FOLDED}' || {sql_fold('text')} AS folded FROM documents")
def fold_exact(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.fold_ascii(F.concat(F.lit(_SYMBOLS), "text")).alias("folded")
    )


@query(
    "slug",
    f"""SELECT doc_id, {sql_slug(f"(text || '{_FOLDED}')")} AS text_slug,
               coalesce(nullif({sql_slug("CASE WHEN doc_id % 9 = 0 THEN '¡!' ELSE source END")}, ''), 'sin-especialidad') AS source_slug
        FROM documents""",
)
def slug(spark, sf):
    odd = F.when(F.col("doc_id") % 9 == 0, F.lit("¡!")).otherwise(F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.slug(F.concat("text", F.lit(_SYMBOLS))).alias("text_slug"),
        tx.slug(odd, fx.NO_CATEGORY).alias("source_slug"),
    )


@query(
    "strip_label",
    f"""SELECT doc_id, coalesce(regexp_matches(c, {SQL_HAD_LABEL}), FALSE) AS had_prefix, {sql_strip_label('c')} AS stripped
        FROM (SELECT doc_id, {sql_clean(_DIRTY)} AS c FROM documents)""",
)
def strip_label(spark, sf):
    docs = table(spark, sf, "documents")
    cleaned = docs.select("doc_id", tx.clean_text(dirty_text(F.col("text"), F.col("doc_id"))).alias("c"))
    return cleaned.select(
        "doc_id", tx.had_label(F.col("c")).alias("had_prefix"), tx.strip_label(F.col("c")).alias("stripped")
    )


_PAGE_LINK = f"CASE WHEN page_id % 5 = 0 THEN url ELSE url || '&uuid=' || {sql_record_id('page_id')} END"


@query(
    "extract_id",
    f"""SELECT page_id, link, {sql_extract_id('link')} AS record_id, '{LINK_BASE}' || {sql_extract_id('link')} AS rebuilt
        FROM (SELECT page_id, {_PAGE_LINK} AS link FROM pages)""",
)
def extract_id(spark, sf):
    k, url = F.col("page_id"), F.col("url")
    link = F.when(k % 5 == 0, url).otherwise(F.concat(url, F.lit("&uuid="), record_id(k)))
    linked = table(spark, sf, "pages").select("page_id", link.alias("link"))
    found = linked.withColumn("record_id", tx.extract_id(F.col("link")))
    return found.withColumn("rebuilt", tx.link_for(F.col("record_id"), LINK_BASE))


_TRIAGE_LINK = (
    f"CASE WHEN page_id % 10 = 0 THEN ' ' WHEN page_id % 10 = 1 THEN url "
    f"ELSE '{DOWNLOAD_BASE}' || {sql_record_id('page_id')} END"
)


@query(
    "link_triage",
    f"""SELECT link_class, count(*) AS n FROM (
          SELECT CASE WHEN trim(link) = '' THEN 'no_link'
                      WHEN regexp_matches(link, 'ServletDescarga\\?uuid=[0-9a-fA-F-]{{36}}') THEN 'with_id'
                      ELSE 'odd_link' END AS link_class
          FROM (SELECT {_TRIAGE_LINK} AS link FROM pages)) GROUP BY link_class""",
)
def link_triage(spark, sf):
    k = F.col("page_id")
    link = when(
        (k % 10 == 0, F.lit(" ")),
        (k % 10 == 1, F.col("url")),
        otherwise=F.concat(F.lit(DOWNLOAD_BASE), record_id(k)),
    )
    classed = triage_links(table(spark, sf, "pages").select(link.alias("link")), "link")
    return classed.groupBy("link_class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "parse_dates",
    f"""WITH {SQL_ORDER_RECORDS}
        SELECT o_orderkey, {SQL_RULING_DATE} AS ruling_date, CAST(year({SQL_RULING_DATE}) AS INTEGER) AS year,
               {SQL_CASE_YEAR} AS case_year FROM order_records""",
)
def parse_dates(spark, sf):
    parsed = order_records(spark, sf).select(
        "o_orderkey", ql.ruling_date(F.col("raw_date")).alias("ruling_date"), ql.case_year(F.col("case_no")).alias("case_year")
    )
    return parsed.select("o_orderkey", "ruling_date", F.year("ruling_date").alias("year"), "case_year")


@query(
    "quality_flags",
    f"""WITH {SQL_ORDER_RECORDS},
        s AS (SELECT *, nullif(repeat(priority, CAST(o_orderkey % 4 AS INTEGER)), '') AS summary FROM order_records)
        SELECT o_orderkey, coalesce(year({SQL_RULING_DATE}) < {SQL_CASE_YEAR}, FALSE) AS date_incoherent,
               coalesce(length(summary) >= 20, FALSE) AS summary_useful FROM s""",
)
def quality_flags(spark, sf):
    rows = order_records(spark, sf)
    summary = tx.blank_to_null(F.expr("repeat(priority, cast(o_orderkey % 4 as int))"))
    return rows.select(
        "o_orderkey",
        ql.date_incoherent(F.year(ql.ruling_date(F.col("raw_date"))), ql.case_year(F.col("case_no"))).alias("date_incoherent"),
        ql.summary_useful(summary).alias("summary_useful"),
    )


_PATH = sql_pdf_path("kind", "number", "priority", "rid", "y")


@query(
    "build_path",
    f"""WITH {SQL_ORDER_RECORDS},
        p AS (SELECT o_orderkey, priority, year({SQL_RULING_DATE}) AS y,
                     CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'Casación' ELSE 'Apelación N.' END AS kind,
                     CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE case_no END AS number,
                     CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE record_id END AS rid FROM order_records)
        SELECT o_orderkey, {_PATH} AS pdf_path, regexp_replace({_PATH}, '\\.pdf$', '.md') AS md_path FROM p""",
)
def build_path(spark, sf):
    k = F.col("o_orderkey")
    rows = order_records(spark, sf)
    kind = F.when(k % 6 == 1, F.lit("Casación")).when(k % 6 > 1, F.lit("Apelación N."))
    path = ql.pdf_path(
        kind,
        F.when(k % 10 != 0, F.col("case_no")),
        F.col("priority"),
        F.when(k % 15 != 0, F.col("record_id")),
        F.year(ql.ruling_date(F.col("raw_date"))),
    )
    paths = rows.select("o_orderkey", path.alias("pdf_path"))
    return paths.withColumn("md_path", ql.md_path(F.col("pdf_path")))


@query(
    "split_case_key",
    r"""WITH k AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name || '-2020'
                     WHEN 2 THEN 'Casación-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '-2020'
                     ELSE 'A-B-' || c_name || '-2020' END AS case_key FROM customer),
        p AS (SELECT c_custkey, string_split(case_key, '-') AS parts FROM k)
        SELECT c_custkey,
               CASE WHEN len(parts) <= 2 THEN parts[1] ELSE array_to_string(parts[1:len(parts) - 2], '-') END AS case_type,
               CASE WHEN len(parts) = 1 THEN '' WHEN len(parts) = 2 THEN parts[2]
                    ELSE array_to_string(parts[len(parts) - 1:len(parts)], '-') END AS case_no FROM p""",
)
def split_case_key(spark, sf):
    k, name = F.col("c_custkey"), F.col("c_name")
    key = when(
        (k % 4 == 0, name),
        (k % 4 == 1, F.concat(name, F.lit("-2020"))),
        (k % 4 == 2, F.concat(F.lit("Casación-"), F.lpad(k.cast("string"), 6, "0"), F.lit("-2020"))),
        otherwise=F.concat(F.lit("A-B-"), name, F.lit("-2020")),
    )
    keyed = table(spark, sf, "customer").select("c_custkey", key.alias("case_key"))
    kind, number = tx.split_case_key(F.col("case_key"))
    return keyed.select("c_custkey", kind.alias("case_type"), number.alias("case_no"))


@query(
    "positional_rename",
    """SELECT p_name AS case_key, p_brand AS subject, p_type AS ruling_type,
              p_size AS ruling_date_raw, p_retailprice AS court FROM part""",
)
def positional_rename(spark, sf):
    return dedupe.positional_rename(table(spark, sf, "part"), fx.EXPORT_COLUMNS, fx.EXPORT_HELPERS)


@query("value_counts", "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def value_counts(spark, sf):
    return checks.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "top_values",
    "SELECT l_partkey AS value, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 40",
)
def top_values(spark, sf):
    """The forty most frequent values: the limit is the report."""
    return checks.value_counts(table(spark, sf, "lineitem"), "l_partkey", top=40)


@query(
    "distinct_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
            count(DISTINCT {c}) AS n_distinct, max(c) = 1 AS is_unique
            FROM (SELECT {c}, count(*) OVER (PARTITION BY {c}) AS c FROM documents)"""
        for c in ("doc_id", "text", "lang", "source")
    ),
)
def distinct_profile(spark, sf):
    return checks.distinct_profile(table(spark, sf, "documents"), ["doc_id", "text", "lang", "source"])


_HISTOGRAM_DATE = "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END"


@query("year_histogram", f"SELECT CAST(year({_HISTOGRAM_DATE}) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def year_histogram(spark, sf):
    dated = table(spark, sf, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderdate"))
    )
    return checks.year_histogram(dated, ["ruling_date", "o_orderdate"])


@query(
    "category_contains",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE coalesce(contains(lower(c_mktsegment), 'build'), FALSE)",
)
def category_contains(spark, sf):
    found = table(spark, sf, "customer").filter(tx.contains_ignoring_case(F.col("c_mktsegment"), "Build"))
    return found.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "scope_filter",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS category FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'
         AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
         AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def scope_filter(spark, sf):
    # a range on the stored column, against text literals that take its type, reaches the scan
    date = F.col("o_orderdate")
    wanted = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "F"))
        .filter((date >= F.lit("1996-01-01")) & (date < F.lit("2000-01-01")))
        .join(wanted, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .select("o_orderkey", F.year(date).alias("year"), F.col("o_orderpriority").alias("category"))
    )


@query(
    "download_order",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
       ORDER BY year(o_orderdate) DESC, o_orderkey LIMIT 500""",
)
def download_order(spark, sf):
    """The first 500 of the work list, newest year first (a top-k report)."""
    years = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return years.orderBy(F.desc("year"), "o_orderkey").limit(500)
