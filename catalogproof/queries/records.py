"""Duplicates, canonical spellings, the cleaned table, its gate and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import text as tx
from catalogproof.operators import canonical, checks, dedupe, scaling
from catalogproof.plans import cleaning
from catalogproof.queries.base import (
    LINK_BASE,
    SQL_CATALOGUE,
    SQL_CLEANED,
    SQL_HARVESTED,
    SQL_ORDER_RECORDS,
    SQL_RECORDS,
    SQL_WHOLE_REPEATED,
    catalogue,
    harvested,
    order_records,
    query,
    record_id,
    records,
    whole_repeated,
    sql_category_key,
    sql_record_id,
    sql_slug,
    table,
)
from catalogproof.schemas import CATEGORY_COLUMNS, CLEAN_COLUMNS, RECORD_COLUMNS, TEXT_COLUMNS
from catalogproof.sources import chunks, tables


@query(
    "merge_chunks",
    f"""WITH {SQL_WHOLE_REPEATED},
        n AS (SELECT *, row_id >= 1000000000 AS again, (page - 1) // 25 AS chunk FROM repeated),
        p AS (SELECT *, row_number() OVER (PARTITION BY again, category, chunk ORDER BY row_id) AS nth FROM n)
        SELECT category, page, record_id, subject, link FROM (
          SELECT *, row_number() OVER (PARTITION BY category, record_id ORDER BY chunk, nth, again) AS rn FROM p)
        WHERE rn = 1""",
)
def merge_chunks(spark, sf):
    """Two deliveries as chunk files; repeats differ in page and subject and lie in other objects and files."""
    path = scaling.shared_dir(spark, "deliveries")
    rows = whole_repeated(spark, sf).select("row_id", "record_id", "category", "page", "link", "subject")
    again = F.col("row_id") >= 1_000_000_000
    for number, part in enumerate((rows.filter(~again), rows.filter(again))):
        chunks.write_chunks(part, f"{path}/delivery{number}")
    stored, _ = chunks.read_chunks(spark, path)
    merged = dedupe.merge_chunks(stored, chunks.CHUNK_ORDER)
    return merged.select("category", "page", "record_id", "subject", "link")


@query(
    "record_table",
    f"""WITH {SQL_WHOLE_REPEATED}
        SELECT '' AS case_type, '' AS case_no, subject, '' AS ruling_type, '' AS ruling_date_raw, '' AS court, '' AS rule,
               '' AS summary, '' AS keywords, link, category, CAST(page AS VARCHAR) AS page FROM (
          SELECT *, row_number() OVER (PARTITION BY category, record_id ORDER BY row_id) AS rn FROM repeated)
        WHERE rn = 1""",
)
def record_table(spark, sf):
    return tables.record_table(dedupe.merge_chunks(whole_repeated(spark, sf), ["row_id"]))


@query(
    "content_duplicates",
    """WITH g AS (SELECT lang, text, min(doc_id) AS first_row,
                         row_number() OVER (ORDER BY lang || chr(31) || text) - 1 AS dup_group
                  FROM documents GROUP BY lang, text HAVING count(*) > 1)
       SELECT doc_id, dup_group, dup_group IS NOT NULL AS is_content_dup,
              coalesce(doc_id <> first_row, FALSE) AS is_droppable_copy
       FROM documents LEFT JOIN g USING (lang, text)""",
)
def content_duplicates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    marked = dedupe.mark_content_duplicates(docs, "doc_id", ["lang", "text"])
    return marked.select("doc_id", "dup_group", "is_content_dup", "is_droppable_copy")


_CUSTOMER_KEY = (
    "CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN o_custkey ELSE 1000000000 + o_orderkey END"
)


@query(
    "repeated_ids",
    f"""SELECT o_orderkey, k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AS id_repeated
        FROM (SELECT o_orderkey, {_CUSTOMER_KEY} AS k FROM orders)""",
)
def repeated_ids(spark, sf):
    keyed = table(spark, sf, "orders").select("o_orderkey", F.expr(_CUSTOMER_KEY).alias("k"))
    return dedupe.mark_repeated(keyed, "k", "o_orderkey").select("o_orderkey", "id_repeated")


@query(
    "canonical_category",
    f"""WITH {SQL_ORDER_RECORDS},
        forms AS (SELECT key, value FROM (
          SELECT {sql_category_key('priority')} AS key, priority AS value,
                 row_number() OVER (PARTITION BY {sql_category_key('priority')} ORDER BY count(*) DESC, priority) AS rn
          FROM order_records GROUP BY priority) WHERE rn = 1)
        SELECT o_orderkey, value AS priority FROM order_records JOIN forms ON key = {sql_category_key('priority')}""",
)
def canonical_category(spark, sf):
    rows = order_records(spark, sf).select("o_orderkey", "priority")
    return canonical.canonicalize(rows, ["priority"], "o_orderkey")


@query(
    "lookup_first",
    f"""WITH links AS (SELECT o_custkey, min(o_orderkey) AS first_key, count(*) AS match_count
                       FROM orders GROUP BY o_custkey)
        SELECT c_custkey, coalesce('{LINK_BASE}' || {sql_record_id('first_key')}, '') AS link,
               coalesce(match_count, 0) AS match_count
        FROM customer LEFT JOIN links ON o_custkey = c_custkey""",
)
def lookup_first(spark, sf):
    export = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("C-"), F.col("c_custkey")).alias("case_key"))
    links = (
        table(spark, sf, "orders").select(
            F.concat(F.lit("C-"), F.col("o_custkey")).alias("case_key"),
            F.concat(F.lit(LINK_BASE), record_id(F.col("o_orderkey"))).alias("link"),
            "o_orderkey",
        )
    )
    found = dedupe.lookup_first_link(export, links, "case_key", "link", "o_orderkey", "c_custkey")
    return found.select("c_custkey", "link", "match_count")


@query(
    "new_records",
    f"""WITH {SQL_HARVESTED}
        SELECT record_id, row_id, category, page FROM catalogue
        WHERE record_id NOT IN (SELECT record_id FROM harvested)""",
)
def new_records(spark, sf):
    candidates = catalogue(spark, sf)
    again = candidates.filter(F.col("row_id") % 2 == 0).withColumn("row_id", F.col("row_id") + 1_000_000_000)
    fresh = dedupe.new_records(candidates.unionByName(again), harvested(spark, sf), "record_id", ["row_id"])
    return fresh.select("record_id", "row_id", "category", "page")


# --- the cleaned table ------------------------------------------------------------

_CLEAN_LIST = ", ".join([*RECORD_COLUMNS, *CLEAN_COLUMNS, "row_id"])


def _stored_records(spark, sf):
    """The dirty records as the stored table that cleaning starts from."""
    return scaling.materialize(records(spark, sf), "records")


@query("clean_records", f"WITH {SQL_CLEANED} SELECT {_CLEAN_LIST} FROM cleaned")
def clean_records(spark, sf):
    return cleaning.clean_records(_stored_records(spark, sf))


def _before_and_after(spark, sf):
    before = _stored_records(spark, sf)
    return before, scaling.materialize(cleaning.clean_records(before), "cleaned")


def _sql_changed(column: str) -> str:
    return f"nullif(trim(CAST(b.{column} AS VARCHAR)), '') IS DISTINCT FROM CAST(a.{column} AS VARCHAR)"


_RULES = {
    "row_count": "max(abs((SELECT count(*) FROM records) - (SELECT count(*) FROM cleaned)))",
    "row_ids": "max((SELECT count(*) FROM records b FULL JOIN cleaned a ON a.row_id = b.row_id WHERE a.row_id IS NULL OR b.row_id IS NULL))",
    "column_order": "count(*) * 0",
    "id_sequence": "count(*) FILTER (nullif(regexp_extract(b.link, 'uuid=([0-9a-fA-F-]{36})', 1), '') IS DISTINCT FROM a.record_id)",
    "value_lost": " + ".join(
        f"count(*) FILTER (b.{c} IS NOT NULL AND a.{c} IS NULL)" for c in RECORD_COLUMNS if c != "summary"
    )
    + r" + count(*) FILTER (b.summary IS NOT NULL AND a.summary IS NULL AND "
    + r"trim(regexp_replace(b.summary, '(?i)^(?:\s*(?:sumilla\s*)?[.:–—-]+\s*)+', ''), ' ' || chr(9) || chr(10)) <> '')",
    "label_left": r"count(*) FILTER (regexp_matches(a.summary, '(?i)^(?:\s*(?:sumilla\s*)?[.:–—-]+\s*)+'))",
    "spacing_left": " + ".join(rf"count(*) FILTER (regexp_matches(a.{c}, '\s\s|[\n\r\t]'))" for c in TEXT_COLUMNS),
    "id_null": "count(*) FILTER (a.record_id IS NULL)",
    "id_malformed": "count(*) FILTER (NOT coalesce(regexp_full_match(a.record_id, '[0-9a-f-]{36}'), FALSE))",
    "id_not_of_link": "count(*) FILTER (nullif(regexp_extract(a.link, 'uuid=([0-9a-fA-F-]{36})', 1), '') IS DISTINCT FROM a.record_id)",
    "path_collides": "count(*) - count(DISTINCT a.pdf_path)",
    "path_malformed": r"count(*) FILTER (NOT regexp_full_match(a.pdf_path, '[a-z0-9-]+/(?:[0-9]{4}|sin-anio)/[a-z0-9-]+\.pdf'))",
    **{f"changed_{c}": f"count(*) FILTER ({_sql_changed(c)})" for c in checks.UNTOUCHED},
}


@query(
    "conservation_check",
    f"""WITH {SQL_CLEANED},
        c AS MATERIALIZED (SELECT * FROM cleaned)
        {" UNION ALL ".join(f'''SELECT '{n}' AS "check", CAST({e} AS BIGINT) AS violations
                               FROM records b JOIN c a ON a.row_id = b.row_id''' for n, e in _RULES.items())}""",
)
def conservation_check(spark, sf):
    return checks.conservation_check(*_before_and_after(spark, sf))


_METRICS = {
    **{f"cells_changed_{c}": f"count(*) FILTER (coalesce(b.{c}, '') <> coalesce(a.{c}, ''))" for c in TEXT_COLUMNS},
    "prefix_removed": "count(*) FILTER (summary_had_prefix)",
    "summary_emptied": "count(*) FILTER (b.summary IS NOT NULL AND a.summary IS NULL)",
    "summary_useful": "count(*) FILTER (summary_useful)",
    "date_incoherent": "count(*) FILTER (date_incoherent)",
    "id_repeated": "count(*) FILTER (id_repeated)",
    "content_duplicates": "count(*) FILTER (is_content_dup)",
    "duplicate_groups": "count(DISTINCT dup_group)",
    "droppable_copies": "count(*) FILTER (is_droppable_copy)",
    "rows_without_copies": "count(*) FILTER (NOT is_droppable_copy)",
    "longest_path": "max(length(pdf_path))",
    **{f"spellings_before_{c}": f"count(DISTINCT b.{c})" for c in CATEGORY_COLUMNS},
    **{f"spellings_after_{c}": f"count(DISTINCT a.{c})" for c in CATEGORY_COLUMNS},
    "summaries_before": "count(DISTINCT b.summary)",
    "summaries_after": "count(DISTINCT a.summary)",
    "folders": "count(DISTINCT regexp_extract(pdf_path, '^(.*)/', 1))",
    "largest_folder": "max((SELECT max(n) FROM (SELECT count(*) AS n FROM c GROUP BY regexp_extract(pdf_path, '^(.*)/', 1))))",
}


@query(
    "cleaning_report",
    f"""WITH {SQL_CLEANED},
        c AS MATERIALIZED (SELECT * FROM cleaned)
        {" UNION ALL ".join(f'''SELECT '{n}' AS metric, CAST({e} AS BIGINT) AS value
                               FROM records b JOIN c a ON a.row_id = b.row_id''' for n, e in _METRICS.items())}""",
)
def cleaning_report(spark, sf):
    return checks.cleaning_report(*_before_and_after(spark, sf))


@query(
    "spelling_changes",
    f"""WITH {SQL_CLEANED}
        {" UNION ALL ".join(f'''SELECT '{c}' AS "column", b.{c} AS old, a.{c} AS new, count(*) AS n
             FROM records b JOIN cleaned a ON a.row_id = b.row_id
             WHERE b.{c} IS NOT NULL AND b.{c} IS DISTINCT FROM a.{c} GROUP BY ALL''' for c in CATEGORY_COLUMNS)}""",
)
def spelling_changes(spark, sf):
    before = _stored_records(spark, sf)
    return checks.spelling_changes(before, canonical.canonicalize(before, CATEGORY_COLUMNS, "row_id"))


@query(
    "path_collisions",
    f"""WITH {SQL_ORDER_RECORDS},
        n AS (SELECT order_year AS year, {sql_slug("coalesce(o_orderstatus, 'resolucion')")} || '-' || coalesce(case_no, '') AS name,
                     count(*) AS n FROM order_records GROUP BY ALL)
        SELECT year, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_names, CAST(sum(n) - count(*) AS BIGINT) AS n_overwritten,
               count(*) FILTER (n > 1) AS n_repeated_names FROM n GROUP BY year""",
)
def path_collisions(spark, sf):
    rows = order_records(spark, sf).withColumnRenamed("order_year", "year")
    return checks.path_collisions(rows, "o_orderstatus", "case_no", ["year"])


@query(
    "expectations",
    f"""WITH {SQL_CATALOGUE},
        a AS (SELECT count(*) AS n, count(*) FILTER (category = 'en') AS c, count(DISTINCT record_id) AS d,
                     min(year) AS y0, max(year) AS y1 FROM catalogue),
        p AS (SELECT count(*) AS n, count(*) FILTER (lang = 'en') AS c, min(doc_id % 25) + 2000 AS y0, max(doc_id % 25) + 1999 AS y1 FROM documents)
        SELECT 'rows' AS "check", p.n AS expected, a.n AS actual, a.n = p.n AS ok FROM a, p
        UNION ALL SELECT 'category_rows', p.c, a.c, a.c = p.c FROM a, p
        UNION ALL SELECT 'distinct_ids', a.n - 5, d, d >= a.n - 5 FROM a
        UNION ALL SELECT 'first_year', p.y0, a.y0, a.y0 = p.y0 FROM a, p
        UNION ALL SELECT 'last_year', p.y1, a.y1, a.y1 = p.y1 FROM a, p""",
)
def expectations(spark, sf):
    """What the delivered table promises, against the catalogue; the last year is promised one too early."""
    place = F.col("doc_id") % 25
    promised = table(spark, sf, "documents").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("lang") == "en").alias("category_rows"),
        (F.min(place) + 2000).alias("first_year"),
        (F.max(place) + 1999).alias("last_year"),
    )
    return checks.expectations(catalogue(spark, sf), promised.first().asDict(), "en")


@query(
    "official_export",
    f"""WITH {SQL_RECORDS},
        harvest AS (SELECT coalesce(case_type, '') || '-' || coalesce(case_no, '') AS case_key, min(row_id) AS first_row, count(*) AS match_count
                    FROM records WHERE page % 7 <> 3 GROUP BY 1)
        SELECT r.row_id, r.case_type, r.case_no, r.subject, r.court, coalesce(h.link, '') AS link, coalesce(match_count, 0) AS match_count
        FROM (SELECT * REPLACE (coalesce(case_type, '') AS case_type, coalesce(case_no, '') AS case_no) FROM records) r
        LEFT JOIN (SELECT case_key, match_count, x.link FROM harvest JOIN records x ON x.row_id = first_row) h
               ON h.case_key = r.case_type || '-' || r.case_no""",
)
def official_export(spark, sf):
    """Every record as the official export lists it, by position and with its case key whole, and the harvest's first link for it."""
    harvest = _stored_records(spark, sf)
    export = harvest.select(
        F.lit(None).cast("string"), tx.case_key(F.col("case_type"), F.col("case_no")), "subject", "ruling_type", "ruling_date_raw", "court", "row_id"
    )
    names = [*fx.EXPORT_COLUMNS[:6], "row_id"]
    found = dedupe.export_with_links(
        export.toDF(*[f"c{i}" for i in range(7)]), harvest.filter(F.col("page") % 7 != 3), names, fx.EXPORT_COLUMNS[:1], "row_id", "row_id"
    )
    return found.select("row_id", "case_type", "case_no", "subject", "court", "link", "match_count")


@query(
    "category_codes",
    f"""WITH names(code, name) AS (VALUES {", ".join(f"({v}, '{k}')" for k, v in fx.CATEGORIES.items())}),
        asked AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Otra' ELSE (SELECT name FROM names WHERE code = o_orderkey % 12 + 1) END AS category FROM orders)
        SELECT o_orderkey, CAST(code AS INTEGER) AS code, coalesce(name, {sql_slug('category')}) AS category FROM asked LEFT JOIN names ON name = category""",
)
def category_codes(spark, sf):
    """A category and its code for every order; the category goes through its slug and back, an unknown one stays a slug."""
    number = (F.col("o_orderkey") % len(fx.CATEGORIES)).cast("int")
    name = F.when(F.col("o_orderkey") % 5 == 0, F.lit("Otra")).otherwise(F.get(F.array(*map(F.lit, fx.CATEGORIES)), number))
    asked = table(spark, sf, "orders").select("o_orderkey", name.alias("name"))
    return asked.select(
        "o_orderkey", chunks.category_code(F.col("name")).alias("code"), chunks.category_for(tx.slug(F.col("name"))).alias("category")
    )
