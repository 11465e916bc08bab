"""Document text: noise, sections, rejects and markdown."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import documents as dx
from catalogproof.functions import quality as ql
from catalogproof.operators import scaling
from catalogproof.plans import markdown as md
from catalogproof.queries.base import LINK_BASE, query, record_id, sql_pdf_path, sql_record_id, table
from catalogproof.sources import tables

# --- recipes -----------------------------------------------------------------------

_HEAD = "PODER JUDICIAL DEL PERÚ\n"
_STAMP = "\n\nFIRMA DIGITAL x\nlínea dos\n \n- 12 -\n\f"
_TAIL = "\n\n\n\n7\n\nfin"


def stamped(text):
    return F.concat(F.lit(_HEAD), text, F.lit(_STAMP), text, F.lit(_TAIL))


def _sql_literal(s: str) -> str:
    special = {"\n": "chr(10)", "\f": "chr(12)"}
    parts, plain = [], ""
    for ch in s:
        if ch in special:
            parts += [f"'{plain}'"] if plain else []
            parts.append(special[ch])
            plain = ""
        else:
            plain += ch
    return " || ".join(parts + ([f"'{plain}'"] if plain else []))


SQL_STAMPED = f"({_sql_literal(_HEAD)} || text || {_sql_literal(_STAMP)} || text || {_sql_literal(_TAIL)})"

_SECTION_TAIL = ["  resuelve no abrir otra", "III. DECISIÓN", "se decide", "S.S.", "firma"]


def sectioned(text):
    lines = F.split(text, "\n")
    rest = F.greatest(F.size(lines) - 3, F.lit(0))
    return F.array_join(
        F.concat(
            F.array(F.lit("VISTOS: el recurso")),
            F.slice(lines, F.lit(1), F.lit(2)),
            F.array(F.lit("CONSIDERANDO:")),
            F.slice(lines, F.lit(3), rest),
            F.array(F.lit(" DECLARARON INFUNDADO el recurso"), F.element_at(lines, -1)),
            F.array(*[F.lit(x) for x in _SECTION_TAIL]),
        ),
        "\n",
    )


_L = "string_split(text, chr(10))"
SQL_SECTIONED = f"""array_to_string(list_concat(['VISTOS: el recurso'], {_L}[1:2], ['CONSIDERANDO:'],
  CASE WHEN len({_L}) > 3 THEN {_L}[3:len({_L}) - 1] ELSE [] END,
  [' DECLARARON INFUNDADO el recurso', {_L}[len({_L})]], [{", ".join(f"'{x}'" for x in _SECTION_TAIL)}]), chr(10))"""

_WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def sql_strip_boilerplate(text: str) -> str:
    line_end = r"'\r\n|[\n\r\x0b\x0c\x1c-\x1e]'"
    kept = f"list_filter(string_split_regex({text}, '\\n\\s*\\n'), lambda b: NOT regexp_matches(b, '(?i){fx.STAMP}'))"
    cleaned = (
        f"list_transform({kept}, lambda b: trim(array_to_string(list_filter(string_split_regex(b, {line_end}), "
        f"lambda l: NOT regexp_matches(l, '(?i){fx.LETTERHEAD}')), chr(10)), {_WS}))"
    )
    joined = f"array_to_string(list_filter({cleaned}, lambda b: b <> ''), chr(10) || chr(10))"
    return f"trim(regexp_replace(replace({joined}, chr(12), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), {_WS})"


def _sql_ladder(line: str, rules, end: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({line}, '(?i)^\\s*(?:{p}){end}') THEN '{n}'" for p, n in rules)
    return f"CASE {cases} END"


def sql_marks(source: str) -> str:
    """CTEs ``marks`` (a line each, with what it opens) over ``source`` (doc_id, body)."""
    header = _sql_ladder("line", fx.SECTION_HEADERS, "\\s*[:.\\-]?\\s*$")
    opener = _sql_ladder("line", fx.SECTION_OPENERS, "")
    return f"""
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
          FROM (SELECT doc_id, string_split_regex(body, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e]') AS l FROM {source})),
named AS (SELECT *, coalesce(header, opener0) AS name FROM (SELECT *, {header} AS header, {opener} AS opener0 FROM lines)),
marks AS (SELECT doc_id, line, pos, header, name,
                 header IS NOT NULL OR (name IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, name ORDER BY pos) = 1) AS opens
          FROM named)"""


# --- queries -------------------------------------------------------------------------


@query("strip_boilerplate", f"SELECT doc_id, {sql_strip_boilerplate(SQL_STAMPED)} AS cleaned FROM documents")
def strip_boilerplate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", dx.strip_boilerplate(stamped(F.col("text"))).alias("cleaned"))


@query(
    "sectionize",
    f"""WITH src AS (SELECT doc_id, {SQL_SECTIONED} AS body FROM documents), {sql_marks('src')},
        numbered AS (SELECT *, CAST(count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER) AS section_no FROM marks)
        SELECT doc_id, section_no, max(name) FILTER (opens) AS section,
               coalesce(string_agg(CASE WHEN opens THEN ltrim(line) ELSE line END, chr(10) ORDER BY pos) FILTER (header IS NULL), '') AS body
        FROM numbered GROUP BY doc_id, section_no""",
)
def sectionize(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", sectioned(F.col("text")).alias("body_text"))
    return md.section_rows(docs, "body_text", "doc_id")


@query(
    "section_frequency",
    f"""WITH src AS (SELECT doc_id, {SQL_SECTIONED} AS body FROM documents WHERE doc_id % 3 <> 0
                     UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 3 = 0), {sql_marks('src')}
        SELECT name AS section, count(DISTINCT doc_id) AS n_docs, round(count(DISTINCT doc_id) / CAST((SELECT count(*) FROM documents) AS DOUBLE), 6) AS share
        FROM marks WHERE opens GROUP BY name""",
)
def section_frequency(spark, sf):
    text = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(sectioned(F.col("text")))
    docs = table(spark, sf, "documents").select("doc_id", dx.section_marks(text).alias("marks"))
    found = md.section_frequency(docs.select(dx.section_names(F.col("marks")).alias("sections")))
    return found.withColumn("share", F.round("share", 6))


def _catalogued(spark, sf, body):
    """Documents with the catalogue columns that markdown needs."""
    k = F.col("doc_id")
    rid = record_id(k)
    year = (k % 25 + 2000).cast("int")
    kind = F.when(k % 4 != 0, F.lit('Casación "N"'))
    number = F.concat(F.lpad((k % 5000).cast("string"), 6, "0"), F.lit("-"), year)
    raw = F.when(k % 50 == 49, F.lit(" \n")).when(k % 20 == 7, F.col("source")).otherwise(body)
    return table(spark, sf, "documents").select(
        "doc_id",
        rid.alias("record_id"),
        number.alias("case_no"),
        kind.alias("case_type"),
        F.col("lang").alias("category"),
        F.lit("Sala\nCivil").alias("court"),
        F.concat_ws("/", k % 28 + 1, k % 12 + 1, year).alias("ruling_date_raw"),
        year.alias("year"),
        F.col("source").alias("subject"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(" clave ").alias("keywords"),
        F.concat(F.lit(LINK_BASE), rid).alias("link"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.col("source"), F.lit(" "))).alias("summary"),
        ql.pdf_path(kind, number, F.col("lang"), rid, year).alias("pdf_path"),
        raw.alias("text"),
    ).withColumn("md_path", ql.md_path(F.col("pdf_path")))


def _sql_catalogued(body: str) -> str:
    kind = "CASE WHEN doc_id % 4 <> 0 THEN 'Casación \"N\"' END"
    number = "lpad(CAST(doc_id % 5000 AS VARCHAR), 6, '0') || '-' || CAST(doc_id % 25 + 2000 AS VARCHAR)"
    path = sql_pdf_path(kind, f"({number})", "lang", sql_record_id("doc_id"), "(doc_id % 25 + 2000)")
    return f"""raw AS (
  SELECT doc_id, {sql_record_id('doc_id')} AS record_id, {number} AS case_no, {kind} AS case_type, lang AS category,
         CAST(doc_id % 28 + 1 AS VARCHAR) || '/' || CAST(doc_id % 12 + 1 AS VARCHAR) || '/' || CAST(doc_id % 25 + 2000 AS VARCHAR) AS ruling_date_raw,
         CAST(doc_id % 25 + 2000 AS INTEGER) AS year, source AS subject, '{LINK_BASE}' || {sql_record_id('doc_id')} AS link,
         CASE WHEN doc_id % 3 = 0 THEN source END AS summary, {path} AS pdf_path,
         CASE WHEN doc_id % 50 = 49 THEN ' ' || chr(10) WHEN doc_id % 20 = 7 THEN source ELSE {body} END AS text
  FROM documents),
triaged AS (
  SELECT *, CASE WHEN trim(text, {_WS}) = '' THEN 'sin texto' WHEN length(body) < 200 THEN 'escaneado' END AS reason,
         length(text) - length(replace(text, chr(12), '')) + 1 AS n_pages
  FROM (SELECT *, {sql_strip_boilerplate('text')} AS body FROM raw))"""


@query(
    "text_rejects",
    f"""WITH {_sql_catalogued(SQL_STAMPED)}
        SELECT record_id, pdf_path AS path, reason, link AS url, year FROM triaged WHERE reason IS NOT NULL""",
)
def text_rejects(spark, sf):
    """Rejects written by year and read back."""
    path = scaling.shared_dir(spark, "rejects")
    tables.write_by_year(md.rejects(md.triage(_catalogued(spark, sf, stamped(F.col("text"))))), path)
    return spark.read.parquet(path)


_YAML = [
    ("uuid", "record_id"),
    ("expediente", "case_no"),
    ("recurso", "replace(coalesce(case_type, ''), '\"', '''')"),
    ("especialidad", "category"),
    ("sala", "'Sala Civil'"),
    ("fecha", "ruling_date_raw"),
    ("anio", "CAST(year AS VARCHAR)"),
    ("materia", "subject"),
    ("norma", "''"),
    ("palabras_clave", "'clave'"),
    ("url", "link"),
    ("paginas", "CAST(n_pages AS VARCHAR)"),
    ("caracteres", "CAST(length(t.body) AS VARCHAR)"),
    ("secciones", "coalesce(s.names, '')"),
]
_SQL_HEAD = " || ".join(f"'{k}: \"' || {v} || '\"' || chr(10)" for k, v in _YAML)


@query(
    "to_markdown",
    f"""WITH {_sql_catalogued(f"({SQL_SECTIONED} || {_sql_literal(_STAMP)} || text)")},
        usable AS (SELECT * FROM triaged WHERE reason IS NULL), {sql_marks('usable')},
        firsts AS (SELECT doc_id, name, min(pos) AS p FROM marks WHERE opens GROUP BY ALL),
        s AS (SELECT doc_id, string_agg(name, ', ' ORDER BY p) AS names FROM firsts GROUP BY doc_id),
        bodies AS (SELECT doc_id, string_agg(
                     CASE WHEN header IS NOT NULL THEN chr(10) || '## ' || header || chr(10)
                          WHEN opens THEN chr(10) || '## ' || name || chr(10) || chr(10) || ltrim(line) ELSE line END,
                     chr(10) ORDER BY pos) AS md FROM marks GROUP BY doc_id)
        SELECT record_id, category, year, regexp_replace(pdf_path, '\\.pdf$', '.md') AS md_path,
               '---' || chr(10) || {_SQL_HEAD} || '---' || chr(10) || chr(10)
               || '# ' || coalesce(case_type, '') || ' ' || case_no || chr(10)
               || CASE WHEN summary IS NULL THEN '' ELSE chr(10) || '> **Sumilla.** ' || summary || chr(10) END
               || chr(10) || trim(md, {_WS}) || chr(10) AS markdown
        FROM usable t JOIN bodies b USING (doc_id) LEFT JOIN s USING (doc_id)""",
)
def to_markdown(spark, sf):
    """One markdown text per document, written by outcome, category and year and read back."""
    body = F.concat(sectioned(F.col("text")), F.lit(_STAMP), F.col("text"))
    path = scaling.shared_dir(spark, "markdown")
    tables.write_converted(md.convert(md.triage(_catalogued(spark, sf, body))), path)
    return spark.read.parquet(path).filter("outcome = 'markdown'").select("record_id", "category", "year", "md_path", "markdown")
