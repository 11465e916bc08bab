"""Listing pages: items, payloads, labels and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import html as hx
from catalogproof.functions import quality as ql
from catalogproof.operators import panels
from catalogproof.plans import audit
from catalogproof.queries.base import query, record_id, sql_record_id, table, when

#: the given pages list their items as ``<li><a href="X">Y</a></li>``
ITEMS = hx.PanelLayout(
    start=r"(?=<li><a href=)",
    link=r'<a href="([^"]*)"',
    link_id=r"^(.+)$",
    counter=r"<li>\s*<a ",
)

_ITEMS = r"""regexp_extract_all(html, '<li><a href="([^"]*)">', 1)"""


@query(
    "explode_panels",
    rf"""SELECT page_id, CAST(i - 1 AS INTEGER) AS panel_no, x AS link_id, y AS label FROM (
           SELECT page_id, unnest({_ITEMS}) AS x, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS y,
                  unnest(range(1, len({_ITEMS}) + 1)) AS i FROM pages) WHERE x <> ''""",
)
def explode_panels(spark, sf):
    items = panels.explode_panels(table(spark, sf, "pages").select("page_id", "html"), layout=ITEMS)
    label = hx.inner_text(F.regexp_extract("panel", "(?s)^<li>(.*?)</li>", 1))
    return items.select("page_id", "panel_no", "link_id", label.alias("label"))


@query(
    "panel_reconcile",
    rf"""SELECT page_id, len(regexp_extract_all(html, '<li>\s*<a ')) AS n_shown, len({_ITEMS}) AS n_parsed,
               len(regexp_extract_all(html, '<li>\s*<a ')) = len({_ITEMS}) AS agrees FROM pages""",
)
def panel_reconcile(spark, sf):
    return panels.reconcile_panels(table(spark, sf, "pages"), ["page_id"], layout=ITEMS)


_ANNOUNCED = "CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id * 137 % 90000 END"


@query(
    "listing_totals",
    f"""SELECT page_id, CASE WHEN page_id % 7 <> 0 THEN page_id * 1000 + 674 END AS corpus_total, {_ANNOUNCED} AS result_total,
               CAST(ceil({_ANNOUNCED} / 10.0) AS BIGINT) AS n_pages FROM pages""",
)
def listing_totals(spark, sf):
    """Totals announced inside the page's markup, with thousand marks; every seventh page says none."""
    k = F.col("page_id")
    said = F.concat(
        F.lit("<p>De un total de <b>"),
        F.regexp_replace(F.format_number(k * 1000 + 674, 0), ",", "."),
        F.lit("</b> resoluciones, se obtuvieron "),
        F.format_number(k * 137 % 90000, 0),
        F.lit(" resultados</p>"),
    )
    html = F.when(k % 7 == 0, F.col("html")).otherwise(F.concat(F.col("html"), said))
    corpus, results = hx.listing_totals(F.col("html"))
    totals = table(spark, sf, "pages").select("page_id", html.alias("html"))
    found = totals.select("page_id", corpus.alias("corpus_total"), results.alias("result_total"))
    return found.withColumn("n_pages", hx.announced_pages(F.col("result_total")))


# --- panels built from the events and documents ---------------------------------------


def _onclick(spark, sf):
    """Events as panels' scripts: a JSON object inside a JS string inside an HTML attribute."""
    k = F.col("event_id")
    broken = F.when(k % 9 == 0, F.lit('"')).otherwise(F.lit(""))  # an unescaped quote
    body = F.concat(
        F.lit('"parameters":{"uuid":"'),
        record_id(k),
        F.lit('","recurso":"Casación \\\\u002D '),
        k.cast("string"),
        F.lit('","sumilla":"a{b} '),
        broken,
        F.lit('c\\\\/d","props":'),
        F.col("props"),
        F.lit("}} );"),
    )
    js = F.replace(body, F.lit('"'), F.lit('\\"'))
    attribute = F.replace(F.replace(js, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    attribute = F.when(k % 2 == 0, F.replace(attribute, F.lit("ó"), F.lit("&#243;"))).otherwise(
        F.replace(attribute, F.lit("ó"), F.lit("&oacute;"))
    )
    return table(spark, sf, "events").withColumn("onclick", F.concat(F.lit("RichFaces.ajax(this, {"), attribute))


@query(
    "payload_fields",
    f"""SELECT event_id, event_id % 9 <> 0 AS readable,
               CASE WHEN event_id % 9 <> 0 THEN {sql_record_id('event_id')} END AS sheet_id,
               CASE WHEN event_id % 9 <> 0 THEN 'Casación - ' || CAST(event_id AS VARCHAR) END AS case_type,
               CASE WHEN event_id % 9 <> 0 THEN 'a{{b}} c/d' END AS summary,
               CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def payload_fields(spark, sf):
    read = _onclick(spark, sf).select("event_id", hx.payload(F.col("onclick")).alias("p"))
    return read.select(
        "event_id",
        F.col("p").isNotNull().alias("readable"),
        F.col("p")["uuid"].alias("sheet_id"),
        F.col("p")["recurso"].alias("case_type"),
        F.col("p")["sumilla"].alias("summary"),
        F.get_json_object(F.col("p")["props"], "$.k").cast("bigint").alias("k"),
    )


def _panel(k, link_id, sheet_id, broken):
    """One panel of a listing page: header, labels, download link and the sheet's script."""
    payload = F.concat(
        F.lit('RichFaces.ajax({"parameters":{"uuid":"'),
        sheet_id,
        F.lit('","recurso":"CAS","nroexp":"'),
        k.cast("string"),
        F.lit('","sala":"'),
        F.when(broken, F.lit('"')).otherwise(F.lit("")),
        F.lit('Sala payload"}})'),
    )
    script = F.replace(F.replace(payload, F.lit('"'), F.lit('\\"')), F.lit('"'), F.lit("&quot;"))
    return F.concat(
        F.lit('<div id="formBuscador:repeat:0:j_idt1" style="width:100%"><div class="rf-p-hdr"><span>Apela<b>ci&oacuten</b></span><span>'),
        k.cast("string"),
        F.lit('</span></div><div class="txtbold">Sala Suprema :</div> <div>Sala <b>visible</b></div><div class="x txtbold">Pretensión/Delito:</div><div> &lt;robo&gt;&#146;&#9999999;&lpar; </div>'),
        F.when(link_id.isNotNull(), F.concat(F.lit('<a href="/x/ServletDescarga?uuid='), link_id, F.lit('">PDF</a>'))).otherwise(F.lit("")),
        F.when(sheet_id.isNotNull(), F.concat(F.lit('<a id="formBuscador:repeat:0:j_idt9" onclick="'), script, F.lit('">Ver ficha</a>'))).otherwise(F.lit("")),
        F.lit("</div>"),
    )


def _panel_pages(spark, sf):
    """Every given page with two panels in its markup: the page's own before it and one of mixed health behind it."""
    k = F.col("page_id")
    own = _panel(k, record_id(k), record_id(k), F.lit(False))
    other = k + 1_000_000
    sheet = when(
        (k % 5 == 0, F.lit(None).cast("string")), (k % 5 == 1, record_id(k)), otherwise=record_id(other)
    )
    second = _panel(other, F.when(k % 6 != 0, record_id(other)), sheet, k % 5 == 2)
    page = F.coalesce("html", F.lit(""))
    html = F.concat(F.lit("<html><body><div id='top'>"), own, page, second, page, F.lit("</div></body></html>"))
    return table(spark, sf, "pages").select("page_id", html.alias("html"))


_TRUST = "CASE WHEN n = 0 THEN 'json' WHEN k5 IN (0, 2) THEN 'html' WHEN k5 = 1 THEN 'html-descuadre' ELSE 'json' END"


@query(
    "harvest_panels",
    f"""WITH p AS (SELECT page_id, n, page_id % 5 AS k5, CASE n WHEN 0 THEN page_id ELSE page_id + 1000000 END AS k
                   FROM pages, (VALUES (0), (1)) v(n) WHERE n = 0 OR page_id % 6 <> 0),
             t AS (SELECT *, {_TRUST} AS provenance FROM p)
        SELECT page_id, CAST(n AS INTEGER) AS panel_no, {sql_record_id('k')} AS link_id,
               CASE WHEN provenance = 'json' THEN 'CAS' ELSE 'Apelación' END AS case_type, CAST(k AS VARCHAR) AS case_no,
               CASE WHEN provenance = 'json' THEN '' ELSE '<robo>’�(' END AS subject,
               CASE WHEN provenance = 'json' THEN 'Sala payload' ELSE 'Sala visible' END AS court, provenance,
               CASE WHEN provenance = 'html-descuadre' THEN {sql_record_id('page_id')} END AS sheet_id FROM t""",
)
def harvest_panels(spark, sf):
    read = panels.read_panels(panels.explode_panels(_panel_pages(spark, sf)))
    return read.select("page_id", "panel_no", "link_id", "case_type", "case_no", "subject", "court", "provenance", "sheet_id")


@query(
    "label_fields",
    """SELECT doc_id, 'Sala ' || source AS court, lang AS subject, 'palabra & ' || source AS keywords, CAST(NULL AS VARCHAR) AS rule FROM documents""",
)
def label_fields(spark, sf):
    def pair(label, value):
        return F.concat(F.lit(f'<div class="txtbold">{label}</div>\n<div class="v">'), value, F.lit("</div>"))

    panel = F.concat(
        pair("Sala Suprema:", F.concat(F.lit("Sala <i>"), F.col("source"), F.lit("</i>"))),
        pair("PRETENSIÓN/DELITO :", F.col("lang")),
        pair("Palabras&nbsp;clave", F.lit("anterior")),
        pair("Palabras clave", F.concat(F.lit("palabra &amp; "), F.col("source"))),
        pair("Otra cosa", F.lit("x")),
    )
    read = table(spark, sf, "documents").select("doc_id", hx.label_fields(panel).alias("f"))
    return read.select("doc_id", *[F.col("f")[c].alias(c) for c in ("court", "subject", "keywords", "rule")])


_SHEET = "CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 8 = 1 THEN user_id + 1 ELSE user_id END"
_FILE = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END"


@query(
    "mismatch_rollup",
    f"""WITH c AS (SELECT event_type AS category, CASE WHEN l IS NULL THEN 'no_file' WHEN s IS NULL THEN 'unreadable'
                          WHEN l = s THEN 'ok' ELSE 'mismatch' END AS o FROM (SELECT event_type, {_FILE} AS l, {_SHEET} AS s FROM events))
        SELECT category, CAST(grouping(category) AS INTEGER) AS is_total, count(*) AS n,
               {", ".join(f"count(*) FILTER (o = '{k}') AS n_{k}" for k in ("ok", "mismatch", "no_file", "unreadable"))},
               {", ".join(f"round(count(*) FILTER (o = '{k}') * 100 / CAST(count(*) AS DOUBLE), 4) AS pct_{k}" for k in ("ok", "mismatch", "no_file", "unreadable"))}
        FROM c GROUP BY ROLLUP (category)""",
)
def mismatch_rollup(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.expr(_FILE).alias("link_id"), F.expr(_SHEET).alias("sheet_id"))
    outcome = ql.id_match(F.col("link_id"), F.col("sheet_id"))
    return audit.mismatch_rollup(events.select(F.col("event_type").alias("category"), outcome.alias("outcome")))
