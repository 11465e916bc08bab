"""Panels, payloads, labels and totals on small pages."""

import html as htmllib

import pytest
from pyspark.sql import functions as F

from catalogproof.functions import html as hx
from catalogproof.operators import panels

A, B = "aaaaaaaa-0000-1111-2222-333344445555", "bbbbbbbb-0000-1111-2222-333344445555"


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in sorted(df.select("i", fn(F.col("v")).alias("o")).collect(), key=lambda r: r["i"])]


def test_unescape(spark):
    values = ["a &amp;quot; &lt;b&gt; &oacute;&#243;&#xF3; &unknown; & &#39;", "plain", None, "&quot;&amp;"]
    assert apply(spark, values, hx.unescape) == [htmllib.unescape(v) if v else v for v in values]


def test_finish_unescape(spark):
    values = ["a\\u002Db", "x\\/y", 'q"\\u0041\\n', "\\\\u0041", "line\n\\u0041", "none\\t", None]
    assert apply(spark, values, hx.finish_unescape) == ["a-b", "x/y", 'q"A\\n', "\\A", "line\nA", "none\\t", None]


def script(body):
    return htmllib.escape('go({"parameters":' + body + "} , 1);".replace('"', '\\"')).replace("&quot;", "\\&quot;")


def test_payload(spark):
    values = [
        script('{"uuid":"1","sumilla":"llaves {x} y \\\\u002D","n":null}'),
        script('{"uuid":"1","sumilla":"dice "hola" y"}'),
        "go()",
        None,
    ]
    assert apply(spark, values, hx.payload) == [{"uuid": "1", "sumilla": "llaves {x} y -", "n": None}, None, None, None]


def panel(number, link, sheet, court="Sala p", broken=False):
    extra = '"' if broken else ""
    onclick = script('{"uuid":"%s","sala":"%s%s"}' % (sheet, extra, court)) if sheet else ""
    return (
        f'<div id="formBuscador:repeat:{number}:j_idt40" style="width:100%">'
        f'<div class="rf-p-hdr"><span> Casaci&oacute;n </span><span>00{number}-2020</span></div>'
        '<div class="txtbold">Sala Suprema:</div><br/><div>Sala <b>v</b></div>'
        + (f'<a href="/x/ServletDescarga?uuid={link}">pdf</a>' if link else "")
        + (f'<a id="formBuscador:repeat:{number}:j_idt491" onclick="{onclick}">ficha</a>' if sheet else "")
        + "</div>"
    )


def test_panels(spark):
    page = "<html><div id='x'>" + "".join(
        [panel(0, A, A), panel(1, A, B), panel(2, None, B), panel(3, B, B, broken=True), panel(4, B, None)]
    )
    df = spark.createDataFrame([(1, page), (2, "<html/>"), (3, None)], "page_id int, html string")
    rows = panels.read_panels(panels.explode_panels(df)).orderBy("panel_no").collect()
    seen = [(r["panel_no"], r["link_id"], r["court"], r["case_type"], r["provenance"], r["sheet_id"]) for r in rows]
    assert seen == [
        (0, A, "Sala p", "", "json", None),
        (1, A, "Sala v", "Casación", "html-descuadre", B),
        (3, B, "Sala v", "Casación", "html", None),
        (4, B, "Sala v", "Casación", "html", None),
    ]
    counts = {r["page_id"]: (r["n_shown"], r["n_parsed"]) for r in panels.reconcile_panels(df, ["page_id"]).collect()}
    assert counts[1] == (5, 4) and counts[2] == (0, 0)


@pytest.mark.parametrize(
    ("label", "court"),
    [
        ('<div class="txtbold">Sala Suprema:</div><div><div>Sala</div> Penal</div>', "Sala Penal"),
        ("<div class='x txtbold'>Sala Suprema:</div>\n<br/> <div>uno</div><div>dos</div>", "uno"),
        ('<div class="txtbold"><div>Sala</div> Suprema</div><!-- <div>no</div> --><div title="</div>">si</div>', "si"),
        ('<div><div class="txtbold">Sala Suprema:</div></div><div>otro</div>', ""),
        ('<div class="txtbold">Sala Suprema:</div>', ""),
        ('<div class="txtbold">Sala Suprema:</div><div>sin cierre', "sin cierre"),
    ],
)
def test_labels_by_depth(spark, label, court):
    assert apply(spark, [f"<div>{label}</div>" if label.endswith("</div>") else label], hx.label_fields) == [{"court": court}]


def test_a_panel_ends_at_its_own_closing_tag(spark):
    foreign = f'<div class="txtbold">Sala Suprema:</div><div>ajena</div><a href="/x/ServletDescarga?uuid={B}">otra</a>'
    single = (
        "<div id='formBuscador:repeat:7:j_idt40'><div class='txtbold'>Sala Suprema:</div><div>propia</div>"
        f"<a href='/x/ServletDescarga?uuid={A}'>pdf</a></div>"
    )
    no_link = "<div id='formBuscador:repeat:8:j_idt40'><div>vacio</div></div>"
    df = spark.createDataFrame([(1, f"<p>{single}{foreign}{no_link}{foreign}")], "page_id int, html string")
    rows = panels.read_panels(panels.explode_panels(df)).collect()
    assert [(r["panel_no"], r["link_id"], r["court"]) for r in rows] == [(0, A, "propia")]


def test_totals(spark):
    values = [
        "De <b>un</b> total de 674.530 resoluciones,\n se obtuvieron <i>12,345</i> resultados",
        "nada",
        "De un total de 10 resoluciones, se obtuvieron 0 resultados",
    ]
    assert apply(spark, values, lambda c: hx.listing_totals(c)[1]) == [12345, None, 0]
    assert apply(spark, values, lambda c: hx.announced_pages(hx.listing_totals(c)[1])) == [1235, None, 0]


@pytest.mark.parametrize(
    ("raw", "plain"),
    [
        ("&#9999999;", "�"),
        ("&#146;", "’"),
        ("&lpar;a&rpar;", "(a)"),
        ("&eacute x &notit;", "é x ¬it;"),
        ("&#0;&#xD800;&#x110000;&#1;", "���"),
        ("&#00000000065;&#x1F600;", "A😀"),
        ("&amp;lt; & &; &#; &unknown;", "&lt; & &; &#; &unknown;"),
        ("&#99999999999999999999999;", "�"),
    ],
)
def test_unescape_as_html_5(spark, raw, plain):
    assert htmllib.unescape(raw) == plain
    assert spark.createDataFrame([(raw,)], "s string").select(hx.unescape(F.col("s"))).first()[0] == plain


def test_pages_are_cut_once_and_the_element_name_is_read_once(spark):
    page = "<p>" * 50 + f'<div id="formBuscador:repeat:0:j_idt1"><a href="/ServletDescarga?uuid={A}">x</a><div>y</div></div><p>z'
    found = panels.explode_panels(spark.createDataFrame([(1, page), (2, "none"), (3, None)], "page_id int, html string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the pattern of an element's own name: bound outside the walk over its tokens, in one place only
    assert plan.count("^<([A-Za-z][A-Za-z0-9]*)") == 1
    assert [(r.page_id, r.panel_no) for r in found.collect()] == [(1, 0)]
