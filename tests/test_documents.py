"""Document text: blocks, sections and markdown on small texts."""

import random

from pyspark.sql import functions as F

from catalogproof.functions import documents as dx
from catalogproof.plans import markdown as md


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in sorted(df.select("i", fn(F.col("v")).alias("o")).collect(), key=lambda r: r["i"])]


def test_lines(spark):
    values = ["a\nb\n", "a\r\nb\x0cc", "a\x1cb\u2028c", "a\n\n"]
    assert apply(spark, values, dx.lines) == [["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["a", ""]]


def test_boilerplate(spark):
    text = "PODER JUDICIAL DEL PERÚ\n uno \n- 3 -\n\nSinoe\nsello\n \t\ndos\x0ctres\n\n\n\n7\n\n"
    assert apply(spark, [text, "", "12"], dx.strip_boilerplate) == ["uno\n\ndos\ntres", "", ""]


def test_stamp_needs_no_exact_case(spark):
    values = ["secretario :", "D.judicial :", "Razón: resolución", "VOCAL SUPREMO:", "secretaria de sala"]
    assert apply(spark, values, dx.strip_boilerplate) == ["", "", "", "", "secretaria de sala"]


def test_pages(spark):
    assert apply(spark, ["a", "a\fb", "a\fb\f"], dx.page_count) == [1, 2, 3]
    assert apply(spark, ["a\fb\f"], lambda c: dx.page_count(c, True)) == [2]


def test_reasons(spark):
    values = ["  \n", "x" * 199, "x" * 200, None]
    assert apply(spark, values, lambda c: dx.reject_reason(c, dx.strip_boilerplate(c))) == [
        "sin texto", "escaneado", None, "sin texto",
    ]


TEXT = "inicio\nVISTOS: los autos\nuno\n  DECLARARON infundado\nI. ANÁLISIS\nRESUELVE otra vez\nDecisión.\ncierre\nS.S."


def test_sections(spark):
    [names] = apply(spark, [TEXT], lambda c: dx.section_names(dx.section_marks(c)))
    assert names == ["Vistos", "Decisión", "Análisis", "Decisión", "Firmas"]
    [body] = apply(spark, [TEXT], lambda c: dx.sectioned_body(dx.section_marks(c)))
    assert body == (
        "inicio\n\n## Vistos\n\nuno\n\n## Decisión\n\nDECLARARON infundado\n\n## Análisis\n\n"
        "RESUELVE otra vez\n\n## Decisión\n\ncierre\n\n## Firmas\n"
    )
    [kept] = apply(spark, ["VISTOS: los autos"], lambda c: dx.sectioned_body(dx.section_marks(c), True))
    assert kept == "\n## Vistos\n\nVISTOS: los autos"


def test_section_rows(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "nada"), (3, "ASUNTO")], "d int, t string")
    rows = sorted((r["d"], r["section_no"], r["section"], r["body"]) for r in md.section_rows(df, "t", "d").collect())
    assert rows == [
        (1, 0, None, "inicio"),
        (1, 1, "Vistos", "uno"),
        (1, 2, "Decisión", "DECLARARON infundado"),
        (1, 3, "Análisis", "RESUELVE otra vez"),
        (1, 4, "Decisión", "cierre"),
        (1, 5, "Firmas", ""),
        (2, 0, None, "nada"),
        (3, 1, "Asunto", ""),
    ]


def test_openers_follow_the_line_by_line_rule(spark):
    rng = random.Random(5)
    kinds = ["texto", "RESUELVE x", "FALLO y", "DECISIÓN", "VISTOS", "POR ESTOS FUNDAMENTOS z"]
    texts = ["\n".join(rng.choice(kinds) for _ in range(rng.randrange(1, 12))) for _ in range(200)]

    def walk(text):
        found = []
        for line in text.split("\n"):
            if line in ("DECISIÓN", "VISTOS"):
                found.append("Decisión" if line == "DECISIÓN" else "Vistos")
            elif line != "texto" and "Decisión" not in found:
                found.append("Decisión")
        return found

    assert apply(spark, texts, lambda c: dx.section_names(dx.section_marks(c))) == [walk(t) for t in texts]


def test_markdown(spark):
    row = dict(
        record_id="id", case_no="1-2020", case_type=None, category="Civil", court="Sala", ruling_date_raw="1/1/2020",
        year=2020, subject="m", rule=None, keywords=None, link="l", summary=" s ", pdf_path="p.pdf", md_path="p.md",
        text="VISTOS\n" + "palabra " * 30,
    )
    kinds = ", ".join(f"{k} {'int' if k == 'year' else 'string'}" for k in row)
    df = spark.createDataFrame([tuple(row.values())], kinds)
    [out] = md.convert(md.triage(df)).collect()
    lines = out["markdown"].split("\n")
    assert lines[:4] == ["---", 'uuid: "id"', 'expediente: "1-2020"', 'recurso: ""']
    assert lines[12:20] == ['paginas: "1"', 'caracteres: "246"', 'secciones: "Vistos"', "---", "", "#  1-2020", "", "> **Sumilla.** s"]
    assert lines[20:] == ["", "## Vistos", "", ("palabra " * 30).strip(), ""]
    assert out["reason"] is None and md.rejects(md.triage(df)).count() == 0
