"""Scalar functions: dialect, null and tie hazards."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from catalogproof.functions import quality as ql
from catalogproof.functions import text as tx
from catalogproof.operators import canonical


def apply(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("o"))
    return [r["o"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_clean_text(spark):
    values = ["a\x00b", " a \xa0  b\n\tc ", "\x07 \n", "", None, "á\x1fé"]
    assert apply(spark, values, tx.clean_text) == ["ab", "a b c", None, None, None, "áé"]


def test_strip_takes_all_whitespace(spark):
    assert apply(spark, ["\n\t x\xa0\x1c", None], tx.strip) == ["x", None]


def _fold(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def test_fold_ascii_is_exact_over_all_code_points(spark):
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    values = ["x".join(points[k : k + 2000]) for k in range(0, len(points), 2000)]
    assert apply(spark, values, tx.fold_ascii) == [_fold(v) for v in values]


def test_fold_ascii_longer_folds(spark):
    values = ["Art. ⑩ ⑴ ㎏ 𝐀𝐁 ½", "ﬁn…", "ß", "日本", "plain", "", None]
    assert apply(spark, values, tx.fold_ascii) == ["Art. 10 (1) kg AB 12", "fin...", "", "", "plain", "", None]


def test_slug(spark):
    values = ["Contencioso Adm. Laboral", "--Ñandú--", "...", None]
    assert apply(spark, values, tx.slug) == ["contencioso-adm-laboral", "nandu", "", None]
    assert apply(spark, values, lambda c: tx.slug(c, "none"))[2:] == ["none", "none"]


def test_category_key_does_not_trim_after_the_dots(spark):
    assert apply(spark, ["Consulta.", "CONSULTA", "consulta .", "Revisión.."], tx.category_key) == [
        "consulta", "consulta", "consulta ", "revision",
    ]


LABEL_CASES = ["Sumilla: texto", ".- Sumilla: texto", "SUMILLA.- Sumilla: x", "sumilla texto", ": En", "Sumilla:", None, "texto"]


def test_labels(spark):
    assert apply(spark, LABEL_CASES, tx.had_label) == [True, False, True, False, False, True, False, False]
    assert apply(spark, LABEL_CASES, tx.strip_label) == [
        "texto", "texto", "x", "sumilla texto", "En", None, None, "texto",
    ]


def test_long_punctuation_runs_do_not_overflow(spark):
    assert apply(spark, ["- " * 20000 + "x"], tx.strip_label) == ["x"]


def test_extract_id_and_case_keys(spark):
    rid = "0A0b0c0d-0000-1111-2222-333344445555"
    assert apply(spark, [f"h?uuid={rid}&x", "h?uuid=1", None], tx.extract_id) == [rid, None, None]
    keys = ["Casación-003439-2023", "A-B-1-2020", "solo-2020", "nada", None]
    assert apply(spark, keys, lambda c: tx.split_case_key(c)[0]) == ["Casación", "A-B", "solo", "nada", None]
    assert apply(spark, keys, lambda c: tx.split_case_key(c)[1]) == ["003439-2023", "1-2020", "2020", "", None]


def test_dates(spark):
    values = ["1/2/2020", "01/02/2020", "31/02/2020", "2020-01-01", " 1/2/2020", "1/2/20201", "1/2/1500", None]
    out = [str(d) if d else None for d in apply(spark, values, ql.ruling_date)]
    assert out == ["2020-02-01", "2020-02-01"] + [None] * 6
    assert apply(spark, ["000001-2019", "x-20190", "2019", None], ql.case_year) == [2019, None, None, None]


def test_paths(spark):
    df = spark.createDataFrame(
        [("Casación", "N 12-2020", "Penal", "abcdefgh-ijkl", 2021), (" ", None, None, None, None), ("¡!", "x", "¿", "ab", 1999)],
        "t string, n string, c string, i string, y int",
    )
    path = ql.pdf_path(*[F.col(c) for c in "tnciy"])
    assert [r[0] for r in df.select(path).collect()] == [
        "penal/2021/casacion-12-2020-abcdefgh.pdf",
        "sin-especialidad/sin-anio/resolucion.pdf",
        "sin-especialidad/1999/sin-especialidad-ab.pdf",
    ]
    assert apply(spark, ["a.pdf", "a.pdf.x"], ql.md_path) == ["a.md", "a.pdf.x"]


def test_id_formats(spark):
    rid = "0a0b0c0d-0000-1111-2222-333344445555"
    assert apply(spark, [rid, rid.upper(), rid + "\n", None], ql.id_well_formed) == [True, False, False, False]


def test_stored_files(spark):
    body = b"%PDF-1.4 /Font /Type/Pages /Type /Page /Type/Page \xff\xfe"
    values = [bytearray(b) for b in (body.ljust(1000), body.ljust(999), b"%PDX-".ljust(2000), b"")]
    assert apply(spark, values, ql.blob_valid, "binary") == [True, False, False, False]
    kinds = [bytearray(b) for b in (body, b"/DCTDecode", b"/Font /JBIG2Decode", b"")]
    assert apply(spark, kinds, ql.blob_kind, "binary") == ["nativo", "escaneado", "mixto", "?"]
    assert apply(spark, kinds, ql.blob_pages, "binary") == [2, 0, 0, 0]


def test_counts_with_marks_and_yaml(spark):
    assert apply(spark, ["674.530", "12,345", "x", None], tx.parse_count) == [674530, 12345, None, None]
    assert apply(spark, ['a "b"\nc ', None], tx.yaml_scalar) == ['"a \'b\' c"', '""']


def test_canonical_tie_goes_to_the_smallest_spelling(spark):
    rows = [(i, v) for i, v in enumerate(["Auto.", "AUTO", "auto", "auto", "AUTO", None, "Ejecutoria", " "])]
    df = spark.createDataFrame(rows, "row_id long, kind string")
    out = canonical.canonicalize(df, ["kind"], "row_id").orderBy("row_id").collect()
    assert [r["kind"] for r in out] == ["AUTO"] * 5 + [None, "Ejecutoria", None]


def test_canonical_without_broadcast(spark, monkeypatch):
    from catalogproof.operators import scaling

    rows = [(i, ["Civil", "CIVIL.", "civil", "Penal"][i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, kind string")
    expected = sorted(canonical.canonicalize(df, ["kind"], "row_id").collect())
    monkeypatch.setattr(scaling, "BROADCAST_ROWS", 0)
    assert sorted(canonical.canonicalize(df, ["kind"], "row_id").collect()) == expected


@pytest.mark.parametrize("text", ["Sumilla:  El  auto", "", "  ", None, "- x", "Sumilla: .- y"])
def test_label_removal_is_idempotent(spark, text):
    once = apply(spark, [text], lambda c: tx.strip_label(tx.clean_text(c)))
    assert apply(spark, once, tx.strip_label) == once
    assert once[0] is None or not re.match(r"\s|[.:–—-]", once[0])


def test_cleaned_spacing_equals_the_plain_rules(spark):
    import random

    draw = random.Random(3)
    kinds = [chr(i) for i in range(0x30)] + ["\x7f", "\x85", "\xa0", " ", " ", " ", "　", "é", "z", "~"] + [" "] * 20
    rows = [("".join(draw.choices(kinds, k=draw.randint(0, 40))),) for _ in range(2000)]
    df = spark.createDataFrame(rows, "t string")
    plain = F.regexp_replace(F.regexp_replace("t", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), r"(?U)\s+", " ")
    assert df.filter(~tx.clean_text(F.col("t")).eqNullSafe(tx.blank_to_null(F.trim(plain)))).isEmpty()
