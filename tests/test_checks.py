"""The gate counts every kind of damage, and blocks publishing."""

import pytest
from pyspark.sql import functions as F

from catalogproof.operators import checks, dedupe, lots, sampling
from catalogproof.plans import cleaning
from catalogproof.queries.base import catalogue
from catalogproof.schemas import CLEAN_COLUMNS, RECORD_COLUMNS

RID = "0a0b0c0d-0000-1111-2222-33334444555"


@pytest.fixture(scope="module")
def before(spark):
    rows = [
        (
            "Casación." if i % 3 else "CASACION", f"00{i}-2019", " materia  x", "Auto", "1/2/2020", "Sala", None,
            f"Sumilla: un texto bastante largo {i}", "clave", f"https://h/f?uuid={RID}{i}", "Civil", 1 + i // 3, i,
        )
        for i in range(9)
    ]
    kinds = ", ".join(f"{c} {'int' if c == 'page' else 'string'}" for c in RECORD_COLUMNS) + ", row_id long"
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="module")
def after(before):
    return cleaning.clean_records(before).persist()


def counts(before, after):
    return {r["check"]: r["violations"] for r in checks.conservation_check(before, after).collect() if r["violations"]}


def test_clean_table(before, after):
    assert after.columns == [*RECORD_COLUMNS, *CLEAN_COLUMNS, "row_id"]
    rows = after.orderBy("row_id").collect()
    assert {r["case_type"] for r in rows} == {"Casación."}
    assert rows[0]["summary"] == "un texto bastante largo 0" and rows[0]["summary_had_prefix"]
    assert rows[0]["pdf_path"] == "civil/2020/casacion-000-2019-0a0b0c0d.pdf"
    assert counts(before, after) == {}


DAMAGE = {
    "row_ids": lambda d: d.filter("row_id <> 4"),
    "id_sequence": lambda d: d.withColumn("record_id", F.lit("x")),
    "value_lost": lambda d: d.withColumn("court", F.when(F.col("row_id") > 2, F.col("court"))),
    "label_left": lambda d: d.withColumn("summary", F.concat(F.lit(": "), "summary")),
    "spacing_left": lambda d: d.withColumn("keywords", F.lit("a  b")),
    "id_null": lambda d: d.withColumn("record_id", F.lit(None).cast("string")),
    "id_malformed": lambda d: d.withColumn("record_id", F.upper("record_id")),
    "id_not_of_link": lambda d: d.withColumn("link", F.lit("https://h/f")),
    "path_collides": lambda d: d.withColumn("pdf_path", F.lit("a/2020/b.pdf")),
    "path_malformed": lambda d: d.withColumn("pdf_path", F.concat("pdf_path", F.lit("/"), "row_id")),
    "changed_page": lambda d: d.withColumn("page", F.col("page") + 1),
    "column_order": lambda d: d.select(*reversed(d.columns)),
}


@pytest.mark.parametrize("check", DAMAGE)
def test_damage_is_counted(before, after, check):
    assert counts(before, DAMAGE[check](after)).get(check, 0) > 0


def test_publish_writes_only_what_passes(before, after):
    written = []
    cleaning.publish(before, after, written.append)
    assert len(written) == 1 and written[0].count() == 9
    result = cleaning.publish(before, DAMAGE["value_lost"](after), written.append)
    assert len(written) == 1 and result.filter("violations > 0").count() == 1


def test_duplicate_groups_follow_content_order(spark):
    rows = [(1, "b", None), (2, "a", "x"), (3, "b", None), (4, "a", "x"), (5, "a", None), (6, "a", "x")]
    df = spark.createDataFrame(rows, "row_id long, p string, q string")
    marked = dedupe.mark_content_duplicates(df, "row_id", ["p", "q"]).orderBy("row_id")
    assert [tuple(r)[3:] for r in marked.collect()] == [
        (1, True, False), (0, True, False), (1, True, True), (0, True, True), (None, False, False), (0, True, True),
    ]


def test_quotas_round_half_to_even_and_stay_whole(spark):
    sizes = {"a": 25, "b": 35, "c": 1, "d": 139}
    rows = [(s, f"{s}{i}") for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "s string, k string")
    quotas = sampling.proportional_quotas(df, "s", 20)
    assert {r["s"]: r["quota"] for r in quotas.collect()} == {"a": 2, "b": 4, "c": 1, "d": 14}
    sample = sampling.stratified_sample(df, quotas, "s", "k", 20, 1)
    assert sorted(r["s"] for r in sample.collect()) == list("aabbbbc") + ["d"] * 14
    assert sample.distinct().count() == 21


def test_size_stats_positions(spark):
    values = [5.0] * 7 + [1.0, 2.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = sampling.size_stats(df, "v").first()
    assert (r["n"], r["median"], r["p10"], r["p90"], r["max"]) == (10, 5.0, 2.0, 9.0, 9.0)
    assert r["mean"] == pytest.approx(4.7) and r["stdev"] == pytest.approx(2.110819, abs=1e-5)
    one = sampling.size_stats(df.limit(1), "v").first()
    assert (one["n"], one["median"], one["stdev"]) == (1, one["max"], None) and one["total_low"] == one["total_high"]


def test_published_sample_profile(spark):
    df = spark.createDataFrame([("x", 2048, 0), ("x", 1024, 0), ("y", 1024, 4)], "kind string, bytes long, pages int")
    got = {r["kind"]: r for r in sampling.group_profile(df, "kind", "bytes", "pages").collect()}
    assert got["x"]["kb_per_page"] == 3.0 and got["y"]["kb_per_page"] == 0.25 and got["x"]["share"] == pytest.approx(2 / 3)


def test_lot_ladder(spark):
    counted = [(2000, 100, 99, 99, 0), (2001, 100, 99, 10, 0), (2002, 100, 98, 98, 0), (2003, 100, 0, 0, 0), (2004, 5, 0, 0, 0)]
    lot = spark.createDataFrame(counted, "year int, n_docs long, n_pdf long, n_md long, bytes_pdf long")
    state = spark.sql("select 2004 as year, timestamp'2026-01-01 00:00:00' as uploaded_at")
    status = {r["year"]: (r["status"], r["backlog"]) for r in lots.lot_status(lot, state).collect()}
    assert status == {
        2000: ("ready", 0), 2001: ("ocr missing", 0), 2002: ("half done", 0), 2003: ("pending", 100), 2004: ("uploaded", 0),
    }
    assert lots.half_done_year(lot).first()[0] == 2002


def test_state_upsert_latest_wins(spark):
    kinds = "year int, documents long, processed_at timestamp"
    old = spark.sql("select 2000 as year, 1L as documents, timestamp'2026-01-01 00:00:00' as processed_at")
    new = spark.sql("select 2000 as year, 2L as documents, timestamp'2026-01-01 00:00:00' as processed_at")
    assert lots.upsert_state(old, new).first()["documents"] == 2
    assert lots.upsert_state(spark.createDataFrame([], kinds), new).count() == 1


def test_catalogue_has_ten_rows_a_page(spark):
    sizes = catalogue(spark, "/root/testdata/sf0.001").groupBy("category", "page").count()
    assert sizes.agg(F.max("count")).first()[0] == 10


@pytest.mark.parametrize("few", [200_000, 0])
def test_duplicates_do_not_depend_on_what_is_broadcast(spark, monkeypatch, few):
    from catalogproof.operators import scaling

    monkeypatch.setattr(scaling, "BROADCAST_ROWS", few)
    texts = ["hot"] * 60 + [f"t{i % 17}" for i in range(40)] + [f"u{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, t string")
    rows = dedupe.mark_content_duplicates(df, "row_id", ["t"]).collect()
    groups = sorted({t for t in texts if texts.count(t) > 1})
    for r in rows:
        dup = texts.count(r["t"]) > 1
        assert r["dup_group"] == (groups.index(r["t"]) if dup else None)
        assert r["is_droppable_copy"] == (dup and texts.index(r["t"]) != r["row_id"])
    assert len(rows) == len(texts)
