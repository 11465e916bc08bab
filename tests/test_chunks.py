"""Chunk files, journals, incremental ingest, external tables and the manifest."""

import json

import pytest
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.operators import dedupe, pages
from catalogproof.plans import audit
from catalogproof.sources import chunks, tables
from catalogproof.streaming import ingest


def row(i, page, category="Civil", **more):
    return {"uuid": f"u{i}", "Pagina": page, "Link Resolucion": f"l{i}", "Especialidad": category, "Origen": "json", **more}


@pytest.fixture
def folder(tmp_path):
    base = tmp_path / "civil" / "tramos"
    base.mkdir(parents=True)
    (base / "p00001-00025.json").write_text(
        json.dumps({"completo": True, "fallidas": [], "incompletas": [2], "filas": [row(1, 1), row(2, 2), row(1, 3)]})
    )
    (base / "p00026-00050.json").write_text(
        json.dumps({"completo": False, "fallidas": [27], "filas": [row(2, 26, Sumilla="otra"), row(3, 28)]})
    )
    (base / "p00051-00075.json").write_text('{"completo": true, "filas": [{"uuid": "u9"')
    (base / "p00076-00100.json").write_text(json.dumps({"completo": True, "fallidas": [], "incompletas": [], "filas": []}))
    return str(tmp_path)


def test_read_chunks(spark, folder):
    rows, flags = chunks.read_chunks(spark, folder)
    merged = dedupe.merge_chunks(rows, chunks.CHUNK_ORDER)
    assert sorted((r["record_id"], r["page"], r["summary"]) for r in merged.collect()) == [
        ("u1", 1, None), ("u2", 2, None), ("u3", 28, None),
    ]
    slug, first, last = chunks.chunk_range(F.col("chunk_file"))
    found = flags.select(slug.alias("s"), first.alias("a"), last.alias("b"), "complete", "unreadable", "short").orderBy("a")
    assert [tuple(r) for r in found.collect()] == [
        ("civil", 1, 25, True, False, [2]),
        ("civil", 26, 50, False, False, None),
        ("civil", 51, 75, False, True, None),
        ("civil", 76, 100, True, False, []),
    ]


def test_audit_reports_a_category_that_cannot_be_read(spark, folder):
    rows, flags = chunks.read_chunks(spark, folder)
    named = flags.select(F.lit("Civil").alias("category"), "complete").unionByName(
        spark.createDataFrame([("Penal", False)], "category string, complete boolean")
    )
    report = {r["category"]: r for r in audit.audit_report(rows, named).collect()}
    assert report["Penal"]["verdict"] == "REVIEW" and report["Penal"]["n_pages"] == 0
    civil = report["Civil"]
    assert (civil["n_unique"], civil["n_pages"], civil["last_page"], civil["n_missing"]) == (3, 5, 28, 23)
    assert civil["n_incomplete_chunks"] == 2 and civil["n_short"] == 4
    assert report[None]["is_total"] == 1 and report[None]["n_unique"] == 3


def test_write_and_read_back_with_an_overfull_page(spark, tmp_path):
    data = [(i, f"u{i}", "Civil", 1 if i < 3000 else i % 60) for i in range(4000)]
    rows = spark.createDataFrame(data, "row_id long, record_id string, category string, page int")
    path = str(tmp_path / "out")
    chunks.write_chunks(rows, path)
    back, flags = chunks.read_chunks(spark, path)
    assert back.count() == sum(1 for d in data if d[3] >= 1)
    assert chunks.read_objects(spark, path).agg(F.max(F.size("filas"))).first()[0] <= 1024
    assert flags.filter("unreadable or not complete").count() == 0


def test_chunk_status_and_redo(spark):
    seen = [("c", p) for p in range(1, 61) if p not in (3, 30, 31)] + [("d", 0), ("d", 2)]
    profile = pages.page_profile(spark.createDataFrame(seen, "category string, page int"))
    status = sorted(tuple(r) for r in pages.chunk_status(profile).collect())
    assert status == [
        ("c", 1, 25, False, [3]), ("c", 26, 50, False, [30, 31]), ("c", 51, 60, True, []), ("d", 1, 2, False, [1]),
    ]
    redo = sorted(tuple(r) for r in pages.chunks_to_redo(profile).collect())
    assert redo == [("c", 1, 25), ("c", 26, 50), ("d", 1, 2)]
    totals = spark.createDataFrame([("c", 60), ("e", None), ("f", 25), ("g", 0)], "category string, total_pages long")
    pending = sorted(tuple(r) for r in pages.pending_chunks(totals, pages.chunk_status(profile)).collect())
    assert pending == [("c", 1, 25), ("c", 26, 50), ("f", 1, 25)]
    assert [r[0] for r in pages.unmeasured(totals).collect()] == ["e"]


def test_ingest_runs_again_without_effect(spark, folder, tmp_path):
    source, table, progress = f"{folder}/civil", str(tmp_path / "table"), str(tmp_path / "progress")
    ingest.ingest_chunks(spark, source, table, progress, max_files=1)
    first = sorted(r["record_id"] for r in spark.read.parquet(table).collect())
    assert first == ["u1", "u2", "u3"]
    ingest.ingest_chunks(spark, source, table, progress)
    assert sorted(r["record_id"] for r in spark.read.parquet(table).collect()) == first
    late = tmp_path / "civil" / "tramos" / "p00101-00125.json"
    late.write_text(json.dumps({"completo": True, "fallidas": [], "filas": [row(3, 101), row(4, 101)]}))
    ingest.ingest_chunks(spark, source, table, progress)
    assert sorted(r["record_id"] for r in spark.read.parquet(table).collect()) == ["u1", "u2", "u3", "u4"]


def test_first_occurrence_across_objects_files_and_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunks, "PART_ROWS", 2)
    data = [(i, f"u{i % 5}", "Civil", 1 + i // 4, f"subject {i}") for i in range(12)]
    rows = spark.createDataFrame(data, "row_id long, record_id string, category string, page int, subject string")
    path = str(tmp_path / "out")
    chunks.write_chunks(rows, path)
    back, flags = chunks.read_chunks(spark, path)
    merged = dedupe.merge_chunks(back, chunks.CHUNK_ORDER)
    assert sorted((r["record_id"], r["page"], r["subject"]) for r in merged.collect()) == [
        (f"u{i}", 1 + i // 4, f"subject {i}") for i in range(5)
    ]
    assert {(r["category"], r["chunk_start"]) for r in flags.collect()} == {("Civil", 1)} and flags.count() == 6
    assert audit.audit_report(back, flags.withColumn("complete", F.lit(False))).filter("is_total = 0").first()["n_incomplete_chunks"] == 1


def test_flags_name_the_category_of_a_truncated_file(spark, folder):
    rows, flags = chunks.read_chunks(spark, folder)
    assert flags.filter("unreadable").select("category", "chunk_start").first() == ("Civil", 51)
    report = {r["category"]: r for r in audit.audit_report(rows, flags).collect()}
    assert report["Civil"]["n_incomplete_chunks"] == 2 and report["Civil"]["verdict"] == "REVIEW"


def test_null_category_is_counted(spark):
    rows = spark.createDataFrame([(None, 1, "a", "l"), (None, 1, "b", "l"), ("c", 1, "c", "l")], "category string, page int, record_id string, link string")
    chunk = spark.createDataFrame([(None, True), ("c", True)], "category string, complete boolean")
    report = {(r["category"], r["is_total"]): r["n_unique"] for r in audit.audit_report(rows, chunk).collect()}
    assert report == {(None, 0): 2, ("c", 0): 1, (None, 1): 3}
    review = audit.import_review(rows.withColumn("i", F.monotonically_increasing_id()), ["c"], "i")
    assert {(r["category"], r["n_unique"], r["known"]) for r in review.collect()} == {(None, 2, False), ("c", 1, True)}


def test_ingest_keeps_flags_and_takes_a_repaired_file(spark, folder, tmp_path):
    table, progress, folder = str(tmp_path / "table"), str(tmp_path / "progress"), f"{folder}/civil"
    assert ingest.ingest_chunks(spark, folder, table, progress, max_files=1) == 4
    assert [r[0].rsplit("/", 1)[1] for r in ingest.unreadable_files(spark, table).collect()] == ["p00051-00075.json"]
    broken = tmp_path / "civil" / "tramos" / "p00051-00075.json"
    broken.write_text(json.dumps({"completo": True, "fallidas": [], "filas": [row(9, 51)]}))
    ingest.ingest_chunks(spark, folder, table, progress)
    assert sorted(r["record_id"] for r in spark.read.parquet(table).collect()) == ["u1", "u2", "u3", "u9"]
    assert ingest.unreadable_files(spark, table).count() == 0


def test_ingest_tries_all_unreadable_files_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "RETRIED", 2)
    table, progress, base = str(tmp_path / "table"), str(tmp_path / "progress"), tmp_path / "in" / "civil" / "tramos"
    base.mkdir(parents=True)
    files = [base / f"p{25 * i + 1:05}-{25 * i + 25:05}.json" for i in range(7)]
    for file in files:
        file.write_text('{"completo": true, "filas": [{"uuid"')
    ingest.ingest_chunks(spark, str(tmp_path / "in"), table, progress)
    assert ingest.unreadable_files(spark, table).count() == 7
    for i in (0, 2, 3, 5, 6):
        files[i].write_text(json.dumps({"completo": True, "fallidas": [], "filas": [row(i, 25 * i + 1), row("same", 25 * i + 2)]}))
    ingest.ingest_chunks(spark, str(tmp_path / "in"), table, progress)
    assert sorted(r["record_id"] for r in spark.read.parquet(table).collect()) == ["u0", "u2", "u3", "u5", "u6", "usame"]
    left = ingest.unreadable_files(spark, table).collect()
    assert sorted(r[0].rsplit("/", 1)[1] for r in left) == [files[1].name, files[4].name]


def test_ingest_of_a_second_source_and_of_a_lost_checkpoint(spark, tmp_path):
    table = str(tmp_path / "table")
    for name, rows in (("one", [row("x", 1), {"Pagina": 1, "Especialidad": "Civil"}]), ("two", [row("w", 1), row("x", 2), {"Pagina": 2}])):
        base = tmp_path / name / "civil" / "tramos"
        base.mkdir(parents=True)
        (base / "p00001-00025.json").write_text(json.dumps({"completo": True, "fallidas": [], "filas": rows}))
        ingest.ingest_chunks(spark, str(tmp_path / name), table, str(tmp_path / f"progress-{name}"))
    for again in ("three", "four"):  # new checkpoints find nothing new, null ids included
        ingest.ingest_chunks(spark, str(tmp_path / "one"), table, str(tmp_path / f"progress-{again}"))
    found = sorted((str(r["category"]), str(r["record_id"]), r["page"]) for r in spark.read.parquet(table).collect())
    assert found == [("Civil", "None", 1), ("Civil", "uw", 1), ("Civil", "ux", 1), ("None", "None", 2)]


def test_assignees_written_in_two_runs_are_both_there(spark, tmp_path):
    path = str(tmp_path / "out")
    for who in ("a", "b"):
        tables.write_by_assignee(spark.createDataFrame([(1, who)], "v int, output string"), path)
    assert sorted(r["output"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_category_codes_and_slugs(spark):
    df = spark.createDataFrame([("Civil", "civil"), ("Contencioso Adm. Laboral", "contencioso-adm-laboral"), ("x", "x")], "c string, s string")
    found = df.select(chunks.category_code(F.col("c")), chunks.category_for(F.col("s"))).collect()
    assert [tuple(r) for r in found] == [(1, "Civil"), (7, "Contencioso Adm. Laboral"), (None, "x")]


def test_journal(spark, tmp_path):
    path = str(tmp_path / "journal")
    asked = spark.createDataFrame([("c", p) for p in range(6)], "category string, page long")
    rows = spark.createDataFrame([("u1", "c", 0)], "record_id string, category string, page long")
    for part in ("page < 2", "page = 4"):
        tables.append_journal(rows, asked.filter(part), path)
    found, done = tables.read_journal(spark, path, rows.schema)
    assert found.count() == 2
    assert sorted(r["page"] for r in tables.resume_pending(asked, done).collect()) == [2, 3, 5]


def test_a_journal_run_that_dies_before_its_commit_is_not_read(spark, tmp_path):
    path = str(tmp_path / "journal")
    asked = spark.createDataFrame([("c", p) for p in range(4)], "category string, page long")
    rows = spark.createDataFrame([(f"u{p}", "c", p) for p in range(4)], "record_id string, category string, page long")
    empty, none = tables.read_journal(spark, path, rows.schema)
    assert empty.count() == none.count() == 0 and empty.columns == rows.columns
    tables.append_journal(rows.filter("page = 0"), asked.filter("page = 0"), path)
    broken = asked.withColumn("page", F.when(F.col("page") == 2, F.raise_error(F.lit("died")).cast("long")).otherwise(F.col("page")))
    with pytest.raises(Exception, match="died"):
        tables.append_journal(rows.filter("page > 0"), broken, path)  # rows are written, marks are not
    _, done = tables.read_journal(spark, path, rows.schema)
    again = tables.resume_pending(asked, done)
    assert sorted(r["page"] for r in again.collect()) == [1, 2, 3]
    tables.append_journal(rows.join(again, ["category", "page"], "left_semi").select(*rows.columns), again, path)
    found, done = tables.read_journal(spark, path, rows.schema)
    assert sorted(r["record_id"] for r in found.collect()) == ["u0", "u1", "u2", "u3"]
    assert tables.resume_pending(asked, done).count() == 0


@pytest.mark.parametrize("buckets", [64, 4096])
def test_known_ids_of_a_batch_are_found_without_a_shuffle(spark, tmp_path, buckets):
    """The table is read where the batch's ids may be, and nowhere else, and its side is not exchanged."""
    ids = ["category", "record_id"]
    path = str(tmp_path / "known")
    stored = spark.range(3000).select(F.lit("c").alias("category"), F.concat(F.lit("u"), "id").alias("record_id"))
    bucket = F.pmod(F.xxhash64(*ids), F.lit(buckets)).cast("int")
    stored.withColumn("bucket", bucket).coalesce(1).write.partitionBy("bucket").parquet(path)
    batch = spark.createDataFrame([("c", "u7"), ("c", "new"), (None, None)], "category string, record_id string").withColumn("bucket", bucket)
    touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]
    known = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
    assert known.select(F.input_file_name()).distinct().count() <= len(touched)
    seen = ingest.known_of(known.select(*ids), batch, ids)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    assert [r["record_id"] for r in seen.collect()] == ["u7"]


def test_external_table(spark):
    headers = list(fx.RECORD_HEADERS)
    rid = "0a0b0c0d-0000-1111-2222-333344445555"

    def cells(**given):
        return tuple(given.get(fx.RECORD_HEADERS[h]) for h in headers)

    good = f" https://h/ServletDescarga?uuid={rid} "
    rows = [
        cells(link=good, page="7", category="Civil"), cells(link=good, page="x"), cells(link=good, page=" 8 "),
        cells(), cells(link=" ", page="1"), cells(link="https://h/otro", page="1"),
    ]
    table = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))
    imported, triage = tables.import_external(table)
    got = sorted((r["page"], r["record_id"], r["link"], r["summary"], r["provenance"]) for r in imported.collect())
    assert got == [(p, rid, good.strip(), "", "excel") for p in (0, 7, 8)]
    assert {r["link_class"]: r["n"] for r in triage.collect()} == {"with_id": 3, "no_link": 1, "odd_link": 1}
    with pytest.raises(ValueError, match="Sumilla"):
        tables.import_external(table.drop("Sumilla"))


def test_manifest_file_quotes(spark, tmp_path):
    path = str(tmp_path / "m")
    row_ = ("id", 'a "quoted", url', "p.pdf", "p.md", None, None, 2020, "Civil", True)
    kinds = "record_id string, url string, path string, path_md string, case_no string, ruling_date date, year int, category string, id_repeated boolean"
    manifest = spark.createDataFrame([row_], kinds)
    tables.write_manifest(manifest, path)
    assert tables.read_manifest(spark, path).collect() == manifest.collect()


def test_inventory_never_reads_bodies(spark, tmp_path):
    for name in ("civil/2020/a.pdf", "civil/2020/b.pdf", "penal/2019/c.pdf", "penal/2019/d.md"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"x" * 10)
    inventory = tables.file_inventory(spark, str(tmp_path))
    assert "content" not in inventory._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    totals = sorted(tuple(r) for r in tables.folder_totals(inventory).collect())
    assert totals == [("civil", "2020", 2, 20), ("penal", "2019", 1, 10)]


def test_throughput_on_a_stream_and_stalls(spark, tmp_path):
    events = spark.sql("select timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts from range(200)")
    path = str(tmp_path / "events")
    events.write.parquet(path)
    stream = ingest.throughput(spark.readStream.schema(events.schema).parquet(path), "ts", 90, late="10 minutes")
    query = stream.writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["n"] for r in spark.table("rates").collect()) == [20, 90, 90]
    left = spark.createDataFrame([(10, 0.0), (10, 5.0), (0, 0.0)], "n long, rate double")
    out = left.select(ingest.hours_left(F.col("n"), F.col("rate")), ingest.progress_state(F.col("n"), F.col("rate")))
    assert [tuple(r) for r in out.collect()] == [(None, "stalled"), (2.0, "running"), (None, "done")]


def test_reject_files(spark, tmp_path):
    (tmp_path / "r-2019.csv").write_text("uuid,ruta,motivo,url\nu1,p1,escaneado,l1\nu2,p2,sin texto,l2\n")
    (tmp_path / "r-2020.csv").write_text("uuid,ruta,motivo,url\nu1,p1,escaneado,l1\n")
    (tmp_path / "broken.csv").write_text("uuid,ruta,motivo,url\nx\n")
    found, broken = tables.read_rejects(spark, str(tmp_path))
    assert sorted(r["record_id"] for r in found.collect()) == ["u1", "u1", "u2"]
    counts = {r["file"].rsplit("/", 1)[1]: (r["n_read"], r["n_broken"]) for r in broken.collect()}
    assert counts == {"r-2019.csv": (2, 0), "r-2020.csv": (1, 0), "broken.csv": (0, 1)}
