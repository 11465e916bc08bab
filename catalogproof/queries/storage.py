"""Manifest and inventories, lots and assignment, samples, and what is written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import schemas
from catalogproof.functions import quality as ql
from catalogproof.operators import lots, pages, reconcile as rc, sampling, scaling
from catalogproof.plans import cleaning
from catalogproof.queries.base import (
    SQL_CATALOGUE,
    SQL_CLEANED,
    SQL_HARVESTED,
    catalogue,
    harvested,
    labels,
    literal_dim,
    query,
    records,
    whole_repeated,
    SQL_WHOLE_REPEATED,
    table,
)
from catalogproof.sources import chunks, tables
from catalogproof.streaming import ingest

# --- manifest ------------------------------------------------------------------------

_MANIFEST = """SELECT record_id, link AS url, pdf_path AS path, md_path AS path_md, case_no, ruling_date, year, category, id_repeated
               FROM cleaned"""


@query("manifest", f"WITH {SQL_CLEANED} {_MANIFEST}")
def manifest(spark, sf):
    """Written as CSV under its file headers and read back."""
    path = scaling.shared_dir(spark, "manifest")
    tables.write_manifest(cleaning.manifest(cleaning.clean_records(scaling.materialize(records(spark, sf), "records"))), path)
    return tables.read_manifest(spark, path)


def _light_manifest(spark, sf):
    cat = catalogue(spark, sf)
    path = ql.pdf_path(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("category"), F.col("record_id"), F.col("year"))
    return cat.withColumn("path", path).select(
        "record_id",
        F.col("link").alias("url"),
        "path",
        ql.md_path(F.col("path")).alias("path_md"),
        F.lit(None).cast("string").alias("case_no"),
        F.lit(None).cast("date").alias("ruling_date"),
        "year",
        "category",
        F.lit(False).alias("id_repeated"),
        "row_id",
    )


@query("manifest_scan", f"WITH {SQL_CATALOGUE} SELECT year, category, count(*) AS n_docs FROM catalogue GROUP BY ALL")
def manifest_scan(spark, sf):
    """Two columns of a stored manifest; the scan parses no others."""
    path = scaling.shared_dir(spark, "manifest")
    tables.write_manifest(_light_manifest(spark, sf).drop("row_id"), path)
    stored = tables.read_manifest(spark, path).select("year", "category")
    return stored.groupBy("year", "category").agg(F.count(F.lit(1)).alias("n_docs"))


# --- reconcile -------------------------------------------------------------------------


@query(
    "pending_downloads",
    f"""WITH {SQL_CATALOGUE}
        SELECT row_id, record_id, category, year FROM catalogue
        WHERE row_id NOT IN (SELECT l.doc_id FROM labels l JOIN documents d USING (doc_id) WHERE d.n_chars >= 1000)""",
)
def pending_downloads(spark, sf):
    work = catalogue(spark, sf).select("row_id", "record_id", "category", "year")
    sizes = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "n_chars")
    valid = sizes.filter(F.col("n_chars") >= 1000).join(labels(spark, sf), "row_id", "left_semi")
    return rc.pending(work, valid, "row_id")


@query(
    "retry_set",
    f"""WITH {SQL_CATALOGUE}
        SELECT row_id, record_id, category, year FROM catalogue
        WHERE row_id IN (SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def retry_set(spark, sf):
    """The rejects of two runs are stored as files, headed as every reject file is, and read back."""
    work = catalogue(spark, sf).select("row_id", "record_id", "category", "year")
    paths = []
    for run, reason in (("first", "quality = 0"), ("second", "toxic = 1")):
        rejected = work.join(labels(spark, sf).filter(reason), "row_id", "left_semi")
        lines = rejected.select(
            F.col("record_id").alias("uuid"), F.concat_ws("/", "category", "year").alias("ruta"), F.lit(reason).alias("motivo"), F.lit("").alias("url")
        )
        paths.append(scaling.shared_dir(spark, run))
        lines.write.option("header", True).csv(paths[-1])
    rejects, _ = tables.read_rejects(spark, paths)
    return rc.retry_set(work, [rejects], "record_id")


@query(
    "downloaded",
    f"WITH {SQL_CATALOGUE} SELECT row_id, record_id, category FROM catalogue WHERE row_id IN (SELECT doc_id FROM labels)",
)
def downloaded(spark, sf):
    return rc.downloaded(catalogue(spark, sf).select("row_id", "record_id", "category"), labels(spark, sf), "row_id")


@query(
    "stale_outputs",
    """WITH made AS (SELECT l_orderkey, max(l_shipdate) AS md_time FROM lineitem GROUP BY 1)
       SELECT o_orderkey, o_orderdate AS pdf_time, md_time FROM orders LEFT JOIN made ON l_orderkey = o_orderkey
       WHERE md_time IS NULL OR md_time < o_orderdate""",
)
def stale_outputs(spark, sf):
    inputs = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("pdf_time"))
    outputs = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("md_time")
    )
    return rc.stale_outputs(inputs, outputs, "o_orderkey", "pdf_time", "md_time")


@query(
    "reconcile",
    f"""WITH {SQL_CATALOGUE},
        per AS (SELECT c.year, c.category, count(*) AS n_docs, count(p.doc_id) AS n_pdf, count(m.doc_id) AS n_md
                FROM catalogue c LEFT JOIN labels p ON p.doc_id = c.row_id
                LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) m ON m.doc_id = c.row_id GROUP BY ALL)
        SELECT year, category, n_docs, n_pdf, n_md, n_docs - n_pdf AS missing_pdf, n_docs - n_md AS missing_md,
               CASE WHEN n_pdf = n_docs AND n_md = n_docs THEN 'COMPLETE' ELSE 'MISSING' END AS status
        FROM per WHERE year IN (SELECT year FROM per GROUP BY year HAVING sum(n_pdf + n_md) > 0)""",
)
def reconcile(spark, sf):
    marks = labels(spark, sf)
    return rc.reconcile(catalogue(spark, sf), marks, marks.filter("quality = 1"), "row_id", "row_id")


@query(
    "releasable_files",
    f"""WITH {SQL_CATALOGUE}
        SELECT category, count(*) FILTER (quality = 1) AS n_releasable,
               CAST(coalesce(sum(n_chars) FILTER (quality = 1), 0) AS BIGINT) AS bytes_releasable,
               count(*) FILTER (quality <> 1) AS n_retained
        FROM catalogue JOIN labels ON doc_id = row_id GROUP BY category""",
)
def releasable_files(spark, sf):
    work = catalogue(spark, sf).select(
        "row_id", "category", F.col("n_chars").alias("length"), F.concat_ws("/", "category", F.concat("record_id", F.lit(".pdf"))).alias("path")
    )
    stored = work.join(labels(spark, sf), "row_id")
    made = stored.filter("quality = 1").select(ql.md_path(F.col("path")).alias("path"))
    return rc.releasable_totals(rc.mark_releasable(stored, made), ["category"])


# --- lots ---------------------------------------------------------------------------------

_LOT_FILES = """files AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice,
         CASE WHEN year(o_orderdate) <= 1996 THEN TRUE WHEN year(o_orderdate) = 1997 THEN o_orderkey % 200 <> 0
              WHEN year(o_orderdate) <= 1999 THEN o_orderkey % 3 = 0 ELSE FALSE END AS has_pdf,
         CASE WHEN year(o_orderdate) <= 1996 THEN TRUE WHEN year(o_orderdate) = 1997 THEN o_orderkey % 2 = 1
              WHEN year(o_orderdate) <= 1999 THEN o_orderkey % 6 = 0 ELSE FALSE END AS has_md,
         CAST(o_orderkey % 5000 + 1000 AS BIGINT) AS length
  FROM orders),
counts AS (
  SELECT year, count(*) AS n_docs, count(*) FILTER (has_pdf) AS n_pdf, count(*) FILTER (has_md) AS n_md,
         CAST(coalesce(sum(length) FILTER (has_pdf), 0) AS BIGINT) AS bytes_pdf FROM files GROUP BY year)"""


def _lot_counts(spark, sf):
    k, year = F.col("o_orderkey"), F.col("year")
    files = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")).select(
        "year",
        F.when(year <= 1996, F.lit(True)).when(year == 1997, k % 200 != 0).when(year <= 1999, k % 3 == 0).otherwise(F.lit(False)).alias("has_pdf"),
        F.when(year <= 1996, F.lit(True)).when(year == 1997, k % 2 == 1).when(year <= 1999, k % 6 == 0).otherwise(F.lit(False)).alias("has_md"),
        (k % 5000 + 1000).alias("length"),
    )
    return lots.lot_counts(files, ["year"])


def _lot_state(spark, sf):
    """State derived from the orders: 1995 is uploaded."""
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    per = orders.groupBy("year").agg(
        F.count(F.lit(1)).alias("documents"), F.min("o_orderdate").alias("processed_at"), F.max("o_orderdate").alias("_last")
    )
    nothing = F.lit(None).cast("bigint")
    return per.select(
        "year",
        "documents",
        F.col("documents").alias("pdfs"),
        F.col("documents").alias("markdown"),
        nothing.alias("bytes_pdf"),
        nothing.alias("bytes_md"),
        "processed_at",
        F.when(F.col("year") == 1995, F.col("_last")).alias("uploaded_at"),
        nothing.alias("pending_ocr"),
    )


@query(
    "lot_status",
    f"""WITH {_LOT_FILES},
        s AS (SELECT *, CASE WHEN year = 1995 THEN 'uploaded'
                             WHEN n_pdf >= n_docs * 0.99 AND n_md >= n_pdf * 0.99 THEN 'ready'
                             WHEN n_pdf >= n_docs * 0.99 THEN 'ocr missing' WHEN n_pdf > 0 THEN 'half done' ELSE 'pending' END AS status FROM counts)
        SELECT year, n_docs, n_pdf, n_md, bytes_pdf, status, CAST(CASE WHEN status = 'pending' THEN n_docs ELSE 0 END AS BIGINT) AS backlog,
               round(CASE WHEN status = 'pending' THEN n_docs ELSE 0 END / 660.0, 6) AS eta_hours FROM s""",
)
def lot_status(spark, sf):
    status = lots.lot_status(_lot_counts(spark, sf), _lot_state(spark, sf))
    return status.withColumn("eta_hours", F.round("eta_hours", 6))


@query("half_done_year", f"WITH {_LOT_FILES} SELECT max(year) AS year FROM counts WHERE n_pdf > 0 AND n_pdf < n_docs")
def half_done_year(spark, sf):
    return lots.half_done_year(_lot_counts(spark, sf))


@query(
    "lot_estimate",
    """SELECT CAST(year(o_orderdate) + 19 AS INTEGER) AS year, count(*) AS n_docs,
              CAST(count(*) * CASE WHEN year(o_orderdate) + 19 >= 2017 THEN 307 ELSE 2194 END * 1024 AS BIGINT) AS est_bytes,
              CAST(15000000000 AS BIGINT) >= count(*) * CASE WHEN year(o_orderdate) + 19 >= 2017 THEN 307 ELSE 2194 END * 1024 * 13 AS fits
       FROM orders GROUP BY year(o_orderdate)""",
)
def lot_estimate(spark, sf):
    years = table(spark, sf, "orders").groupBy((F.year("o_orderdate") + 19).alias("year")).agg(F.count(F.lit(1)).alias("n_docs"))
    return lots.lot_estimate(years, 1_500_000_000)


@query("lot_backlog", f"WITH {_LOT_FILES} SELECT year, n_docs FROM counts WHERE year >= 1995 AND year <= 2000 AND year <> 1995")
def lot_backlog(spark, sf):
    years = _lot_counts(spark, sf).select("year", "n_docs")
    return lots.lot_backlog(years, _lot_state(spark, sf), 1995, 2000)


@query("lot_uploaded", f"WITH {_LOT_FILES} SELECT DISTINCT year FROM counts WHERE year IN (1995)")
def lot_uploaded(spark, sf):
    return lots.already_uploaded(_lot_counts(spark, sf), _lot_state(spark, sf))


@query(
    "lot_state_upsert",
    """WITH old AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS documents, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at
                    FROM orders GROUP BY year(o_orderdate)),
            late AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS pdfs FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
       SELECT year, documents, CASE WHEN year >= 1998 THEN pdfs ELSE documents END AS pdfs,
              CASE WHEN year >= 1998 THEN last_at ELSE first_at END AS processed_at,
              CASE WHEN year = 1995 THEN last_at WHEN year = 1996 THEN TIMESTAMP '2002-01-01' END AS uploaded_at,
              CASE WHEN year = 1996 THEN documents - pdfs END AS pending_ocr
       FROM old JOIN late USING (year)""",
)
def lot_state_upsert(spark, sf):
    """Years from 1998 are processed again; then 1996 is marked uploaded with what it retains."""
    old = _lot_state(spark, sf)
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    done = orders.groupBy("year").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("pdfs"),
        F.count_if(F.col("o_orderstatus") != "F").alias("n_retained"),
        F.max("o_orderdate").alias("processed_at"),
    )
    new = (
        old.drop("pdfs", "processed_at")
        .join(done.filter("year >= 1998").drop("n_retained"), "year")
        .select(*old.columns)
    )
    state = lots.upsert_state(old, new)
    marked = lots.mark_uploaded(state, done.filter("year = 1996"), F.lit("2002-01-01").cast("timestamp"))
    return marked.select("year", "documents", "pdfs", "processed_at", "uploaded_at", "pending_ocr")


_ASSIGNED = [("1-URGENT", "a"), ("2-HIGH", "b"), ("3-MEDIUM", "c"), ("4-NOT SPECIFIED", "a"), ("5-LOW", "b")]
_SQL_ASSIGNED = f"""assignment (category, assignee) AS (VALUES {", ".join(f"('{c}', '{a}')" for c, a in _ASSIGNED)})"""


def _assignment(spark):
    return literal_dim(spark, _ASSIGNED, "category string, assignee string")


@query(
    "assignment_split",
    f"""WITH {_SQL_ASSIGNED},
        own AS (SELECT assignee AS output, o_orderkey FROM orders JOIN assignment ON category = o_orderpriority
                UNION ALL SELECT 'all', o_orderkey FROM orders)
        SELECT output, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM own GROUP BY output""",
)
def assignment_split(spark, sf):
    """One output folder per assignee and one for the whole corpus, read back."""
    path = scaling.shared_dir(spark, "assigned")
    rows = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "category")
    tables.write_by_assignee(lots.assignment_outputs(rows, _assignment(spark), "category"), path)
    return spark.read.parquet(path).groupBy("output").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "assignment_scope",
    f"""WITH {_SQL_ASSIGNED}
        SELECT assignee AS output, category, o_orderkey FROM orders JOIN assignment ON category = o_orderpriority
        WHERE category IN ('1-URGENT', '5-LOW')""",
)
def assignment_scope(spark, sf):
    """A partial run: no output passes for the whole corpus."""
    rows = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "category")
    outputs = lots.assignment_outputs(rows, _assignment(spark), "category", ["1-URGENT", "5-LOW"])
    return outputs.select("output", "category", "o_orderkey")


@query(
    "assignment_balance",
    f"""WITH {_SQL_ASSIGNED},
        per AS (SELECT assignee, count(*) AS n_docs FROM orders LEFT JOIN assignment ON category = o_orderpriority GROUP BY 1)
        SELECT assignee, n_docs, round(CAST((SELECT max(n_docs) FROM per) AS DOUBLE) / (SELECT min(n_docs) FROM per), 4) AS spread FROM per""",
)
def assignment_balance(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("category"))
    return lots.assignment_balance(lots.assign(rows, _assignment(spark), ["category"], "o_orderkey"))


# --- samples and sizes ------------------------------------------------------------------------

_STRATA = """strata AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
sizes AS (SELECT year, count(*) AS n FROM strata GROUP BY year),
ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY md5('{seed}' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM strata)"""


@query(
    "stratified_sample",
    f"""WITH {_STRATA.format(seed=11)}
        SELECT o_orderkey, r.year FROM ranked r JOIN sizes s ON s.year = r.year
        WHERE rn <= least(greatest(round_even(CAST(n AS DOUBLE) / (SELECT count(*) FROM strata) * 100, 0), 1), n)""",
)
def stratified_sample(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    quotas = sampling.proportional_quotas(rows, "year", 100)
    return sampling.stratified_sample(rows, quotas, "year", "o_orderkey", 100, 11)


@query(
    "equal_sample",
    f"""WITH {_STRATA.format(seed=0)}
        SELECT o_orderkey, r.year FROM ranked r JOIN sizes s ON s.year = r.year
        WHERE rn <= least(greatest(30 // (SELECT count(*) FROM sizes), 1), n)""",
)
def equal_sample(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return sampling.stratified_sample(rows, sampling.equal_quotas(rows, "year", 30), "year", "o_orderkey", 30, 0)


@query(
    "size_stats",
    """WITH v AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS i, count(*) OVER () AS n FROM lineitem),
            s AS (SELECT count(*) AS n, avg(v) AS mean, median(v) AS median, max(v) FILTER (i = n // 10) AS p10,
                         max(v) FILTER (i = n * 9 // 10) AS p90, max(v) AS max, stddev_samp(v) AS stdev FROM v)
       SELECT n, round(mean, 4) AS mean, round(median, 4) AS median, p10, p90, max, round(stdev, 3) AS stdev,
              round((mean - stdev / sqrt(n) * 1.96) * n / 1e6, 3) AS total_low, round((mean + stdev / sqrt(n) * 1.96) * n / 1e6, 3) AS total_high FROM s""",
)
def size_stats(spark, sf):
    stats = sampling.size_stats(table(spark, sf, "lineitem"), "l_extendedprice")
    return stats.select(
        "n",
        F.round("mean", 4).alias("mean"),
        F.round("median", 4).alias("median"),
        "p10",
        "p90",
        "max",
        F.round("stdev", 3).alias("stdev"),
        F.round(F.col("total_low") / 1e6, 3).alias("total_low"),
        F.round(F.col("total_high") / 1e6, 3).alias("total_high"),
    )


@query(
    "group_profile",
    """SELECT l_returnflag, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem), 6) AS share,
              round(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) / count(*), 4) AS mean_bytes,
              round(CAST(sum(CAST(l_quantity AS DECIMAL(38,4))) AS DOUBLE) / count(*), 4) AS mean_pages,
              round(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) / 1024 / greatest(sum(l_quantity), 1), 6) AS kb_per_page
       FROM lineitem GROUP BY l_returnflag""",
)
def group_profile(spark, sf):
    profile = sampling.group_profile(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity")
    return profile.select(
        "l_returnflag",
        "n",
        F.round("share", 6).alias("share"),
        F.round("mean_bytes", 4).alias("mean_bytes"),
        F.round("mean_pages", 4).alias("mean_pages"),
        F.round("kb_per_page", 6).alias("kb_per_page"),
    )


@query(
    "year_profile",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
              round(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) / count(*), 4) AS mean_bytes,
              round(avg(CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS scanned_share
       FROM lineitem GROUP BY 1""",
)
def year_profile(spark, sf):
    """Files of a sample by year, and how many of them are scans."""
    sample = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    profile = sampling.year_profile(sample, "year", "l_extendedprice", "l_returnflag", "A")
    return profile.select("year", "n", F.round("mean_bytes", 4).alias("mean_bytes"), F.round("scanned_share", 6).alias("scanned_share"))


@query(
    "weighted_projection",
    """WITH m AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_extendedprice) AS mean_size FROM lineitem GROUP BY 1),
            p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_docs FROM orders GROUP BY 1)
       SELECT CAST(sum(n_docs) AS BIGINT) AS covered,
              round(sum(mean_size * n_docs) / sum(n_docs) * (SELECT count(*) FROM orders) / 1e6, 3) AS projected
       FROM m JOIN p USING (year)""",
)
def weighted_projection(spark, sf):
    sample = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    population = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_docs"))
    total = population.agg(F.sum("n_docs")).scalar()
    projected = sampling.weighted_projection(sample, population, "year", "l_extendedprice", total)
    return projected.select("covered", F.round(F.col("projected") / 1e6, 3).alias("projected"))


# --- chunk files, inventories, stored files -------------------------------------------------------


def _chunk_rows(spark, sf):
    return whole_repeated(spark, sf).select("row_id", "record_id", "category", "page", "link", "subject")


@query(
    "read_chunks",
    f"""WITH {SQL_WHOLE_REPEATED} SELECT record_id, category, page, link, subject, CAST(NULL AS VARCHAR) AS summary FROM repeated WHERE page >= 1""",
)
def read_chunks(spark, sf):
    """Rows written as chunk files and read back with explicit schemas."""
    path = scaling.shared_dir(spark, "chunks")
    chunks.write_chunks(_chunk_rows(spark, sf), path)
    rows, _ = chunks.read_chunks(spark, path)
    return rows.select("record_id", "category", "page", "link", "subject", "summary")


@query(
    "write_chunks",
    f"""WITH {SQL_WHOLE_REPEATED},
        l AS (SELECT category, max(page) AS last_page FROM repeated GROUP BY ALL),
        g AS (SELECT r.category, (page - 1) // 25 * 25 + 1 AS chunk_start, count(DISTINCT page) AS n_seen, count(*) AS n_rows, max(last_page) AS last_page
              FROM repeated r JOIN l USING (category) GROUP BY ALL)
        SELECT category, n_seen = least(25, last_page - chunk_start + 1) AS complete, CAST(n_rows AS BIGINT) AS n_rows,
               CAST(least(25, last_page - chunk_start + 1) - n_seen AS BIGINT) AS n_failed, CAST(chunk_start AS BIGINT) AS chunk_start FROM g""",
)
def write_chunks(spark, sf):
    """The objects of each chunk as they stand in the files, put together again."""
    path = scaling.shared_dir(spark, "chunks")
    chunks.write_chunks(_chunk_rows(spark, sf), path)
    stored = chunks.read_objects(spark, path)
    start = pages.chunk_start(F.get("filas", F.lit(0))["Pagina"])
    parts = stored.select(
        F.get("filas", F.lit(0))["Especialidad"].alias("category"),
        start.alias("chunk_start"),
        F.col("completo").alias("complete"),
        F.size("fallidas").cast("bigint").alias("n_failed"),
        F.size("filas").cast("bigint").alias("n_parts"),
    )
    return parts.groupBy("category", "chunk_start", "complete", "n_failed").agg(F.sum("n_parts").alias("n_rows"))


@query(
    "ingest_incremental",
    f"""WITH {SQL_WHOLE_REPEATED}, r AS (SELECT category, record_id, arg_min(page, row_id) AS page, arg_min(subject, row_id) AS subject FROM repeated GROUP BY ALL)
        SELECT category, record_id, page, subject FROM r""",
)
def ingest_incremental(spark, sf):
    """Chunk files arrive in two deliveries, the second repeats ids of the first; a third run finds nothing new."""
    source, target, checkpoint = (scaling.shared_dir(spark, n) for n in ("arriving", "ingested", "progress"))
    rows = _chunk_rows(spark, sf)
    again = F.col("row_id") >= 1_000_000_000
    for number, part in enumerate((rows.filter(~again), rows.filter(again))):
        chunks.write_chunks(part, f"{source}/delivery{number}")
        ingest.ingest_chunks(spark, source, target, checkpoint)
    ingest.ingest_chunks(spark, source, target, checkpoint)
    return spark.read.parquet(target).select("category", "record_id", "page", "subject")


@query(
    "throughput_windows",
    """SELECT time_bucket(INTERVAL 90 SECONDS, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, count(*) * 3600 / 90.0 AS per_hour
       FROM events GROUP BY 1""",
)
def throughput_windows(spark, sf):
    return ingest.throughput(table(spark, sf, "events"), "ts", 90)


@query(
    "throughput_eta",
    """WITH d AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n FROM events GROUP BY 1),
            r AS (SELECT *, CAST((SELECT count(*) FROM events) - sum(n) OVER (ORDER BY window_start) AS BIGINT) AS remaining FROM d)
       SELECT window_start, n, round(n * 3600 / 86400.0, 6) AS per_hour, remaining,
              round(remaining / (n * 3600 / 86400.0), 4) AS hours_left, CASE WHEN remaining <= 0 THEN 'done' ELSE 'running' END AS state FROM r""",
)
def throughput_eta(spark, sf):
    """Rate per day and hours to go at that rate; a day has one row, so the days can be summed in order."""
    events = table(spark, sf, "events")
    days = ingest.throughput(events, "ts", 86400)
    total = events.agg(F.count(F.lit(1))).scalar()
    numbered = days.withColumn("_day", F.unix_date(F.to_date("window_start")))
    upto = scaling.running(numbered, [], "_day", {"_done": ("sum", F.col("n"))})
    left = upto.withColumn("remaining", total - F.col("_done"))
    return left.select(
        "window_start",
        "n",
        F.round("per_hour", 6).alias("per_hour"),
        "remaining",
        F.round(ingest.hours_left(F.col("remaining"), F.col("per_hour")), 4).alias("hours_left"),
        ingest.progress_state(F.col("remaining"), F.col("per_hour")).alias("state"),
    )


@query(
    "throughput_idle",
    """WITH c AS (SELECT CAST(floor(epoch(ts) / 90) AS BIGINT) AS slot, count(*) AS n FROM events GROUP BY 1),
            s AS (SELECT unnest(range((SELECT min(slot) FROM c), (SELECT max(slot) FROM c) + 1)) AS slot)
       SELECT make_timestamp(s.slot * 90 * 1000000) AS window_start, coalesce(n, 0) AS n, coalesce(n, 0) * 3600 / 90.0 AS per_hour,
              CASE WHEN n IS NULL THEN 'stalled' ELSE 'running' END AS state FROM s LEFT JOIN c USING (slot)""",
)
def throughput_idle(spark, sf):
    """Intervals without arrivals have their row too, and are stalls as long as work is left."""
    every = ingest.with_idle(ingest.throughput(table(spark, sf, "events"), "ts", 90), 90)
    return every.withColumn("state", ingest.progress_state(F.lit(1), F.col("per_hour")))


@query(
    "file_inventory",
    f"""WITH {SQL_CATALOGUE},
        f AS (SELECT category, year, count(*) AS n, sum(strlen(record_id || ' ' || link) + 1) AS bytes FROM catalogue GROUP BY ALL)
        SELECT category, CAST(year AS VARCHAR) AS year, CAST(sum(bytes) AS BIGINT) AS bytes FROM f GROUP BY ALL""",
)
def file_inventory(spark, sf):
    """The catalogue stored as files under category and year, then listed.

    How many files hold a folder depends on the layout; its bytes do not.
    """
    path = scaling.shared_dir(spark, "files")
    lines = catalogue(spark, sf).select("category", "year", F.concat_ws(" ", "record_id", "link").alias("value"))
    lines.write.partitionBy("category", "year").text(path)
    totals = tables.folder_totals(tables.file_inventory(spark, path, "*.txt"))
    return totals.select(
        F.regexp_replace("category", "^category=", "").alias("category"),
        F.regexp_replace("year", "^year=", "").alias("year"),
        "bytes",
    )


_BLOB_HEAD = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '%PDX-' ELSE '%PDF-1.4 ' END"


def _blobs(spark, sf):
    """Documents as stored bytes, with markers by id."""
    k = F.col("doc_id")
    head = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("%PDX-")).otherwise(F.lit("%PDF-1.4 "))
    font = F.when(k % 2 == 0, F.lit("/Font ")).otherwise(F.lit(""))
    image = F.when(k % 3 == 0, F.lit("/DCTDecode ")).when(k % 7 == 0, F.lit("/JPXDecode ")).otherwise(F.lit(""))
    tree = F.lit("/Type /Pages ")
    leaves = F.expr("repeat('/Type/Page ', cast(doc_id % 4 as int))")
    content = F.concat(head, font, image, tree, leaves, F.lit("/Type /Page "), F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.encode(content, "UTF-8").alias("content"))


_SQL_BLOB = f"""blobs AS (SELECT doc_id, {_BLOB_HEAD} || CASE WHEN doc_id % 2 = 0 THEN '/Font ' ELSE '' END
  || CASE WHEN doc_id % 3 = 0 THEN '/DCTDecode ' WHEN doc_id % 7 = 0 THEN '/JPXDecode ' ELSE '' END || '/Type /Pages '
  || repeat('/Type/Page ', CAST(doc_id % 4 AS INTEGER)) || '/Type /Page ' || text AS body FROM documents)"""


@query(
    "blob_validity",
    f"""WITH {_SQL_BLOB} SELECT doc_id, CAST(strlen(body) AS BIGINT) AS n_bytes, strlen(body) >= 1000 AND starts_with(body, '%PDF-') AS is_valid FROM blobs""",
)
def blob_validity(spark, sf):
    content = F.col("content")
    return _blobs(spark, sf).select(
        "doc_id", F.length(content).cast("bigint").alias("n_bytes"), ql.blob_valid(content).alias("is_valid")
    )


@query(
    "blob_classify",
    f"""WITH {_SQL_BLOB}
        SELECT doc_id, CASE WHEN i AND NOT f THEN 'escaneado' WHEN f AND NOT i THEN 'nativo' WHEN f AND i THEN 'mixto' ELSE '?' END AS kind,
               CAST(len(regexp_extract_all(body, '/Type ?/Page')) - len(regexp_extract_all(body, '/Type ?/Pages')) AS INTEGER) AS n_pages
        FROM (SELECT *, contains(body, '/Font') AS f, contains(body, '/DCTDecode') OR contains(body, '/CCITTFaxDecode')
                        OR contains(body, '/JBIG2Decode') OR contains(body, '/JPXDecode') AS i FROM blobs)""",
)
def blob_classify(spark, sf):
    content = F.col("content")
    return _blobs(spark, sf).select("doc_id", ql.blob_kind(content).alias("kind"), ql.blob_pages(content).alias("n_pages"))
