"""Page and chunk completeness, imports, recovery and failure streaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogproof import schemas
from catalogproof import fixed_values as fx
from catalogproof.operators import dedupe, pages, scaling
from catalogproof.plans import audit
from catalogproof.queries.base import (
    DOWNLOAD_BASE,
    SQL_CATALOGUE,
    SQL_HARVESTED,
    SQL_PROFILE,
    SQL_REPEATED,
    SQL_WHOLE_REPEATED,
    catalogue,
    harvested,
    labels,
    query,
    record_id,
    repeated_rows,
    whole_repeated,
    sql_record_id,
    table,
    when,
)
from catalogproof.sources import tables


def _profile(spark, sf):
    return pages.page_profile(harvested(spark, sf))


@query("page_profile", f"WITH {SQL_PROFILE} SELECT category, page, n_rows FROM profile")
def page_profile(spark, sf):
    return _profile(spark, sf)


@query("missing_pages", f"WITH {SQL_PROFILE} SELECT category, last_page, page FROM missing")
def missing_pages(spark, sf):
    return pages.missing_pages(_profile(spark, sf))


@query(
    "missing_expected_pages",
    f"""WITH {SQL_PROFILE},
        full_pages AS (SELECT category, max(page) AS last_page FROM catalogue GROUP BY ALL)
        SELECT e.category, CAST(e.last_page AS BIGINT) AS last_page, CAST(e.page AS BIGINT) AS page
        FROM (SELECT category, last_page, unnest(range(1, CAST(last_page + 1 AS BIGINT))) AS page FROM full_pages) e
        LEFT JOIN profile p ON p.category = e.category AND p.page = e.page WHERE p.page IS NULL""",
)
def missing_expected_pages(spark, sf):
    expected = catalogue(spark, sf).groupBy("category").agg(F.max("page").alias("last_page"))
    return pages.missing_pages(_profile(spark, sf), expected)


@query(
    "short_pages",
    f"""WITH {SQL_PROFILE}
        SELECT p.category, p.page, p.n_rows FROM profile p JOIN last_pages l USING (category)
        WHERE p.n_rows < 10 AND p.page <> l.last_page""",
)
def short_pages(spark, sf):
    return pages.short_pages(_profile(spark, sf))


@query(
    "page_summary",
    f"""WITH {SQL_REPEATED},
        p AS (SELECT category, CASE WHEN row_id % 97 = 0 THEN 0 ELSE page END AS page, count(*) AS n_rows FROM repeated GROUP BY ALL)
        SELECT category, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_pages, CAST(max(page) AS BIGINT) AS last_page,
               CAST(max(page) - count(*) FILTER (page >= 1) AS BIGINT) AS n_missing,
               count(*) FILTER (n_rows < 10 AND page <> (SELECT max(page) FROM p AS q WHERE q.category = p.category)) AS n_short,
               count(*) FILTER (n_rows > 10) AS n_overloaded,
               CAST(coalesce(sum(n_rows) FILTER (page = 0), 0) AS BIGINT) AS n_no_page
        FROM p GROUP BY category""",
)
def page_summary(spark, sf):
    page = F.when(F.col("row_id") % 97 == 0, F.lit(0)).otherwise(F.col("page"))
    return pages.page_summary(pages.page_profile(repeated_rows(spark, sf).withColumn("page", page)))


@query(
    "overloaded_pages",
    f"""WITH {SQL_REPEATED} SELECT category, page, count(*) AS n_rows FROM repeated GROUP BY ALL HAVING count(*) > 4""",
)
def overloaded_pages(spark, sf):
    return pages.overloaded_pages(pages.page_profile(repeated_rows(spark, sf)), 4)


_STATUS = f"""{SQL_PROFILE},
seen AS (SELECT DISTINCT category, (page - 1) // 25 * 25 + 1 AS chunk_start FROM profile),
status AS (
  SELECT s.category, CAST(s.chunk_start AS BIGINT) AS chunk_start,
         CAST(least(s.chunk_start + 24, l.last_page) AS BIGINT) AS chunk_end,
         NOT EXISTS (SELECT 1 FROM missing m WHERE m.category = s.category
                     AND m.page BETWEEN s.chunk_start AND s.chunk_start + 24) AS complete
  FROM seen s JOIN last_pages l USING (category))"""


@query(
    "chunk_status",
    f"""WITH {_STATUS} SELECT category, chunk_start, chunk_end, complete,
          coalesce((SELECT count(*) FROM missing m WHERE m.category = status.category
                    AND m.page BETWEEN chunk_start AND chunk_end), 0) AS n_failed FROM status""",
)
def chunk_status(spark, sf):
    status = pages.chunk_status(_profile(spark, sf))
    return status.select("category", "chunk_start", "chunk_end", "complete", F.size("failed").cast("bigint").alias("n_failed"))


@query(
    "redo_chunks",
    f"""WITH {_STATUS}
        SELECT DISTINCT * FROM (
          SELECT category, CAST((page - 1) // 25 * 25 + 1 AS BIGINT) AS chunk_start,
                 CAST(least((page - 1) // 25 * 25 + 25, last_page) AS BIGINT) AS chunk_end FROM missing
          UNION ALL SELECT category, chunk_start, chunk_end FROM status WHERE category = 'en' AND chunk_start % 50 = 1)""",
)
def redo_chunks(spark, sf):
    profile = _profile(spark, sf)
    flagged = pages.chunk_status(profile).withColumn(
        "complete", ~((F.col("category") == "en") & (F.col("chunk_start") % 50 == 1))
    )
    return pages.chunks_to_redo(profile, flagged)


@query(
    "pending_chunks",
    f"""WITH {_STATUS},
        totals AS (SELECT category, max(page) AS total_pages FROM catalogue GROUP BY ALL),
        planned AS (SELECT category, total_pages, unnest(range(1, CAST(total_pages + 1 AS BIGINT), 25)) AS chunk_start FROM totals)
        SELECT p.category, CAST(p.chunk_start AS BIGINT) AS chunk_start,
               CAST(least(p.chunk_start + 24, p.total_pages) AS BIGINT) AS chunk_end
        FROM planned p LEFT JOIN (SELECT * FROM status WHERE complete) s
          ON s.category = p.category AND s.chunk_start = p.chunk_start WHERE s.chunk_start IS NULL""",
)
def pending_chunks(spark, sf):
    totals = catalogue(spark, sf).groupBy("category").agg(F.max("page").alias("total_pages"))
    return pages.pending_chunks(totals, pages.chunk_status(_profile(spark, sf)))


# --- audit ------------------------------------------------------------------------


def _audited_rows(spark, sf):
    return _unlinked(repeated_rows(spark, sf))


def _unlinked(rows):
    return rows.withColumn("link", F.when(F.col("row_id") % 41 == 0, F.lit("")).otherwise(F.col("link")))


@query(
    "audit_report",
    f"""WITH {SQL_REPEATED},
        r AS (SELECT category, page, record_id, CASE WHEN row_id % 41 = 0 THEN '' ELSE link END AS link FROM repeated),
        p AS (SELECT category, page, count(*) AS n, count(*) FILTER (link = '') AS no_link FROM r GROUP BY ALL),
        l AS (SELECT category, max(page) AS last_page FROM p GROUP BY ALL),
        ids AS (SELECT category, count(DISTINCT record_id) AS n_unique FROM r GROUP BY ALL),
        flags AS (
          SELECT category, count(*) FILTER (NOT complete) AS n_incomplete FROM (
            SELECT p.category, (p.page - 1) // 25 AS c, count(*) = least(25, max(l.last_page) - (p.page - 1) // 25 * 25) AS complete
            FROM p JOIN l USING (category) GROUP BY p.category, (p.page - 1) // 25) GROUP BY category),
        per AS (
          SELECT p.category, max(n_unique) AS n_unique, count(*) AS n_pages, max(page) AS last_page, max(page) - count(*) AS n_missing,
                 count(*) FILTER (n < 10 AND page <> last_page) AS n_short, sum(no_link) AS n_without_link, max(n_incomplete) AS n_incomplete
          FROM p JOIN l USING (category) JOIN ids USING (category) JOIN flags USING (category) GROUP BY p.category),
        a AS (SELECT category, CAST(0 AS INTEGER) AS is_total, n_unique, n_pages, last_page, n_missing, n_short, n_without_link, n_incomplete FROM per
              UNION ALL SELECT NULL, 1, sum(n_unique), sum(n_pages), max(last_page), sum(n_missing), sum(n_short), sum(n_without_link), sum(n_incomplete) FROM per)
        SELECT category, is_total, CAST(n_unique AS BIGINT) AS n_unique, CAST(n_pages AS BIGINT) AS n_pages, CAST(last_page AS BIGINT) AS last_page,
               CAST(n_missing AS BIGINT) AS n_missing, CAST(n_short AS BIGINT) AS n_short, CAST(n_without_link AS BIGINT) AS n_without_link,
               CAST(n_incomplete AS BIGINT) AS n_incomplete_chunks,
               CASE WHEN n_missing > 0 OR n_short > 0 OR n_without_link > 0 OR n_incomplete > 0 OR n_pages = 0 THEN 'REVIEW' ELSE 'OK' END AS verdict
        FROM a""",
)
def audit_report(spark, sf):
    rows = scaling.materialize(_audited_rows(spark, sf), "harvest")
    return audit.audit_report(rows, pages.chunk_status(pages.page_profile(rows)))


@query(
    "category_totals",
    f"""WITH {SQL_WHOLE_REPEATED},
        r AS (SELECT category, CASE WHEN row_id % 41 = 0 THEN '' ELSE link END AS link FROM repeated)
        SELECT category, CAST(grouping(category) AS INTEGER) AS is_total, count(*) AS n_rows, count(*) FILTER (link <> '') AS n_with_link
        FROM r GROUP BY ROLLUP (category)""",
)
def category_totals(spark, sf):
    return audit.category_totals(_unlinked(whole_repeated(spark, sf)))


# --- imports ------------------------------------------------------------------------


def _external(spark, sf):
    """The catalogue as an outside table: the file's headers, everything text, some of it bad."""
    k = F.col("row_id")
    link = when(
        (k % 30 == 0, F.lit(None).cast("string")),
        (k % 30 == 1, F.lit("https://host/none")),
        otherwise=F.concat(F.lit(" "), F.lit(DOWNLOAD_BASE), record_id(k), F.lit(" ")),
    )
    page = F.when(k % 23 == 0, F.lit("n/a")).otherwise(F.col("page").cast("string"))
    values = {"category": F.col("category"), "subject": F.col("subject"), "page": page, "link": link}
    nothing = k % 50 == 7  # a row with no cell at all
    return catalogue(spark, sf).select(
        *[
            F.when(~nothing, values.get(name, F.lit(None).cast("string"))).alias(header)
            for header, name in fx.RECORD_HEADERS.items()
        ],
        "row_id",
    )


_SQL_EXTERNAL = f"""{SQL_CATALOGUE},
external AS (
  SELECT row_id, category, subject, CASE WHEN row_id % 23 = 0 THEN 0 ELSE page END AS page,
         CASE WHEN row_id % 30 = 0 THEN 'no_link' WHEN row_id % 30 = 1 THEN 'odd_link' ELSE 'with_id' END AS link_class,
         '{DOWNLOAD_BASE}' || {sql_record_id('row_id')} AS dlink, record_id AS rid
  FROM catalogue WHERE row_id % 50 <> 7)"""


@query(
    "import_external",
    f"""WITH {_SQL_EXTERNAL}
        SELECT row_id, category, subject, '' AS summary, dlink AS link, rid AS record_id, CAST(page AS INTEGER) AS page,
               'excel' AS provenance FROM external WHERE link_class = 'with_id'""",
)
def import_external(spark, sf):
    rows, _ = tables.import_external(_external(spark, sf))
    return rows.select("row_id", "category", "subject", "summary", "link", "record_id", "page", "provenance")


@query("import_triage", f"WITH {_SQL_EXTERNAL} SELECT link_class, count(*) AS n FROM external GROUP BY 1")
def import_triage(spark, sf):
    return tables.import_external(_external(spark, sf))[1]


@query(
    "import_review",
    f"""WITH {SQL_WHOLE_REPEATED},
        r AS (SELECT category, record_id, CASE WHEN row_id % 97 = 0 THEN 0 ELSE page END AS page, row_id FROM repeated),
        u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category, record_id ORDER BY row_id) AS rn FROM r) WHERE rn = 1),
        p AS (SELECT category, page, count(*) AS n FROM u GROUP BY ALL),
        s AS (SELECT category, CAST(sum(n) AS BIGINT) AS n_unique, count(*) AS n_pages, CAST(max(page) AS BIGINT) AS last_page,
                     CAST(max(page) - count(*) FILTER (page >= 1) AS BIGINT) AS n_missing, count(*) FILTER (n > 10) AS n_overloaded,
                     CAST(coalesce(sum(n) FILTER (page = 0), 0) AS BIGINT) AS n_no_page, category IN ('en', 'fr') AS known FROM p GROUP BY category)
        SELECT category, n_unique, (SELECT count(*) FROM r WHERE r.category = s.category) - n_unique AS n_duplicated, n_pages, last_page,
               n_missing, n_overloaded, n_no_page, known,
               CASE WHEN n_missing > 0 OR (SELECT count(*) FROM r WHERE r.category = s.category) > n_unique OR n_overloaded > 0
                         OR n_no_page > 0 OR NOT known THEN 'REVIEW' ELSE 'OK' END AS verdict FROM s""",
)
def import_review(spark, sf):
    page = F.when(F.col("row_id") % 97 == 0, F.lit(0)).otherwise(F.col("page"))
    rows = whole_repeated(spark, sf).withColumn("page", page)
    return audit.import_review(rows, ["en", "fr"], "row_id")


@query(
    "import_admit",
    f"""WITH {SQL_WHOLE_REPEATED},
        labelled AS (SELECT category, page FROM catalogue WHERE page % 7 <> 3 AND row_id IN (SELECT doc_id FROM labels))
        SELECT row_id, category || ' ' || page AS category, page FROM repeated
        WHERE (category, page) IN (SELECT category, page FROM catalogue) AND (category, page) NOT IN (SELECT category, page FROM labelled)""",
)
def import_admit(spark, sf):
    """Every page a category of its own: those that the catalogue knows and the harvest has nothing of."""

    def by_page(rows):
        return rows.select("row_id", F.concat_ws(" ", "category", "page").alias("category"), "page")

    known = by_page(catalogue(spark, sf)).select("category")
    return audit.import_admit(by_page(whole_repeated(spark, sf)), known, by_page(harvested(spark, sf)), "row_id")


# --- recovery -----------------------------------------------------------------------


@query(
    "splice_recovered",
    f"""WITH {SQL_HARVESTED},
        recovered AS (SELECT * EXCLUDE (text) FROM catalogue WHERE page % 7 = 3),
        ranks AS (SELECT category, min(row_id) AS category_rank_row FROM harvested GROUP BY ALL),
        both_sets AS (SELECT category, page, row_id, FALSE AS is_recovered FROM harvested
                 UNION ALL SELECT category, page, row_id, TRUE FROM recovered)
        SELECT category, page, row_id, is_recovered, category_rank_row,
               row_number() OVER (ORDER BY category_rank_row NULLS LAST, page, is_recovered, row_id) AS position
        FROM both_sets LEFT JOIN ranks USING (category)""",
)
def splice_recovered(spark, sf):
    keep = ["category", "page", "row_id"]
    base = harvested(spark, sf).select(*keep)
    recovered = catalogue(spark, sf).filter(F.col("page") % 7 == 3).select(*keep)
    both = pages.splice_recovered(base, recovered, "row_id")
    # a category new to the base goes last
    ordered = both.withColumn("_new", F.col("category_rank_row").isNull())
    ranked = scaling.global_rank(ordered, ["_new", *pages.SPLICE_ORDER, "row_id"], "position")
    return ranked.select(*keep, "is_recovered", "category_rank_row", "position")


_ASKED = f"""{SQL_PROFILE},
asked AS (
  SELECT category, page FROM missing
  UNION ALL SELECT p.category, p.page FROM profile p JOIN last_pages l USING (category) WHERE p.n_rows < 10 AND p.page <> l.last_page)"""


def _asked(spark, sf):
    profile = _profile(spark, sf)
    columns = ["category", F.col("page").cast("bigint").alias("page")]
    return pages.missing_pages(profile).select(*columns).unionByName(pages.short_pages(profile).select(*columns))


@query(
    "recovery_summary",
    f"""WITH {_ASKED},
        recovered AS (SELECT c.category FROM catalogue c JOIN asked a ON a.category = c.category AND a.page = c.page
                      WHERE a.page % 5 <> 0 AND c.record_id NOT IN (SELECT record_id FROM harvested))
        SELECT category, count(*) AS n_asked, count(*) FILTER (page % 5 <> 0) AS n_reviewed,
               coalesce((SELECT count(*) FROM recovered r WHERE r.category = asked.category), 0) AS n_new,
               count(*) FILTER (page % 5 = 0) AS n_failed FROM asked GROUP BY category""",
)
def recovery_summary(spark, sf):
    asked = _asked(spark, sf)
    attempts = asked.withColumn("ok", F.col("page") % 5 != 0)
    rows = catalogue(spark, sf).withColumn("page", F.col("page").cast("bigint"))
    reviewed = rows.join(attempts.filter("ok"), ["category", "page"], "left_semi")
    fresh = dedupe.new_records(reviewed, harvested(spark, sf), "record_id", ["row_id"])
    return audit.recovery_summary(asked, attempts, fresh)


@query(
    "resume_pending",
    f"""WITH {_ASKED} SELECT category, CAST(page AS BIGINT) AS page FROM asked WHERE page % 3 <> 0""",
)
def resume_pending(spark, sf):
    """Two runs against one journal: the first handles every third page, the second gets the rest."""
    journal = scaling.shared_dir(spark, "journal")
    asked = _asked(spark, sf)
    first = asked.filter(F.col("page") % 3 == 0)
    rows = catalogue(spark, sf).withColumn("page", F.col("page").cast("bigint"))
    found = rows.join(first, ["category", "page"], "left_semi").select("record_id", "category", "page")
    tables.append_journal(found, first, journal)
    _, done = tables.read_journal(spark, journal, found.schema)
    return tables.resume_pending(asked, done)


@query(
    "journal_rows",
    f"""WITH {_ASKED} SELECT c.record_id, c.category, CAST(c.page AS BIGINT) AS page FROM catalogue c JOIN asked a ON a.category = c.category AND a.page = c.page
        WHERE c.page % 3 = 0""",
)
def journal_rows(spark, sf):
    """What earlier runs recovered comes back from the journal."""
    journal = scaling.shared_dir(spark, "journal")
    asked = _asked(spark, sf)
    rows = catalogue(spark, sf).withColumn("page", F.col("page").cast("bigint"))
    for number in (0, 3):
        part = asked.filter(F.col("page") % 6 == number)
        found = rows.join(part, ["category", "page"], "left_semi").select("record_id", "category", "page")
        tables.append_journal(found, part, journal)
    back, _ = tables.read_journal(spark, journal, found.schema)
    return back


# --- failures in a row ------------------------------------------------------------------

_ATTEMPTS = """attempts AS (SELECT event_id, event_id // 25 AS chunk, event_type = 'error' AS failed FROM events),
numbered AS (SELECT *, row_number() OVER ({part} ORDER BY event_id) AS pos,
                    count(*) FILTER (failed) OVER ({part} ORDER BY event_id) AS bad FROM attempts),
based AS (SELECT *, coalesce(max(CASE WHEN NOT failed THEN bad END) OVER ({part} ORDER BY event_id), 0) AS base FROM numbered),
streaks AS (SELECT *, CAST(CASE WHEN failed THEN bad - base ELSE 0 END AS BIGINT) AS streak FROM based),
cut AS (SELECT {key} AS key, min(event_id) AS cut_at FROM streaks WHERE streak = {cut} GROUP BY {key})"""


@query(
    "failure_streaks",
    f"""WITH {_ATTEMPTS.format(part='PARTITION BY chunk', key='chunk', cut=3)}
        SELECT event_id, chunk, failed, streak, coalesce(event_id > cut_at, FALSE) AS written_off
        FROM streaks LEFT JOIN cut ON key = chunk""",
)
def failure_streaks(spark, sf):
    attempts = table(spark, sf, "events").select(
        "event_id",
        F.floor(F.col("event_id") / 25).alias("chunk"),
        (F.col("event_type") == "error").alias("failed"),
    )
    # chunks of 25 attempts: bounded by construction
    return pages.failure_streaks(attempts, ["chunk"], "event_id", "failed", 3, bounded=True)


@query(
    "failure_streaks_run",
    f"""WITH {_ATTEMPTS.format(part='', key='1', cut=4)}
        SELECT event_id, failed, streak, coalesce(event_id > cut_at, FALSE) AS written_off
        FROM streaks LEFT JOIN cut ON TRUE""",
)
def failure_streaks_run(spark, sf):
    """One run of all attempts, stopped at four failures in a row."""
    attempts = table(spark, sf, "events").select("event_id", (F.col("event_type") == "error").alias("failed"))
    return pages.failure_streaks(attempts, [], "event_id", "failed", 4)
