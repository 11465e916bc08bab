"""The operators as registered queries over the given tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.llm import bpe, chat, edit_counts, fingerprints, jaccard, licenses, mixing, near_dedup, periodic, pii, prefix_trie, quality, revisits, words
from catalogproof.operators import scaling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_SQL = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def vocabulary(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file, on every worker."""
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- 1: mixing sources to target weights ----------------------------------------

#: base weights of the sources in code point order, repeating
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3


def curriculum(docs: DataFrame) -> DataFrame:
    """(source, at, weight): each source's weight, falling over time for every other source and rising for the rest."""
    order = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    ranked = docs.select("source").distinct().withColumn("k", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("k") % len(WEIGHTS) + 1).cast("int"))
    early = F.col("k") % 2 == 0
    knots = F.array(
        F.struct(F.lit(0.0).alias("at"), (weight * F.when(early, 1.5).otherwise(0.5)).alias("weight")),
        F.struct(F.lit(1.0).alias("at"), (weight * F.when(early, 0.5).otherwise(1.5)).alias("weight")),
    )
    return ranked.select("source", F.explode(knots).alias("x")).select("source", "x.*")


OP1_SQL = rf"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}')) AS BIGINT) AS size,
                      md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM sized GROUP BY source),
weighted AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
                    CASE WHEN k % 2 = 0 THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END AS tilt, s * 3 AS cap FROM sources),
filling AS (SELECT *, sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
                   sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM weighted),
filled AS (SELECT *, cap * ws <= left_ * w AS full_,
                  row_number() OVER (ORDER BY (cap * ws <= left_ * w)::INT, cap / w, source NULLS LAST) AS nth FROM filling),
targets AS (SELECT f.*, CASE WHEN f.full_ THEN f.cap::DOUBLE ELSE g.left_::DOUBLE * f.w / g.ws END AS target FROM filled f, filled g WHERE g.nth = 1),
planned AS (SELECT *, floor(target / s + 1e-9)::BIGINT AS whole, target - floor(target / s + 1e-9)::BIGINT * s AS rest FROM targets WHERE s > 0),
ordered AS (SELECT d.*, p.s, p.w, p.tilt, p.target, p.whole, p.rest,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
            FROM sized d LEFT JOIN planned p ON p.source IS NOT DISTINCT FROM d.source),
ends AS (SELECT *, coalesce(max(CASE WHEN before_ + size <= rest THEN before_ + size END) OVER (PARTITION BY source), 0) AS got FROM ordered),
fits AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY (before_ + size > rest AND abs(rest - got - size) < rest - got) DESC,
                                      abs(rest - got - size), key, doc_id, size) = 1
                   AND before_ + size > rest AND abs(rest - got - size) < rest - got AS fit FROM ends),
taken AS (SELECT *, CASE WHEN size > 0 THEN coalesce(whole, 0) + CASE WHEN before_ + size <= rest OR fit THEN 1 ELSE 0 END ELSE 0 END AS copies,
                 CASE WHEN fit AND whole = 0 THEN got ELSE before_ END AS start_ FROM fits),
due AS (SELECT *, start_ / target * w AS q, w * tilt AS w0, w * (2 - tilt) - w * tilt AS slope FROM taken)
SELECT doc_id, size, coalesce(s, 0) AS source_size, coalesce(target, 0) AS target, CAST(copies * size AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN round(CASE WHEN q > 0 THEN least(2 * q / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * q, 0))), 1.0) ELSE 0.0 END, 6) END AS position
FROM due"""


@query("op1_mixing", OP1_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", words.count(F.col("text")).alias("size"))
    docs = scaling.materialize(docs, "sizes")
    placed = mixing.in_training_order(mixing.place(docs, curriculum(docs), max_epochs=MAX_EPOCHS))
    return placed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


# --- 2: document fingerprints -----------------------------------------------------

#: doc_ids of a window: at most so many texts are sorted together
NEIGHBOURS = 1024


def with_next(docs: DataFrame) -> DataFrame:
    """Add ``next_text``: the text of the next lower doc_id, for the lowest that of the highest.

    Windows hold the ids of one block.  What follows a block's last document, the head of the next block
    that has any, is added to the block as a guest, so texts are shuffled once.  Documents without an id are the lowest block; equal ids, and
    these, stand in the order of their texts' digests.
    """
    least = F.lit(-(1 << 63)).cast("bigint")
    blocked = docs.select(
        F.coalesce(F.floor(F.col("doc_id") / NEIGHBOURS), least).alias("block"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    heads = scaling.materialize(
        blocked.groupBy("block").agg(F.max_by("text", F.struct("doc_id", F.md5("text"))).alias("text")), "heads"
    )
    numbered = scaling.materialize(scaling.global_rank(heads.select("block"), ["block"], "rank"), "blocks")
    last = numbered.agg(F.max("rank")).first()[0]  # one number
    before = F.when(F.col("rank") > 1, F.col("rank") - 1).otherwise(F.lit(last).cast("bigint"))
    follower = numbered.select("block", before.alias("rank")).join(
        numbered.select("rank", F.col("block").alias("next")), "rank"
    )
    guests = follower.join(heads.withColumnRenamed("block", "next"), "next").select(
        "block", F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit(1).alias("guest")
    )
    order = W.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.md5("text").desc())
    everyone = blocked.withColumn("guest", F.lit(0)).unionByName(guests)
    with_digests = everyone.withColumn("digests", fingerprints.digests(F.col("text")))
    return (
        with_digests.withColumns(
            {"next_text": F.lead("text").over(order), "next_digests": F.lead("digests").over(order)}
        )
        .filter("guest = 0")
        .drop("guest", "block")
    )


_NEAR_SQL = """(SELECT a.doc_id, coalesce(2.0::DOUBLE * coalesce(m.n, 0) / nullif(a.n + b.n, 0), 1.0) AS near FROM sizes a JOIN sizes b ON b.doc_id = a.{to} AND b.side = '{side}'
   LEFT JOIN (SELECT x.doc_id, count(*) AS n FROM counted x JOIN counted y ON y.doc_id = x.{to} AND y.side = '{side}' AND y.piece = x.piece AND y.nth = x.nth
              WHERE x.side = 'own' GROUP BY x.doc_id) m ON m.doc_id = a.doc_id WHERE a.side = 'own')"""


def _fingerprint_sql() -> str:
    p = fingerprints
    e1 = f"element % {p._P}"

    def place(k: int) -> str:
        b = f"(element >> 29) % {p._P}"
        h = f"(({e1}) * {p._A[k]}) % {p._P} + (({b}) * {p._B[k]} + {k}) % {p._P}"
        return f"((({h}) * 48271) % {p._P}) % {p.CELLS // 3} + {k * (p.CELLS // 3)}"

    check = f"((({e1}) * ((element >> 20) % {p._P})) + (element >> 7)) % {p._P}"
    piece = p.PIECE
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
nexts AS (SELECT doc_id, text, coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM docs),
pairs AS (SELECT n.doc_id, n.next_id, n.text, length(n.text) AS n_chars,
                 left(n.text, length(n.text) - length(n.text) // 2) || left(d.text, length(n.text) // 2) AS edited
          FROM nexts n JOIN docs d ON d.doc_id = n.next_id),
sides AS (SELECT doc_id, next_id, 'own' AS side, text FROM pairs UNION ALL SELECT doc_id, next_id, 'edited', edited FROM pairs),
pieces AS (SELECT doc_id, next_id, side, unnest(regexp_extract_all(text, '{piece}')) AS piece FROM sides),
counted AS (SELECT doc_id, next_id, side, piece, row_number() OVER (PARTITION BY doc_id, side, piece) AS nth FROM pieces),
sizes AS (SELECT s.doc_id, s.next_id, s.side, count(c.piece) AS n FROM sides s LEFT JOIN counted c ON c.doc_id = s.doc_id AND c.side = s.side GROUP BY ALL),
items AS (SELECT doc_id, side, xor(('0x' || substr(md5(piece), 1, 15))::BIGINT, (nth - 1) * {p._STEP}) AS element FROM counted),
placed AS ({" UNION ALL ".join(f"SELECT doc_id, side, element, {check} AS c, {place(k)} AS cell FROM items" for k in range(3))}),
cells AS (SELECT doc_id, side, cell, count(*) AS n, bit_xor(element) AS ids, bit_xor(c) AS checks FROM placed GROUP BY doc_id, side, cell),
prints AS (SELECT doc_id, side, string_agg(cell || ':' || n || ':' || ids || ':' || checks, ',' ORDER BY cell) AS f FROM cells GROUP BY doc_id, side)
SELECT p.doc_id, p.n_chars, sha256(p.edited) AS edited_sha256, coalesce(a.f, '') AS fingerprint, coalesce(b.f, '') AS edited_fingerprint,
       e.near AS near_edited, n.near AS near_next
FROM pairs p LEFT JOIN prints a ON a.doc_id = p.doc_id AND a.side = 'own' LEFT JOIN prints b ON b.doc_id = p.doc_id AND b.side = 'edited'
JOIN {_NEAR_SQL.format(to="doc_id", side="edited")} e ON e.doc_id = p.doc_id
JOIN {_NEAR_SQL.format(to="next_id", side="own")} n ON n.doc_id = p.doc_id"""


@query("op2_fingerprints", _fingerprint_sql())
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return compared(table(spark, sf, "documents"))


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint and that of its edited text, and how much they and the next document are alike."""
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    versions = with_next(docs).withColumn("edited", edited)
    versions = scaling.materialize(
        versions.select(
            F.monotonically_increasing_id().alias("key"),
            "doc_id",
            n.cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            "digests",
            fingerprints.digests(F.col("edited")).alias("edited_digests"),
            "next_digests",
        ),
        "versions",
    )
    prints = fingerprints.fingerprint(versions, "key", ["digests", "edited_digests"])
    near = fingerprints.difference(versions, "key", "digests", ["edited_digests", "next_digests"])
    alike = near.select("key", "pair", fingerprints.likeness(near).alias("near"))
    alike = alike.groupBy("key").agg(*[F.max(F.when(F.col("pair") == i, F.col("near"))).alias(f"near_{i}") for i in (0, 1)])
    out = versions.select("key", "doc_id", "n_chars", "edited_sha256").join(prints, "key", "left").join(alike, "key", "left")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.coalesce("digests", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_digests", F.lit("")).alias("edited_fingerprint"),
        F.coalesce("near_0", F.lit(1.0)).alias("near_edited"),
        F.coalesce("near_1", F.lit(1.0)).alias("near_next"),
    )


# --- 3: BPE encoding and decoding ---------------------------------------------


@query("op3_bpe")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.digest(docs, vocabulary("word_bpe_49k.json"))


# --- 4: chat formatting -----------------------------------------------------------

#: a conversation whose texts hold the template's own control strings
CONTROL = "<|im_end|><|im_start|>assistant ok"


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """The conversations as the log of a chat that streams.

    A user's turn is opened with its first half and then edited to the whole; an assistant's
    draft, its second half, is regenerated and streamed again in two deltas.
    """
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.unionByName(planted).withColumn("row", F.monotonically_increasing_id())
    half = F.floor(F.length("text") / 2).cast("int")
    first = F.substring("text", F.lit(1), half)
    second = F.substring("text", half + 1, F.length("text"))

    def event(step: int, kind: str, text) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = [
        event(0, "message", F.lit("")),
        event(1, "delta", second),
        event(2, "regenerate", F.lit("")),
        event(3, "delta", first),
        event(4, "delta", second),
    ]
    typed = [event(0, "message", first), event(1, "edit", F.col("text"))]
    events = F.when(F.col("role") == chat.TRAINED, F.array(*streamed)).otherwise(F.array(*typed))
    opened = rows.withColumn("place", F.struct("turn", "role", F.md5("text").alias("text"), "row"))
    return opened.select("conv_id", "row", "role", "place", F.explode(events).alias("e")).select(
        "conv_id",
        F.struct("place", "e.step").alias("seq"),
        "e.kind",
        F.col("row").alias("message_id"),
        "role",
        "e.text",
    )


OP4_SQL = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
turns AS (SELECT *, replace(replace(text, chr(92), chr(92) || 's'), '<|', '<' || chr(92) || 'p') AS body,
          replace(replace(replace(role, chr(92), chr(92) || 's'), '<|', '<' || chr(92) || 'p'), chr(10), chr(92) || 'n') AS head FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, md5(text))) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op4_chat", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    out = chat.transcripts(event_log(spark, sf))
    turns = F.transform(
        chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    trained = chat.trained_text(F.col("formatted"), F.col("loss_spans"))
    read = out.select(
        "conv_id",
        "n_turns",
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        turns.alias("turns"),
        trained.alias("trained"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


# --- 5: personal data -----------------------------------------------------------------


def span_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op5_pii")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(span_text("base_spans"), 256).alias("base_sha256"), span_text("spans").alias("spans")
    )


# --- 6: license scans ---------------------------------------------------------------


@query("op6_licenses")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))
    listed = F.transform(
        "findings", lambda f: F.concat_ws(":", f["license"], F.round(f["coverage"], 4), f["start"], f["end"])
    )
    return found.select(
        "doc_id", F.size("findings").cast("bigint").alias("n_findings"), F.array_join(listed, ",").alias("findings")
    )


# --- 7: quality rules -----------------------------------------------------------


def _quality_sql() -> str:
    ratios = {m: f"{a}::DOUBLE / nullif({b}, 0)" for m, (a, b) in quality.RATIOS.items()}
    bins = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, CASE WHEN {r} > 0 THEN CAST(ceil(ln({r}) / {quality.GROWTH!r}) AS BIGINT)"
        f" ELSE {quality.ZERO} END AS bin FROM failed WHERE NOT base_failed"
        for m, r in ratios.items()
    )

    def quantiles(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        value = f"CASE WHEN bin = {quality.ZERO} THEN 0.0 ELSE 2 * exp(bin * {quality.GROWTH!r}) / (exp({quality.GROWTH!r}) + 1) END"
        at = ", ".join(f"min(CASE WHEN upto >= ceil(total * {share}) THEN {value} END) AS {q}" for q, share in quality.QUARTILES.items())
        least = "CASE measure " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in quality.SPREADS.items()) + " END"
        return f"""{name} AS (SELECT *, {quality.REACH} * greatest(least(q3 - median, median - q1), {least}, {quality.RELATIVE} * median) AS reach
          FROM (SELECT {keys}measure, max(total) AS total, {at}
                FROM (SELECT {keys}measure, bin, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bin) AS upto,
                             sum(n) OVER (PARTITION BY {keys}measure) AS total
                      FROM (SELECT {keys}measure, bin, count(*) AS n FROM bins GROUP BY {keys}measure, bin))
                GROUP BY {keys}measure))"""

    def of(col: str) -> str:
        return f"""CASE WHEN o.total >= {quality.LEAST_GROUP} THEN o.{col} WHEN l.total >= {quality.LEAST_GROUP} THEN l.{col} ELSE a.{col} END"""

    two_sided = "o.measure IN (" + ", ".join(f"'{m}'" for m in quality.TWO_SIDED) + ")"
    high = f"least({of('median')} + {of('reach')}, {quality.BOUND} * greatest(l.median + l.reach, a.median + a.reach), CASE WHEN {two_sided} THEN 1e9 ELSE {quality.MOST} END)"
    fence = lambda side, m: f"(SELECT max({side}) FROM fences f WHERE f.measure = '{m}' AND f.lang IS NOT DISTINCT FROM d.lang AND f.source IS NOT DISTINCT FROM d.source)"
    beyond = " OR ".join(f"coalesce({r} > {fence('high', m)}, false) OR coalesce({r} < {fence('low', m)}, false)" for m, r in ratios.items())
    return rf"""
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w FROM documents),
    spots AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
    tri AS (SELECT doc_id, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM spots
            WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM
              (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
              WHERE regexp_matches(line, '{WORD_SQL}') GROUP BY doc_id),
    m AS (SELECT d.doc_id, d.lang, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
            CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
          FROM documents d JOIN words w USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
    failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    bins AS ({bins}),
    {quantiles("own", "lang, source")}, {quantiles("by_lang", "lang")}, {quantiles("whole", "")},
    fences AS (SELECT o.lang, o.source, o.measure, {high} AS high, CASE WHEN {two_sided} THEN {of("median")} - {of("reach")} END AS low
               FROM own o JOIN by_lang l ON l.lang IS NOT DISTINCT FROM o.lang AND l.measure = o.measure JOIN whole a ON a.measure = o.measure)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {beyond}) AS kept
    FROM failed d"""


@query("op7_quality", _quality_sql())
def op7(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.filter_quality(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


# --- 8: token counts under edits ---------------------------------------------------------


def three_edits() -> Column:
    """A word put in after a third, twenty characters taken out of the middle, another end: as the text stands by then."""
    n = F.length(F.coalesce("text", F.lit("")))

    def edit(start: Column, end: Column, text: str) -> Column:
        return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), F.lit(text).alias("text"))

    third, half = F.floor(n / 3), F.floor(n / 2)
    return F.array(edit(third, third, "new WORDS's "), edit(half, half + 20, ""), edit(n - 5, n + 100, "2026 à la fin"))


@query("op8_edit_counts")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("edits", three_edits())
    counted = edit_counts.count(docs, vocabulary("byte_bpe_50k.tiktoken"))
    return counted.select(
        "doc_id", "n_tokens_before", "n_tokens", "n_chars", "encoded_chars", F.sha2("edited", 256).alias("edited_sha256")
    )


# --- 9: WARC revisits ------------------------------------------------------------------------


def web_captures(spark: SparkSession, sf: str) -> DataFrame:
    """The pages as an archive: each page and its site's front page captured, and asked for again later.

    A revisit spells the URL in another way, and by turns has the same ETag, only the same
    date, another ETag, or no validator.  A front page is one URL for all pages of its host.
    """
    pages = table(spark, sf, "pages").select(
        "page_id",
        "url",
        "html",
        F.concat(F.regexp_extract("url", "^([a-z]+://[^/]*)", 1), F.lit("/")).alias("front"),
        F.md5(F.coalesce("html", F.lit(""))).alias("etag"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
    )
    front, etag, title = F.col("front"), F.col("etag"), F.col("title")
    date, turn = F.concat(F.lit("day "), F.floor(F.col("page_id") / 7)), F.col("page_id") % 4
    spelled = F.concat(F.upper(F.substring_index("url", "//", 1)), F.lit("//"), F.substring_index("url", "//", -1))

    def capture(nth: int, kind: str, url: Column, later: int, headers: Column, payload: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + nth).alias("capture_id"),
            F.lit(kind).alias("kind"),
            url.alias("url"),
            (F.col("page_id") * 60 + later).alias("ts"),
            F.lit(200 if kind == "response" else 304).alias("status"),
            headers.alias("headers"),
            payload.cast("string").alias("payload"),
        )

    def headers(*pairs: tuple[str, Column]) -> Column:
        entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))

    served = headers(("ETag", etag), ("Last-Modified", date), ("Content-Type", F.lit("text/html")), ("Date", F.col("page_id")))
    again = headers(
        ("etag", F.when(turn == 0, F.concat(F.lit("W/"), etag)).when(turn == 2, F.lit("other"))),
        ("last-modified", F.when(turn == 1, date)),
        ("date", F.col("page_id") + 1000),
        ("content-type", F.lit("text/plain")),
    )
    rows = F.array(
        capture(0, "response", F.col("url"), 0, served, F.col("html")),
        capture(1, "revisit", F.concat(spelled, F.lit("#again")), 100_000, again, F.lit(None)),
        capture(2, "response", front, 1, served, title),
        capture(3, "revisit", front, 2, again, F.lit(None)),
    )
    return pages.select(F.explode(rows).alias("c")).select("c.*")


def _canonical_sql(url: str) -> str:
    plain = f"regexp_replace(trim({url}), '#.*$', '')"
    start = "^[A-Za-z][A-Za-z0-9+.-]*://"
    scheme = f"lower(regexp_extract({plain}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
    host = f"regexp_replace(lower(regexp_extract({plain}, '{start}([^/?]*)', 1)), '^.*@', '')"
    host = f"CASE {scheme} WHEN 'http' THEN regexp_replace({host}, ':80$', '') WHEN 'https' THEN regexp_replace({host}, ':443$', '') ELSE {host} END"
    path = f"regexp_extract({plain}, '{start}[^/?]*([^?]*)', 1)"
    kept = f"list_sort(list_filter(string_split(regexp_extract({plain}, '^[^?]*\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_')))"
    query = f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"
    return f"CASE WHEN {scheme} = '' THEN {plain} ELSE {scheme} || '://' || {host} || (CASE {path} WHEN '' THEN '/' ELSE {path} END) || {query} END"


OP9_SQL = f"""
WITH p AS (SELECT page_id, url, html, md5(coalesce(html, '')) AS etag, 'day ' || (page_id // 7) AS day, page_id % 4 AS turn,
                  regexp_extract(url, '^([a-z]+://[^/]*)', 1) || '/' AS front FROM pages),
c AS (SELECT page_id * 4 AS capture_id, 'response' AS kind, url, page_id * 60 AS ts, html AS payload, * EXCLUDE (url) FROM p
  UNION ALL SELECT page_id * 4 + 1, 'revisit', url, page_id * 60 + 100000, NULL, * EXCLUDE (url) FROM p
  UNION ALL SELECT page_id * 4 + 2, 'response', front, page_id * 60 + 1, regexp_extract(html, '<title>(.*?)</title>', 1), * EXCLUDE (url) FROM p
  UNION ALL SELECT page_id * 4 + 3, 'revisit', front, page_id * 60 + 2, NULL, * EXCLUDE (url) FROM p),
k AS (SELECT *, {_canonical_sql("url")} AS canonical FROM c),
n AS (SELECT *, row_number() OVER (ORDER BY ts, capture_id) AS place FROM k),
l AS (SELECT *, max(CASE WHEN payload IS NOT NULL THEN place END) OVER (PARTITION BY canonical ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_ FROM n),
j AS (SELECT r.capture_id, r.canonical AS url, r.ts, r.turn, r.page_id, r.day, r.etag, s.capture_id AS response_id, s.etag AS s_etag, s.day AS s_day,
             s.page_id AS s_page, s.payload AS s_payload
      FROM l r LEFT JOIN n s ON s.place = r.last_ WHERE r.kind = 'revisit'),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN turn = 0 THEN CASE WHEN etag = s_etag THEN 'resolved' ELSE 'mismatch' END
                     WHEN turn = 1 THEN CASE WHEN day = s_day THEN 'resolved' ELSE 'mismatch' END WHEN turn = 2 THEN 'mismatch' ELSE 'unchecked' END AS outcome FROM j)
SELECT capture_id, url, ts, outcome, response_id,
       CASE WHEN outcome = 'resolved' THEN sha256(s_payload) END AS payload_sha256,
       array_to_string(list_sort(list_filter(CASE WHEN outcome = 'resolved'
         THEN ['content-type=text/html', 'date=' || (page_id + 1000), 'etag=' || CASE WHEN turn = 0 THEN 'W/' || etag ELSE s_etag END, 'last-modified=' || s_day]
         ELSE ['content-type=text/plain', 'date=' || (page_id + 1000), 'etag=' || CASE turn WHEN 0 THEN 'W/' || etag WHEN 2 THEN 'other' END,
               'last-modified=' || CASE turn WHEN 1 THEN day END] END, lambda x: x IS NOT NULL)), ';') AS headers
FROM o"""


@query("op9_revisits", OP9_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    listed = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return revisits.resolve(web_captures(spark, sf)).select(
        "capture_id",
        "url",
        "ts",
        "outcome",
        "response_id",
        F.sha2("payload", 256).alias("payload_sha256"),
        F.array_join(listed, ";").alias("headers"),
    )


# --- 10: n-gram Jaccard join ---------------------------------------------------------


def _links_sql(text: str, limit: tuple[int, int]) -> str:
    """Common table expressions: n (doc_id, n), links (x, y) both ways, reach (doc_id, other)."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({text}, '{WORD_SQL}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE {limit[1]} * c >= {limit[0]} * (a.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)"""


OP10_SQL = rf"""{_links_sql("coalesce(text, '')", jaccard.SIMILAR)}
SELECT r.doc_id, min(r.other) AS class_id, (SELECT count(*) FROM links l WHERE l.x = r.doc_id) AS n_links FROM reach r GROUP BY r.doc_id"""


@query("op10_jaccard", OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents")).select("doc_id", "class_id", "n_links")


# --- 11: conversation prefix trie -------------------------------------------------------

#: turns taken over from another conversation: the checksum of the id modulo so many
SHARED = 9


def crc32_sql(number: str) -> str:
    """CRC-32 of a number's decimal digits, four bits at a time."""
    table = list(range(16))
    for _ in range(4):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]

    def step(c: str, b: str) -> str:
        return f"xor({table}[CAST(xor({c}, {b}) & 15 AS BIGINT) + 1], {c} >> 4)"

    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda c, b: {step(step('c', 'b'), '(b >> 4)')}, 4294967295), 4294967295)"


OP11_SQL = f"""
WITH rows AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS donor, {crc32_sql("conv_id")} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM rows)),
rebuilt AS (SELECT d.conv_id, 0 AS part, r.i, r.role, r.text FROM ids d JOIN rows r ON r.conv_id = d.donor AND r.i <= d.h
            UNION ALL SELECT d.conv_id, 1, r.i, r.role, r.text FROM ids d JOIN rows r ON r.conv_id = d.conv_id AND r.i > d.h),
numbered AS (SELECT conv_id, row_number() OVER w AS d, text,
                    string_agg(md5(strlen(role) || ':' || role || text), '' ORDER BY part, i) OVER (PARTITION BY conv_id ORDER BY part, i ROWS UNBOUNDED PRECEDING) AS prefix
             FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
p AS (SELECT conv_id, d, md5(prefix) AS node, strlen(text) AS bytes FROM numbered UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
sizes AS (SELECT conv_id, max(d) AS size FROM p GROUP BY conv_id),
up AS (SELECT a.conv_id, a.d, a.node, a.bytes, b.node AS parent, s.size FROM p a JOIN sizes s USING (conv_id) LEFT JOIN p b ON b.conv_id = a.conv_id AND b.d = a.d - 1),
nodes AS (SELECT node, any_value(parent) AS parent, any_value(d) AS d, any_value(bytes) AS bytes, count(*) AS n, min(conv_id) AS conv_id,
                 string_agg(CASE WHEN d = size THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM up GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT v.*, coalesce(c.n, 0) AS n_children, (v.n - 1) * v.bytes AS saved FROM nodes v LEFT JOIN children c ON c.node = v.node),
below AS (SELECT p.node, sum(u.saved) AS saved, sum((u.n_children = 0)::INT) AS leaves FROM p JOIN own u ON u.conv_id = p.conv_id AND u.d >= p.d GROUP BY p.node)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, w.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM own v JOIN below b ON b.node = v.node LEFT JOIN nodes w ON w.node = v.parent"""


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation begun with the first turns of the one at the last multiple of five, as (conv_id, turns)."""
    ids = turns.withColumns(
        {
            "_donor": F.col("conv_id") - F.col("conv_id") % 5,
            "_h": F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED, F.lit(0)).cast("int"),
        }
    )
    donors = turns.filter(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("_donor"), F.slice("turns", 1, SHARED - 1).alias("_first"))
    begun = F.when(F.col("_first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_first", F.lit(1), F.col("_h")))
    own = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return ids.join(donors, "_donor", "left").select("conv_id", F.concat(begun, own).alias("turns"))


@query("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    turns = scaling.materialize(prefix_trie.listed(table(spark, sf, "conversations")), "turns")
    return prefix_trie.trie(rebuilt(turns)).drop("key")


# --- 12: periodic runs --------------------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by the checksum of the id, the words repeat from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(words.WORD), F.lit(0))).alias("w")
    )
    n = F.size("w")
    found = found.withColumn("a", F.when(n > 0, F.expr("g % size(w)")))
    period = F.expr("1 + (size(w) - a) div (3 + g % 8)")
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i).cast("int")))
    return found.withColumn("p", period).select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.find(with_planted_runs(table(spark, sf, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda x, y: x.isNull() | (y["length"] * x["period"] > x["length"] * y["period"])
    best = F.aggregate("runs", none, lambda x, y: F.when(better(x, y), y).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# --- 13: near duplicates --------------------------------------------------------------------

OP13_SQL = rf"""{_links_sql("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", near_dedup.SIMILAR)}
SELECT r.doc_id, any_value(n.n) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


@query("op13_near_dedup", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.grouped(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
