"""Not-modified revisits of a web archive, resolved to the full response they repeat.

Captures are rows (capture_id, kind, url, ts, status, headers, payload); kind is ``response`` or
``revisit``.  A revisit belongs to the latest earlier full response (status 200, a payload, a time) of
the same canonical URL; earlier means by (ts, capture_id).  It is resolved only if a validator says
that nothing changed: equal ETags, compared weakly, or where one side has none equal Last-Modified dates.
Then the result has the response's payload, and its headers with those of the revisit put in
that a 304 answer may update.

The as-of join is a running maximum: all captures get their place in one order over (ts, capture_id), by range
partitions, and the place of the last full response is carried along each URL in windows of bounded size,
so a URL may hold a third of all captures.  Only ids and validators take part; payloads are joined at the end.

``outcome`` is ``resolved``, ``mismatch`` (a validator differs), ``unchecked`` (no validator on both sides) or
``missing`` (no earlier response, or no url or ts).  Unresolved revisits keep their own headers and a null payload.
Header names are lower-cased; of names that then are equal the first counts; null headers are none.  capture_id
must be unique where ts is equal; repeated captures are resolved each on its own.  Columns other than those named
are dropped, so none can clash.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogproof.operators import scaling

#: what a 304 answer may update; all else stays as the full response had it
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
DEFAULT_PORTS = {"http": "80", "https": "443"}
TRACKING = "utm_"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no user, default port or fragment, parameters sorted, tracking ones gone."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), "^.*@", "")
    for name, port in DEFAULT_PORTS.items():
        host = F.when(scheme == name, F.regexp_replace(host, f":{port}$", "")).otherwise(host)
    path = F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    parameters = F.split(F.regexp_extract(plain, r"^[^?]*\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(parameters, lambda p: (p != "") & ~p.startswith(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    full = F.concat(scheme, F.lit("://"), host, F.when(path == "", F.lit("/")).otherwise(path), query)
    return F.when(scheme == "", plain).otherwise(full)


def lower_names(headers: Column) -> Column:
    """The headers by lower-cased name."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    first = F.transform(names, lambda n: F.get(F.filter(entries, lambda e: F.lower(e["key"]) == n), F.lit(0))["value"])
    return F.map_from_arrays(names, first)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^[Ww]/", "")


def merge_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by those of the revisit that may."""
    allowed = F.map_filter(revisit, lambda k, v: k.isin(PERMITTED))
    return F.map_concat(F.map_filter(response, lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False))), allowed)


def resolve(captures: DataFrame) -> DataFrame:
    """One row per revisit: capture_id, url (canonical), ts, outcome, response_id, headers, payload."""
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("payload").isNotNull()
    keyed = captures.select(
        "capture_id",
        canonical_url(F.col("url")).alias("url"),
        F.col("ts").cast("bigint").alias("ts"),
        (F.col("kind") == "revisit").alias("_revisit"),
        F.coalesce(full, F.lit(False)).alias("_full"),
        lower_names(F.col("headers")).alias("headers"),
    )
    keyed = scaling.materialize(keyed.filter("_revisit OR _full"), "captures")
    dated = keyed.filter("url IS NOT NULL AND ts IS NOT NULL")
    numbered = scaling.global_rank(dated.select("capture_id", "url", "ts", "_full", "_revisit"), ["ts", "capture_id"], "_place")
    numbered = scaling.materialize(numbered, "places")
    carried = scaling.running(numbered, ["url"], "_place", {"_last": ("max", F.when(F.col("_full"), F.col("_place")))})
    asked = carried.filter("_revisit").select("capture_id", "ts", "_last")
    known = numbered.filter("_full").select(F.col("_place").alias("_last"), F.col("capture_id").alias("response_id"), F.col("ts").alias("_at"))
    latest = scaling.lookup(scaling.materialize(asked, "asked"), known, ["_last"], "capture_id").drop("_last")

    stored = keyed.filter("_full").select(
        F.col("capture_id").alias("response_id"), F.col("ts").alias("_at"), F.col("headers").alias("_stored")
    )
    found = keyed.filter("_revisit").drop("_revisit", "_full").join(
        latest.withColumnRenamed("ts", "_ts").withColumnRenamed("capture_id", "_id"),
        F.col("capture_id").eqNullSafe(F.col("_id")) & F.col("ts").eqNullSafe(F.col("_ts")),
        "left",
    ).drop("_id", "_ts")
    # repeated captures: one of equal ids and times stands for all
    stored = stored.dropDuplicates(["response_id", "_at"])
    checked = scaling.lookup(scaling.materialize(found, "found"), stored, ["response_id", "_at"], "capture_id")
    etags = [_weak(F.col(c)["etag"]) for c in ("headers", "_stored")]
    dates = [F.trim(F.col(c)["last-modified"]) for c in ("headers", "_stored")]
    same = F.coalesce(etags[0] == etags[1], dates[0] == dates[1])
    outcome = (
        F.when(F.col("_stored").isNull(), "missing").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch")
    )
    judged = scaling.materialize(
        checked.withColumn("outcome", outcome).select(
            "capture_id",
            "url",
            "ts",
            "outcome",
            "response_id",
            "_at",
            F.when(F.col("outcome") == "resolved", merge_headers(F.col("_stored"), F.col("headers")))
            .otherwise(F.col("headers"))
            .alias("headers"),
            F.when(F.col("outcome") == "resolved", F.col("response_id")).alias("_from"),
        ),
        "judged",
    )
    payloads = captures.filter(full).select(F.col("capture_id").alias("_from"), F.col("ts").cast("bigint").alias("_at"), "payload")
    payloads = payloads.dropDuplicates(["_from", "_at"])
    return scaling.lookup(judged, payloads, ["_from", "_at"], "capture_id").drop("_from", "_at")
