"""Listing page -> one row per panel with a document link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogproof import fixed_values as fx
from catalogproof.functions import html as hx
from catalogproof.functions import text as tx

_FIELDS = list(fx.PAYLOAD_FIELDS.values())


def explode_panels(
    pages: DataFrame, html: str = "html", layout: hx.PanelLayout = hx.PanelLayout()
) -> DataFrame:
    """One row per panel that has a link: ``panel_no``, ``panel``, ``href``, ``link_id``.

    Panels are numbered from 0 over all panels of the page; those without a link
    are dropped.  The page's other columns are kept.
    """
    keep = [c for c in pages.columns if c != html]
    # outer: the filters that Spark puts before a plain explode would cut each page twice more
    parts = pages.select(*keep, F.posexplode_outer(hx.panels(F.col(html), layout)).alias("panel_no", "panel"))
    href = tx.blank_to_null(F.regexp_extract("panel", layout.link, 1))
    return (
        parts.withColumn("href", hx.unescape(href))
        .withColumn("link_id", tx.blank_to_null(F.regexp_extract("href", layout.link_id, 1)))
        .filter(F.col("link_id").isNotNull())
    )


def read_panels(panels: DataFrame, layout: hx.PanelLayout = hx.PanelLayout()) -> DataFrame:
    """Fields of each panel: from its payload, or from its visible labels.

    The link's id is the row's identity.  A payload without id, or with another id,
    is not trusted: the visible labels serve and ``provenance`` says so.
    """
    keep = [c for c in panels.columns if c != "panel"]
    onclick = tx.blank_to_null(F.regexp_extract("panel", layout.onclick, 1))
    read = (
        panels.withColumn("_payload", hx.payload(onclick))
        .withColumn("_labels", hx.label_fields(F.col("panel")))
        .withColumn("_header", hx.panel_header(F.col("panel")))
        .withColumn("_sheet", F.col("_payload")["uuid"])
    )
    mismatch = F.coalesce(F.col("_sheet") != F.col("link_id"), F.lit(False))
    trusted = F.coalesce(F.map_contains_key("_payload", F.lit("uuid")), F.lit(False)) & ~mismatch

    def field(key: str, name: str):
        visible = F.col("_labels")[name]
        if name in ("case_type", "case_no"):
            position = ("case_type", "case_no").index(name)
            visible = F.when(F.size("_header") >= 2, F.get("_header", F.lit(position)))
        from_payload = tx.strip(F.coalesce(F.col("_payload")[key], F.lit("")))
        return F.when(trusted, from_payload).otherwise(F.coalesce(visible, F.lit(""))).alias(name)

    return read.select(
        *keep,
        *[field(key, name) for key, name in fx.PAYLOAD_FIELDS.items()],
        F.when(trusted, F.lit(fx.FROM_PAYLOAD))
        .when(mismatch, F.lit(fx.FROM_LABELS_MISMATCH))
        .otherwise(F.lit(fx.FROM_LABELS))
        .alias("provenance"),
        F.when(mismatch, F.col("_sheet")).alias("sheet_id"),
    )


def reconcile_panels(
    pages: DataFrame,
    key: list[str],
    html: str = "html",
    layout: hx.PanelLayout = hx.PanelLayout(),
) -> DataFrame:
    """Per page: panels shown against panels that parse to a row, both counted in place."""
    href = hx.panels(F.col(html), layout)
    parsed = F.size(F.filter(href, lambda p: p.rlike(layout.link)))
    return pages.select(
        *key,
        hx.panels_shown(F.col(html), layout).cast("bigint").alias("n_shown"),
        parsed.cast("bigint").alias("n_parsed"),
    ).withColumn("agrees", F.col("n_shown") == F.col("n_parsed"))
