"""One spelling per category: the most frequent one under a folded key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.functions import text as tx
from catalogproof.operators import scaling


def canonical_forms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, key, canonical, n): for all columns in one pass over ``df``.

    Ties go to the smallest spelling.  Spellings are counted before any ranking, so
    the ranking sees distinct spellings only.
    """
    spelled = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), tx.clean_text(F.col(c)).alias("value")) for c in columns])
        ).alias("s")
    ).select("s.*")
    counted = (
        spelled.filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_value"))
        .withColumn("key", tx.category_key(F.col("value")))
    )
    best = W.partitionBy("column", "key").orderBy(F.desc("n_value"), F.asc("value"))
    chosen = counted.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1")
    totals = counted.groupBy("column", "key").agg(F.sum("n_value").alias("n"))
    return chosen.join(totals, ["column", "key"]).select(
        "column", "key", F.col("value").alias("canonical"), "n"
    )


def canonicalize(df: DataFrame, columns: list[str], spread: str, forms: DataFrame | None = None) -> DataFrame:
    """Replace each column by the canonical spelling of its key; null stays null.

    The forms are written once.  They are broadcast only after their number was
    counted; a larger table joins by key with its frequent keys split off.
    """
    if forms is None:
        forms = scaling.materialize(canonical_forms(df, columns), "canonical")
    small = scaling.counted_few(forms)
    out = df
    for c in columns:
        own = forms.filter(F.col("column") == c).select(
            F.col("key").alias("_key"), F.col("canonical").alias("_form"), F.col("n").alias("_n")
        )
        keyed = out.withColumn("_key", tx.category_key(tx.clean_text(F.col(c))))
        if small:
            joined = keyed.join(F.broadcast(own), "_key", "left")
        else:
            joined = scaling.attach_stats(keyed, own, ["_key"], "_n", spread)
        out = joined.withColumn(c, F.col("_form")).drop("_key", "_form", "_n")
    return out.select(*df.columns)
