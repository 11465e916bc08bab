"""Exact stratified samples and size statistics of stored files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogproof.operators import scaling

SALTS = 1024


def sample_order(key: Column, seed: int) -> Column:
    """A reproducible random-like order, the same on any layout of the data."""
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def proportional_quotas(df: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, stratum_size, quota): share of ``n``, half to even, 1 at least."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("stratum_size"))
    total = sizes.agg(F.sum("stratum_size")).scalar()
    share = F.col("stratum_size") / total
    quota = F.greatest(F.bround(share * n), F.lit(1)).cast("bigint")
    return sizes.withColumn("quota", F.least(quota, F.col("stratum_size")))


def equal_quotas(df: DataFrame, stratum: str, n: int) -> DataFrame:
    """The same quota for every stratum: ``n`` divided among them, 1 at least."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("stratum_size"))
    strata = sizes.agg(F.count(F.lit(1))).scalar()
    quota = F.greatest(F.floor(F.lit(n) / strata), F.lit(1)).cast("bigint")
    return sizes.withColumn("quota", F.least(quota, F.col("stratum_size")))


def stratified_sample(df: DataFrame, quotas: DataFrame, stratum: str, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``quota`` rows of each stratum, without replacement.

    No quota exceeds ``n``, so a stratum is first cut to ``n`` rows in each of many
    salted parts and only what is left is ranked together.
    """
    ordered = df.withColumns(
        {
            "_order": sample_order(F.col(key), seed),
            "_salt": F.pmod(F.xxhash64(key), F.lit(SALTS)),
        }
    )
    rank = [F.col("_order"), F.col(key)]
    part = W.partitionBy(stratum, "_salt").orderBy(*rank)
    kept = ordered.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= n)
    whole = W.partitionBy(stratum).orderBy(*rank)
    ranked = kept.withColumn("_rn", F.row_number().over(whole))
    # only sampled rows are left to join
    return (
        ranked.filter(F.col("_rn") <= n)
        .join(quotas.select(stratum, "quota"), stratum)
        .filter(F.col("_rn") <= F.col("quota"))
        .select(*df.columns)
    )


def size_stats(df: DataFrame, size: str, population: int | None = None) -> DataFrame:
    """One row: n, mean, median, p10, p90, max, standard deviation and the 95 % interval.

    p10 and p90 are the elements at position ``int(n * q)`` of the sorted values, the
    median interpolates.  Values are counted first, then the counts are ranked in
    range partitions, so neither repeated values nor many distinct ones collect anywhere.
    The interval covers the total of ``population`` files (default: as many as measured).
    """
    values = df.filter(F.col(size).isNotNull()).groupBy(F.col(size).alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    upto = scaling.global_rank(values, ["v"], "upto", weight="c")
    exact = F.col("v").cast("decimal(38,4)")
    double = F.col("v").cast("double")
    basics = upto.agg(
        F.sum("c").alias("n"),
        (F.sum(exact * F.col("c")).cast("double") / F.sum("c")).alias("mean"),
        F.max("v").alias("max"),
    )
    n = basics.select("n").scalar()
    mean = basics.select("mean").scalar()

    def at(position: Column) -> Column:
        """Value at a 0-based position."""
        return F.max(F.when((F.col("upto") > position) & (F.col("upto") - F.col("c") <= position), F.col("v")))

    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    # tenths in whole numbers: n * 0.1 in doubles may fall just below an integer
    stats = upto.agg(
        F.sum("c").alias("n"),
        F.max(mean).alias("mean"),
        middle.alias("median"),
        at(F.floor(n / 10)).alias("p10"),
        at(F.floor(n * 9 / 10)).alias("p90"),
        F.max("v").alias("max"),
        F.sqrt(F.sum(F.col("c") * (double - mean) * (double - mean)) / F.nullif(F.sum("c") - 1, F.lit(0))).alias("stdev"),
    )
    total = F.col("n") if population is None else F.lit(population)
    error = F.coalesce(F.col("stdev"), F.lit(0.0)) / F.sqrt(F.col("n")) * 1.96
    return stats.withColumns(
        {"total_low": (F.col("mean") - error) * total, "total_high": (F.col("mean") + error) * total}
    )


def group_profile(df: DataFrame, kind: str, size: str, pages: str) -> DataFrame:
    """Per kind: files, share, mean bytes, mean pages and KB per page."""
    per = df.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(size).cast("decimal(38,4)")).alias("_bytes"),
        F.sum(F.col(pages).cast("decimal(38,4)")).alias("_pages"),
    )
    total = per.agg(F.sum("n")).scalar()
    n, size_sum, page_sum = F.col("n"), F.col("_bytes").cast("double"), F.col("_pages").cast("double")
    return per.select(
        kind,
        "n",
        (n / total).alias("share"),
        (size_sum / n).alias("mean_bytes"),
        (page_sum / n).alias("mean_pages"),
        (size_sum / 1024 / F.greatest(page_sum, F.lit(1.0))).alias("kb_per_page"),
    )


def year_profile(df: DataFrame, year: str, size: str, kind: str, scanned: str) -> DataFrame:
    """Per year: files, mean bytes, and the share of files of the kind ``scanned``; a null kind is another kind."""
    return df.groupBy(year).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(size).cast("decimal(38,4)")).cast("double").alias("mean_bytes"),
        F.avg(F.coalesce((F.col(kind) == scanned).cast("int"), F.lit(0))).alias("scanned_share"),
    )


def weighted_projection(sample: DataFrame, population: DataFrame, stratum: str, size: str, total: Column) -> DataFrame:
    """Total size projected from stratum means weighted by stratum populations.

    ``population`` holds (stratum, n_docs).  Strata without a sample fall out of the
    mean and the covered part is scaled up to ``total``.
    """
    means = sample.groupBy(stratum).agg(
        (F.sum(F.col(size).cast("decimal(38,4)")).cast("double") / F.count(size)).alias("mean_size")
    )
    both = means.join(population, stratum)
    return both.agg(
        F.sum(F.col("mean_size") * F.col("n_docs")).alias("weighted"),
        F.sum("n_docs").alias("covered"),
    ).select(
        "covered", (F.col("weighted") / F.col("covered") * total).alias("projected")
    )
