"""Plans and layouts: early limits, pruned scans, results independent of partitions."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle import _rows

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_rows_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["merge_chunks"](spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["page_profile"](spark, SF))
    assert "text" not in "".join(re.findall(r"ReadSchema: struct<[^>]*>", text))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    pushed = "".join(re.findall(r"PushedFilters: \[.*", plan(QUERIES["scope_filter"](spark, SF))))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f in pushed for f in ("In(o_orderpriority", "EqualTo(o_orderstatus", "GreaterThanOrEqual(o_orderdate"))


@pytest.mark.parametrize(
    "name",
    ["audit_report", "content_duplicates", "splice_recovered", "stratified_sample", "failure_streaks_run", "size_stats",
     "redo_chunks", "lookup_first"],
)
def test_one_and_many_partitions_agree(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = QUERIES[name](spark, SF)
            results.append(_rows(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_texts_are_cleaned_once_and_written(spark):
    cleaned = QUERIES["clean_records"](spark, SF)
    # what cleans a summary is behind a written table, not in each of the plans that read it
    text = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in text and "regexp_extract" not in text
