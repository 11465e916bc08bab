"""Order and statistics stay exact when one key holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from catalogproof.operators import pages, scaling


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("spread", [1, 1000, 1 << 22, 1 << 50])
def test_number_within_dense_and_sparse_keys(spark, spread):
    rng = random.Random(spread)
    keys = sorted({rng.randrange(8000) * spread + rng.randrange(spread) for _ in range(3000)})
    rows = [("hot" if i % 5 else None, k) for i, k in enumerate(keys)]
    got = {
        (r["g"], r["k"]): r["n"]
        for r in scaling.number_within(_frame(spark, rows, "g string, k long"), ["g"], "k", "n").collect()
    }
    seen = {}
    for g, k in rows:
        seen[g] = seen.get(g, 0) + 1
        assert got[(g, k)] == seen[g]
    assert len(got) == len(rows)


def test_running_maximum_over_one_sequence(spark):
    rng = random.Random(3)
    rows = [(k * 700, rng.choice([None, k])) for k in range(4000)]
    out = scaling.running(_frame(spark, rows, "k long, v long"), [], "k", {"m": ("max", F.col("v"))})
    got = {r["k"]: r["m"] for r in out.collect()}
    top = None
    for k, v in rows:
        top = v if v is not None else top
        assert got[k] == top


def test_global_rank_with_weights(spark):
    rows = [(f"{i * 7919 % 1000:04d}", i % 3 + 1) for i in range(1000)]
    got = sorted(
        (r["v"], r["w"], r["upto"])
        for r in scaling.global_rank(_frame(spark, rows, "v string, w long"), ["v"], "upto", "w").collect()
    )
    total = 0
    for (v, w), (gv, _, upto) in zip(sorted(rows), got):
        total += w
        assert (v, total) == (gv, upto)


@pytest.mark.parametrize("hot_rows", [2, 50, 10**6])
def test_attach_stats_and_lookup_do_not_depend_on_what_is_hot(spark, hot_rows):
    keys = ["hot"] * 400 + [f"k{i % 90}" for i in range(200)] + [None] * 100
    df = _frame(spark, list(enumerate(keys)), "i long, key string")
    stats = df.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    attached = scaling.attach_stats(df, stats, ["key"], "n", "i", hot_rows).collect()
    expected = {k: (keys.count(k) if k and keys.count(k) > 1 else None) for k in set(keys)}
    assert len(attached) == len(keys)
    assert all(r["n"] == expected[r["key"]] for r in attached)

    right = _frame(spark, [("hot", "H"), ("k1", None), ("k2", "two"), ("none", "x")], "key string, val string")
    found = scaling.lookup(df, right, ["key"], "i", hot_rows).collect()
    values = {"hot": "H", "k2": "two"}
    assert len(found) == len(keys)
    assert all(r["val"] == values.get(r["key"]) for r in found)


@pytest.fixture
def plain_shuffles(spark):
    """Sixteen partitions, as the plan says, and no broadcast that is not asked for."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("width", [100, 10_000])
@pytest.mark.parametrize("how", ["lookup", "attach_stats", "join_dimension"])
def test_hot_keys_are_split_whatever_their_width(spark, plain_shuffles, monkeypatch, how, width):
    """A key of three quarters of the rows: no partition gets a quarter of them, and both keys are in the exchange."""
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, F.lit(-1)).otherwise(F.col("id")).cast("bigint").alias("key"))
    right = df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("wide", F.repeat(F.lit("x"), width))
    if how == "lookup":
        out = scaling.lookup(df, right, ["key"], "id", 100)
    elif how == "attach_stats":
        out = scaling.attach_stats(df, right, ["key"], "n", "id", 100)
    else:
        monkeypatch.setattr(scaling, "HOT_ROWS", 100)
        out = scaling.join_dimension(df, right, ["key"], "id", 10)
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) <= 750
    assert out.filter(F.col("n") == F.when(F.col("key") < 0, 3000).otherwise(1)).count() == 4000
    joins = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if "SortMergeJoin" in x]
    assert any("key" in x and "_second" in x for x in joins)
    shuffles = [x for x in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert any("key#" in x and "_second#" in x for x in shuffles) and any("_right_key#" in x and "_right_second#" in x for x in shuffles)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_explode_range_blocks(spark, block):
    df = _frame(spark, [("a", 1, 30), ("b", 5, 5), ("c", 3, 2)], "g string, lo long, hi long")
    out = scaling.explode_range(df, F.col("lo"), F.col("hi"), "p", ["g"], block)
    assert sorted((r["g"], r["p"]) for r in out.collect()) == [("a", p) for p in range(1, 31)] + [("b", 5)]


def test_join_dimension_small_and_large(spark):
    df = spark.range(100).withColumn("c", (F.col("id") % 7).cast("string"))
    dim = _frame(spark, [(str(i), f"name{i}") for i in range(5)], "c string, name string")
    for limit in (100, 2):
        rows = scaling.join_dimension(df, dim, ["c"], "id", limit).collect()
        assert len(rows) == 100
        assert all(r["name"] == (f"name{r['c']}" if int(r["c"]) < 5 else None) for r in rows)


@pytest.mark.parametrize("cut", [8, 10])
@pytest.mark.parametrize("bounded", [True, False])
def test_failure_streaks_against_a_plain_loop(spark, cut, bounded):
    rng = random.Random(cut)
    rows, expected = [], {}
    for chunk in range(40):
        streak, gone = 0, False
        for i in range(25):
            bad = rng.random() < 0.85
            rows.append((chunk, chunk * 25 + i, bad))
            streak = streak + 1 if bad else 0
            expected[chunk * 25 + i] = (streak, gone)
            gone = gone or streak == cut
    out = pages.failure_streaks(_frame(spark, rows, "c long, k long, bad boolean"), ["c"], "k", "bad", cut, bounded)
    assert {r["k"]: (r["streak"], r["written_off"]) for r in out.collect()} == expected
    assert any(gone for _, gone in expected.values())


def test_lookup_spreads_a_hot_key_that_the_table_does_not_have(spark):
    df = spark.range(2000).select(F.col("id").alias("i"), F.when(F.col("id") < 1900, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    right = spark.createDataFrame([(str(k), k) for k in range(1900, 1950)], "key string, v int")
    out = scaling.lookup(df, right, ["key"], "i", 100)
    assert out.count() == 2000
    assert out.filter("v IS NOT NULL").count() == 50
    assert out.filter("key = 'hot' AND v IS NULL").count() == 1900


def test_few_rows_of_many_characters_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scaling, "BROADCAST_CHARS", 1000)
    assert scaling.counted_few(spark.range(10))
    assert not scaling.counted_few(spark.range(10).select(F.repeat(F.lit("x"), 200).alias("x")))


def test_hot_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(scaling, "HOT_KEYS", 3)
    stats = spark.range(50).select("id", F.lit(10**6).alias("n"), F.col("id").alias("v"))
    assert scaling._hottest(stats, ["id"], "n", 1).count() == 3
    assert scaling._hottest(stats, ["id"], "n", 1).agg(F.max("_copies")).first()[0] == scaling.MOST_COPIES
    found = scaling.attach_stats(spark.range(50).withColumn("s", F.col("id")), stats, ["id"], "n", "s", 1)
    assert found.filter("v = id").count() == 50
