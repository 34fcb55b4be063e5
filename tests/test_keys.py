"""Bucketed dense keys equal a global row_number; first-per-key equals the
window formulation."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.operators.keys import dense_key, first_per_key, range_index
from martforge.sources.fixture import read_driver_table


@pytest.mark.parametrize("buckets", [1, 3, 8, 64])
def test_dense_key_equals_global_row_number(spark, sf_dir, buckets):
    o = read_driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    got = dense_key(o, "sk", ["o_orderkey"], buckets=buckets)
    want = o.withColumn("sk", F.row_number().over(Window.orderBy("o_orderkey")))
    assert sorted(got.select("sk", "o_orderkey").collect()) == sorted(
        want.select("sk", "o_orderkey").collect())


def test_dense_key_with_leading_columns_and_dates(spark, sf_dir):
    o = read_driver_table(spark, sf_dir, "orders").select(
        "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    got = dense_key(o, "sk", ["o_orderpriority", "o_orderkey"], buckets=5)
    want = o.withColumn("sk", F.row_number().over(Window.orderBy("o_orderpriority", "o_orderkey")))
    assert sorted(got.select("sk", "o_orderkey").collect()) == sorted(
        want.select("sk", "o_orderkey").collect())
    days = o.select("d").distinct()
    got_d = dense_key(days, "sk", ["d"], buckets=4)
    want_d = days.withColumn("sk", F.row_number().over(Window.orderBy("d")))
    assert sorted(got_d.collect()) == sorted(want_d.select("sk", "d").collect())


def test_dense_key_keys_are_one_to_n(spark, sf_dir):
    c = read_driver_table(spark, sf_dir, "customer").select("c_custkey")
    keys = [r["sk"] for r in dense_key(c, "sk", ["c_custkey"], buckets=7).collect()]
    assert sorted(keys) == list(range(1, c.count() + 1))


def test_range_index_counts_boundaries(spark):
    df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 1.5, 2.0, 9.0)], "x double")
    got = [r["b"] for r in df.select(range_index(F.col("x"), [0.0, 2.0, 5.0]).alias("b")).collect()]
    assert got == [-1, 0, 1, 1, 2, 3]


def test_first_per_key_matches_window(spark, sf_dir):
    li = read_driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    got = first_per_key(li, "l_orderkey", ["l_partkey", "l_suppkey"])
    w = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_quantity")
    want = li.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(want.collect())


def test_text_keys_are_numbered_in_many_ranges(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(0)
    names = sorted({f"Customer#{rng.randrange(10**6):06d}{rng.choice(['', 'é', 'z'])}" for _ in range(500)}) + [None]
    df = spark.createDataFrame([(n,) for n in names], "c_name string").repartition(4)
    out = dense_key(df, "sk", ["c_name"], buckets=16)
    got = [r.c_name for r in out.orderBy("sk").collect()]
    assert got == [None, *sorted(names[:-1], key=str.encode)]
    window = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "row_number" in x]
    assert window and all("_rng" in x for x in window)
    ranges = out.select(F.col("sk")).count()
    assert ranges == len(names)


def test_more_ranges_than_boundaries_keep_the_order(spark):
    from martforge.operators import keys as KEYS
    from pyspark.sql import functions as F

    df = spark.range(0, 3000).select((F.col("id") * F.col("id")).alias("k"))
    out = dense_key(df, "sk", ["k"], buckets=3 * KEYS.TREE)
    rows = out.orderBy("k").collect()
    assert [r.sk for r in rows] == list(range(1, 3001))


@pytest.mark.parametrize(("buckets", "tree"), [(16, 512), (24, 8)])  # with more ranges than boundaries, too
def test_one_odd_text_does_not_put_the_others_in_one_range(spark, monkeypatch, buckets, tree):
    from martforge.operators import keys as KEYS

    ranges = []
    monkeypatch.setattr(KEYS, "TREE", tree)
    monkeypatch.setattr(KEYS, "range_index", lambda *a: ranges.append(range_index(*a)) or ranges[-1])
    names = [None, "", "Aé", "zz", *(f"Customer#{i:09d}" for i in range(3000)), "Customer#000000007é"]
    df = spark.createDataFrame([(n,) for n in names], "c_name string").repartition(4)
    out = dense_key(df, "sk", ["c_name"], buckets=buckets)
    assert [r.c_name for r in out.orderBy("sk").collect()] == [None, *sorted(names[1:], key=str.encode)]
    assert [r.sk for r in out.orderBy("sk").collect()] == list(range(1, len(names) + 1))
    sizes = [r["count"] for r in df.groupBy(ranges[0].alias("r")).count().collect()]
    assert max(sizes) < 3 * len(names) / buckets and len(sizes) >= buckets
