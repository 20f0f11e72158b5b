"""Exact order statistics equal plain windows and sorted lists."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from noisyframe.functions.ranking import (bucket_of, distributed_row_number, global_row_number,
                                          kth_smallest, position_bucket)


def test_bucket_of_counts_bounds(spark):
    bounds = [1.0, 2.0, 5.0]
    df = spark.createDataFrame([(x,) for x in [0.5, 1.0, 1.5, 2.0, 4.9, 5.0, 7.0, None]], "x double")
    got = [r[0] for r in df.select(bucket_of(F.col("x"), bounds)).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3, 3]
    strict = [r[0] for r in df.select(bucket_of(F.col("x"), bounds, strict=True)).collect()]
    assert strict[:7] == [0, 0, 1, 1, 2, 2, 3]


def test_kth_smallest_matches_sort_with_ties(spark):
    rnd = random.Random(3)
    rows = [(g, float(rnd.choice([0.1, 0.2, 0.2, 0.5, rnd.random()]))) for g in (0, 1) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, v double")
    ks = {0: [1, 7, 150, 300], 1: [2, 299]}
    got = kth_smallest(df, "v", ks, "g", bins=16)
    for g, want in ks.items():
        vals = sorted(v for gg, v in rows if gg == g)
        assert got[g] == [vals[k - 1] for k in want]
    assert kth_smallest(df, "v", {0: 301}, "g")[0] is None


def test_kth_smallest_keeps_large_integers_and_skewed_doubles(spark):
    ids = [2 ** 61 + 3 * i for i in range(1000)] + [-(2 ** 62), 2 ** 63 - 1, -(2 ** 63)]
    df = spark.createDataFrame([(x,) for x in ids], "v long")
    ks = [1, 2, 3, 4, 100, 500, 1002, 1003]
    assert kth_smallest(df, "v", {None: ks})[None] == [sorted(ids)[k - 1] for k in ks]
    powers = [2.0 ** -i for i in range(1000)] + [1e308, -1e308, 5e-324, float("inf")]
    df = spark.createDataFrame([(x,) for x in powers], "v double")
    ks = [1, 2, 3, 4, 500, 999, 1001, 1004]
    assert kth_smallest(df, "v", {None: ks})[None] == [sorted(powers)[k - 1] for k in ks]
    tied = [0.5] * 900 + [0.5 + 2.0 ** -i for i in range(2, 50)]
    df = spark.createDataFrame([(x,) for x in tied], "v double")
    assert kth_smallest(df, "v", {None: [900, 901, 948]}, bins=4)[None] == [sorted(tied)[k - 1] for k in (900, 901, 948)]


def test_distributed_row_number_equals_window(spark):
    rnd = random.Random(5)
    # most rows are tied in the leading column
    rows = [(i, rnd.choice(["a", "b", None]), 7 if rnd.random() < 0.9 else rnd.randint(0, 40)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, t int")
    order = [F.col("t"), F.col("id")]
    want = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(*order))).collect()}
    assert {r["id"]: r["rn"] for r in distributed_row_number(df, ["g"], order).collect()} == want
    ranked = global_row_number(df, order)
    assert [r["rn"] for r in ranked.orderBy(*order).collect()] == list(range(1, 501))
    buckets = [r[0] for r in ranked.withColumn("b", position_bucket(ranked)).groupBy("b").count().select("count").collect()]
    assert max(buckets) <= 63
    assert global_row_number(df.limit(0), order).count() == 0
