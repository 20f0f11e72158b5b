"""Seeds and purposes draw independently; large ids keep their bits."""
from pyspark.sql import functions as F

from noisyframe.functions.keys import seeded_key
from noisyframe.operators import labels as L
from noisyframe.operators import sampling as SM


def _ids(df):
    return {r["row_id"] for r in df.collect()}


def test_two_seeds_and_two_purposes_overlap_by_chance(spark):
    df = spark.range(20000).select(F.col("id").alias("row_id"))
    a = _ids(SM.take_smallest(df, 5000, 0))
    b = _ids(SM.take_smallest(df, 5000, 1))
    c = _ids(SM.take_smallest(df, 5000, 0, purpose="split"))
    assert len(a) == len(b) == len(c) == 5000
    for other in (b, c):      # 1250 expected
        assert 1100 < len(a & other) < 1400


def test_folds_of_two_seeds_are_independent(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("label"))
    both = L.stratified_folds(L.stratified_folds(df, 5, 0, name="a"), 5, 9, name="b")
    cells = both.groupBy("a", "b").count().collect()
    assert len(cells) == 25 and all(140 < r["count"] < 260 for r in cells)


def test_keys_of_spaced_ids_differ(spark):
    df = spark.range(4096).select((F.col("id") * 2 ** 20).alias("row_id"))
    assert df.select(seeded_key("row_id", 0).alias("k")).distinct().count() == 4096


def test_entity_sample_of_ids_above_2_53(spark):
    df = spark.range(1000).select((F.col("id") + 2 ** 61).alias("row_id"), F.col("id").cast("string").alias("c_1"))
    assert SM.entity_sample(df, "c_1").count() == 100


def test_smallest_per_class_with_ties_and_missing_classes(spark):
    rows = [(i % 50, i % 3 if i % 7 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, label int")
    got = SM.take_smallest(df, {0: 10, 1: 10 ** 6, 2: 0, 9: 5}, 0, by="label")
    sizes = {r["label"]: r["count"] for r in got.groupBy("label").count().collect()}
    assert sizes[1] == sum(1 for _, x in rows if x == 1) and sizes[0] >= 10 and set(sizes) == {0, 1}
