"""W1 / W2 in their split-bucket form equal the plain per-category windows."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from noisyframe.operators import features as FE


def _frame(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(800):
        c = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        t = None if rnd.random() < 0.05 else f"2024-01-{rnd.randint(1, 9):02d} {rnd.randint(0, 3):02d}:00:00"
        rows.append((i, c, t))
    df = spark.createDataFrame(rows, "row_id long, c_1 string, t string")
    return df.select("row_id", "c_1", F.col("t").cast("timestamp_ntz").alias("t_1"))


def test_running_count_matches_window(spark):
    df = _frame(spark)
    w = Window.partitionBy("c_1").orderBy(F.col("t_1").asc_nulls_last(), "row_id")
    want = {r.row_id: (r.rn - 1 if r.c_1 is not None else None)
            for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    got = {r.row_id: r["n_CatCumCnt:c_1"] for r in FE.cat_running_count(df, ["c_1"], "t_1").collect()}
    assert got == want


def test_time_gap_matches_lag(spark):
    df = _frame(spark)
    w = Window.partitionBy("c_1").orderBy(F.col("t_1").asc_nulls_last(), "row_id")
    us = F.unix_micros(F.col("t_1").cast("timestamp"))
    ref = df.withColumn("g", (us - F.lag(us).over(w)) / 1e6)
    want = {r.row_id: (r.g if r.c_1 is not None else None) for r in ref.collect()}
    out = FE.cat_time_gap(df, ["c_1"], "t_1")
    got = {r.row_id: r["n_CatTimeDiff2LEVEL:c_1_t_1_diff:1"] for r in out.collect()}
    assert got == want


def _skewed(spark, rows=600):
    """A hot value, rare values, nulls, equal and missing times, and a row without an id."""
    rnd = random.Random(5)
    made = [(None if i == 7 else i, "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), str(rnd.randint(0, 150)),
             None if rnd.random() < 0.05 else f"2024-01-{rnd.randint(1, 9):02d} 00:00:00") for i in range(rows)]
    df = spark.createDataFrame(made, "row_id long, c_1 string, c_2 string, t string")
    return df.select("row_id", "c_1", "c_2", F.col("t").cast("timestamp_ntz").alias("t_1"))


def test_windows_of_hot_and_rare_values_without_unpivoting(spark):
    """both ways at once, a split column and one of small values; the rows are not unpivoted."""
    df = _skewed(spark)
    order = [F.col("t_1").asc_nulls_last(), F.col("row_id")]
    us = F.unix_micros(F.col("t_1").cast("timestamp"))
    ref = df
    for c in ("c_1", "c_2"):
        w, there = Window.partitionBy(c).orderBy(*order), F.col(c).isNotNull() & F.col("row_id").isNotNull()
        ref = ref.withColumn(f"run_{c}", F.when(there, F.row_number().over(w) - 1)).withColumn(
            f"gap_{c}", F.when(there, (us - F.lag(us).over(w)) / 1e6))
    runs, gaps = FE.cat_running_count(df, ["c_1", "c_2"], "t_1"), FE.cat_time_gap(df, ["c_1", "c_2"], "t_1")
    for out, kind, names in ((runs, "run", [f"n_CatCumCnt:{c}" for c in ("c_1", "c_2")]),
                             (gaps, "gap", [f"n_CatTimeDiff2LEVEL:{c}_t_1_diff:1" for c in ("c_1", "c_2")])):
        assert out.columns == ["row_id", "c_1", "c_2", "t_1", *names]
        assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r[0]: (r[1], r[2]) for r in out.select("row_id", *[F.col(f"`{n}`") for n in names]).collect()}
        assert len(got) == 600
        assert got == {r[0]: (r[1], r[2]) for r in ref.select("row_id", f"{kind}_c_1", f"{kind}_c_2").collect()}


def test_windows_join_back_once_where_rows_are_wide(spark):
    """a row without an id counts for the others, whether the other columns travel along or stay behind."""
    df = _skewed(spark)
    wide = df.withColumns({f"n_{i}": F.lit(float(i)) for i in range(8)})
    for make in (FE.cat_running_count, FE.cat_time_gap):
        a, b = make(df, ["c_1", "c_2"], "t_1"), make(wide, ["c_1", "c_2"], "t_1")
        assert b.columns == ["row_id", "c_1", "c_2", "t_1", *(f"n_{i}" for i in range(8)), *a.columns[4:]]
        assert sorted(map(str, b.drop(*(f"n_{i}" for i in range(8))).collect())) == sorted(map(str, a.collect()))


def test_codes_from_one_value_table(spark):
    """blocks, dictionary and codes come from one table of values, with the same codes as one by one."""
    df = _skewed(spark).withColumn("c_3", F.col("c_2"))
    cats = ["c_1", "c_2", "c_3"]
    encoder, coded = FE.encode_blocks(df, cats)
    plain = FE.BlockEncoder().fit(df, FE.cat_blocks(df, cats))
    assert encoder.blocks == plain.blocks and len(set(plain.blocks.values())) == 2
    assert sorted(map(str, encoder.dictionary.collect())) == sorted(map(str, plain.dictionary.collect()))
    assert sorted(map(str, coded.collect())) == sorted(map(str, plain.transform(df, append=False).collect()))
