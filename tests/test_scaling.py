"""What grows with the rows: shuffles, written copies, passes, and rows of a task."""

import pytest
from pyspark.sql import functions as F

from noisyframe.functions import ranking as RK
from noisyframe.functions.keys import KEY_MODULUS, seeded_key
from noisyframe.operators import features as FE
from noisyframe.operators import labels as L
from noisyframe.operators import learn as LN
from noisyframe.operators.rates import RateClassifier
from noisyframe.plans import automl as AM


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).select(
        F.col("id").alias("row_id"), (F.col("id") % 3).cast("string").alias("c_1"),
        (F.col("id") % 1300).cast("string").alias("c_2"), (F.col("id") % 7).cast("double").alias("n_1"),
        F.when(F.col("id") % 11 == 0, 1 - (F.col("id") % 3 == 0).cast("int")).otherwise(
            (F.col("id") % 3 == 0).cast("int")).alias("label"), F.lit("wide").alias("other")).localCheckpoint()


def _rate():
    return RateClassifier(catCol="c_1")


def test_folds_neither_sample_bounds_nor_write_the_rows(spark, rows):
    df = rows.unionByName(rows.where("row_id = 0").withColumn("row_id", F.lit(None).cast("bigint")))
    folds = L.stratified_folds(df, 5, 3)
    plan = _plan(folds)
    assert "rangepartitioning" not in plan.lower().replace("_", "") and "ReadSchema: struct<row_id" not in plan
    keyed = df.withColumn("_key", seeded_key("row_id", 3, "fold"))
    rank = F.row_number().over(RK.Window.partitionBy("label").orderBy("_key", "row_id"))
    want = {r["row_id"]: r["fold"] for r in keyed.select("row_id", ((rank - 1) % 5).alias("fold")).collect()}
    assert {r["row_id"]: r["fold"] for r in folds.collect()} == want
    assert max(r["_key"] for r in keyed.where("row_id is not null").select("_key").collect()) < KEY_MODULUS


def test_errors_leave_by_a_filter_and_copies_of_an_id_go_together(spark, rows):
    res = LN.clean_labels(rows.drop("other", "c_2"), ["n_1"], estimator_factory=_rate)
    assert "Join" not in _plan(res.kept)
    errors = {r["row_id"] for r in res.errors.collect()}
    assert errors and {r["row_id"] for r in res.kept.collect()} == set(range(4000)) - errors
    marked = spark.createDataFrame([(1, True), (1, False), (2, False), (None, True), (3, None)], "row_id bigint, is_error boolean")
    assert RK.ids_repeat(marked) and not RK.ids_repeat(marked.where("row_id > 1 or row_id is null"))
    left = LN.without_errors(marked, True).collect()
    assert sorted((r["row_id"] or 0) for r in left) == [0, 2, 3]
    single = LN.without_errors(marked.where("coalesce(is_error, false) or row_id <> 1"), False).collect()
    assert sorted((r["row_id"] or 0) for r in single) == [0, 2, 3]


def test_kept_rows_have_all_columns(rows):
    res = LN.clean_labels(rows, ["n_1"], estimator_factory=_rate)
    assert res.kept.columns and set(res.kept.columns) == set(rows.columns)
    assert res.kept.count() == 4000 - res.errors.count()


def test_the_noise_estimate_is_the_first_pass_of_the_ensemble(rows, monkeypatch):
    seeds = []
    own = LN.oof_probabilities
    monkeypatch.setattr(LN, "oof_probabilities", lambda *a, **k: seeds.append((a[4], a[0].columns)) or own(*a, **k))
    AM.noisy_ensemble(rows, ["n_1"], 2, clean_rounds=1, estimator=lambda params, seed: _rate())
    assert [s for s, _ in seeds] == [0, 1, 1, 2]
    assert all("other" not in columns and "c_2" not in columns for _, columns in seeds)


def test_codes_counts_and_means_do_not_shuffle_by_a_hot_value(spark, rows):
    enc = FE.BlockEncoder().fit(rows, spark.createDataFrame([("c_1", 1), ("c_2", 1)], "col string, block int"))
    for out in (enc.transform(rows, append=False), FE.cat_count(rows, ["c_1", "c_2"]),
                FE.num_mean_by_cat(rows, ["c_1", "c_2"], ["n_1"])):
        assert "SortMergeJoin" not in _plan(out) and "Exchange hashpartitioning" not in _plan(out)
        assert out.count() == 4000


@pytest.mark.parametrize("bucket", [10 ** 6, 2])
def test_pairs_share_the_shuffle_of_a_column_unless_a_value_is_hot(spark, rows, monkeypatch, bucket):
    monkeypatch.setattr(FE, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(FE, "ROWS_PER_BUCKET", bucket)
    df = rows.withColumn("c_3", F.when(F.col("row_id") % 5 > 0, (F.col("row_id") % 9).cast("string"))).select("row_id", "c_1", "c_2", "c_3")
    out = FE.cat_pair_count(df, ["c_1", "c_2", "c_3"])
    if bucket > 2:
        assert _plan(out).count("Exchange hashpartitioning(c_2") == 1 and _plan(out).count("Join") == 0
    plain = df.collect()
    for r in out.collect():
        for a, b in (("c_1", "c_2"), ("c_1", "c_3"), ("c_2", "c_3")):
            got = r[FE.feat_name("n_", "CatCnt2LEVEL", f"{a}_{b}_cnt")]
            if r["row_id"] < 40:
                want = sum(x[a] == r[a] and x[b] == r[b] for x in plain) if r[a] is not None and r[b] is not None else None
                assert got == want


def test_ranks_over_few_values_are_counted_first(spark, monkeypatch):
    kept = []
    own = RK.cut_lineage
    monkeypatch.setattr(RK, "cut_lineage", lambda df: kept.append(own(df)) or kept[-1])
    df = spark.range(20000).select((F.col("id") % 2).cast("int").alias("g"), (F.col("id") % 7 / 10).alias("v"))
    plain = sorted(r["v"] for r in df.where("g = 1").collect())
    got = RK.kth_smallest(df, "v", {1: [1, 5000, 10000]}, "g")
    assert got == {1: [plain[0], plain[4999], plain[9999]]}
    assert [k.count() for k in kept] == [14]


def test_training_points_are_spread(spark, rows, monkeypatch):
    monkeypatch.setattr(LN, "FIT_ROWS", 100)
    assert LN.spread(rows, LN.gbt()).rdd.getNumPartitions() == 40
    assert LN.spread(rows, _rate()) is rows
