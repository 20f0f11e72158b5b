"""Ensembles of independent members, one scoring plan, saved models."""
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from noisyframe.operators import learn as LN
from noisyframe.operators.rates import RateClassifier
from noisyframe.plans import automl as AM
from noisyframe.plans import q_learning as QL
from noisyframe.session import cut_lineage, stage_path
from noisyframe.sources.tables import noisy_lineitem, pu_orders

from .conftest import SF_SMALL


def _rate(cat):
    return lambda params=None, seed=0: RateClassifier(catCol=cat)


def test_members_of_an_ensemble_differ_and_are_scored_in_one_plan(spark):
    d = cut_lineage(pu_orders(spark, SF_SMALL))
    models = AM.pu_ensemble(d, ["n_1"], 3, trials=0, estimator=_rate("c_2"))
    fitted = [tuple(sorted((r["value"], tuple(r["n"])) for r in m.stages[-1].counts.collect())) for m in models]
    assert len(set(fitted)) == 3 and all(0 <= m.valid_auc <= 1 for m in models)
    got = {r["row_id"]: r["score"] for r in AM.predict(models, d).collect()}
    single = [{r["row_id"]: r["p"] for r in m.transform(d).select(
        "row_id", vector_to_array("probability")[1].alias("p")).collect()} for m in models]
    assert all(abs(got[i] - sum(s[i] for s in single) / 3) < 1e-12 for i in got)
    plan = AM.predict(models, d)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_id") and "row_id#" in plan and plan.count(".parquet") <= 4


def test_unseen_values_get_the_prior(spark):
    fit = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0)], "c_1 string, label int")
    model = RateClassifier(catCol="c_1").fit(fit)
    new = spark.createDataFrame([("a",), ("b",), (None,)], "c_1 string")
    got = {r["c_1"]: r["p"] for r in model.transform(new).select(
        "c_1", vector_to_array("probability")[1].alias("p")).collect()}
    assert got == {"a": 0.6, "b": 0.5, None: 0.5}


def test_saved_model_scores_alike_and_row_by_row(spark):
    f = noisy_lineitem(spark, SF_SMALL).select("row_id", "label", "c_3", "n_1", "n_2", "t_1")
    f = cut_lineage(f.withColumn("label", F.when(F.col("label") == 1, 1).otherwise(-1)))     # -1 / 1 labels
    model = AM.WeakLabelModel("noisy", max_models=1, rounds=3, folds=2, refit=False, seed=4).train(f)
    path = stage_path(spark)
    model.save(path)
    loaded = AM.WeakLabelModel.load(spark, path)
    assert (loaded.seed, loaded.rounds, loaded.refit) == (4, 3, False)
    assert loaded.engine.noise_sum == model.engine.noise_sum
    want = {r["row_id"]: r["score"] for r in model.predict(f).collect()}
    assert {r["row_id"]: r["score"] for r in loaded.predict(f).collect()} == want
    assert 0.6 < LN.auc(model.predict(f).join(f.withColumn("label", F.when(F.col("label") == 1, 1).otherwise(0)), "row_id"),
                        F.col("score"))


def test_out_of_fold_in_one_pass_equals_a_fit_per_fold(spark, monkeypatch):
    d = cut_lineage(pu_orders(spark, SF_SMALL).withColumn("c_2", F.when(F.col("row_id") % 11 != 0, F.col("c_2"))))

    def psx():
        return {r["row_id"]: r["psx"] for r in LN.oof_probabilities(d, ["n_1"], _rate("c_2"), 3, 5).collect()}
    one = psx()
    monkeypatch.delattr(RateClassifier, "out_of_fold")
    many = psx()
    assert one.keys() == many.keys()
    assert all(abs(a - b) < 1e-12 for i in one for a, b in zip(one[i], many[i], strict=True))


def test_noisy_single_searches_before_it_fits(spark, monkeypatch):
    rows = cut_lineage(spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("n_1"),
                                               (F.col("id") % 7 > 3).cast("int").alias("label")))
    monkeypatch.setattr(QL, "coded_lineitem", lambda spark, sf_dir: rows)
    monkeypatch.setattr(AM, "PU_SEARCH_ROWS", 300)
    seen, fitted = [], []
    search, gbt = LN.random_search, LN.searched_gbt

    def searching(df, features, trials, seed, rounds):
        seen.append((df.count(), trials, rounds, search(df, features, trials, seed, 2)))
        return seen[-1][3]

    monkeypatch.setattr(LN, "random_search", searching)
    monkeypatch.setattr(LN, "searched_gbt", lambda params, rounds, *a, **b: fitted.append((params, rounds)) or gbt(params, 2, *a, **b))
    assert QL.noisy_single(spark, "").count() == 400
    (n, trials, rounds, (params, _)), = seen
    assert (n, trials, rounds) == (300, 2, 500) and fitted == [(params, 500)]
