"""The noisy-label estimator: given matrices, saved models, masks; the staged booster by rounds."""
import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from noisyframe.operators import labels as L
from noisyframe.operators import noisy as N
from noisyframe.operators.learn import assembler
from noisyframe.operators.rates import RateClassifier
from noisyframe.operators.staged import StagedBooster, StagedModel
from noisyframe.plans import automl as AM
from noisyframe.session import cut_lineage, stage_path


def frame(spark, n=400):
    """Label 1 for the values above 4 of ten; every seventh label is wrong."""
    rows = [(i, (i * 7) % 10, int((i * 7) % 10 > 4) ^ (i % 7 == 0)) for i in range(n)]
    return cut_lineage(spark.createDataFrame([(i, str(v), float(v), int(y)) for i, v, y in rows],
                                             "row_id long, c_1 string, n_1 double, label int"))


def classifier(**options):
    return N.NoisyLabelClassifier(estimator=RateClassifier(catCol="c_1"), inputCols=["n_1"], **options)


def p1(df):
    return {r["row_id"]: r["p"] for r in df.select("row_id", vector_to_array("probability")[1].alias("p")).collect()}


@pytest.mark.parametrize("matrix, inverse, message", [
    ([[0.5, 0.5], [0.5, 0.5]], False, "trace"), ([[0.3, 0.8], [0.7, 0.2]], False, "trace"),
    ([[0.9, 0.3], [0.2, 0.7]], False, "columns"), ([[0.9, 0.3], [0.2, 0.7]], True, "rows"),
    ([[1.2, 0.3], [-0.2, 0.7]], False, "outside"), ([[1.0, 0.0]], False, "square")])
def test_bad_matrices_raise(spark, matrix, inverse, message):
    with pytest.raises(ValueError, match=message):
        N.assert_noise_matrix(matrix, inverse)
    if np.shape(matrix) == (2, 2):
        with pytest.raises(ValueError, match=message):
            classifier(**{"inverseNoiseMatrix" if inverse else "noiseMatrix": matrix}).fit(frame(spark, 20))


def test_matrices_follow_from_each_other():
    noise, py = np.array([[0.8, 0.1, 0.0], [0.1, 0.7, 0.2], [0.1, 0.2, 0.8]]), np.array([0.5, 0.3, 0.2])
    ps = noise @ py
    assert np.allclose(N.prior_of(noise, ps), py)
    inverse = N.inverse_of(noise, ps)
    assert np.allclose(inverse, noise * py / ps[:, None])
    assert np.allclose(N.noise_of(inverse, ps), noise)
    with pytest.raises(ValueError, match="singular"):
        N.prior_of([[0.5, 0.5], [0.5, 0.5]], [0.4, 0.6])


def test_joint_of_a_matrix_has_the_class_counts(spark):
    d = frame(spark)
    sizes = L.class_sizes(d, "label", 2)
    for given in (dict(noise=[[0.9, 0.3], [0.1, 0.7]]), dict(inverse=[[0.75, 0.25], [0.1, 0.9]])):
        cells = {(r["k_s"], r["k_y"]): r["v"] for r in N.joint_from_matrix(d, 2, **given).collect()}
        assert all(cells[k, 0] + cells[k, 1] == sizes[k] for k in (0, 1))
    assert abs(cells[0, 1] - 0.25 * sizes[0]) <= 1


def test_saved_estimator_and_model(spark):
    d = frame(spark)
    path, again = stage_path(spark), stage_path(spark)
    est = classifier(noiseMatrix=[[0.85, 0.2], [0.15, 0.8]], cleanClass=1, puMask="reference", seed=3)
    est.write().save(path)
    loaded = N.NoisyLabelClassifier.load(path)
    assert loaded.matrices() == est.matrices() and loaded.value("puMask") == "reference" and loaded.value("cleanClass") == 1
    model = loaded.fit(d)
    model.write().save(again)
    back = N.NoisyLabelClassifierModel.load(again)
    assert p1(back.transform(d)) == p1(est.fit(d).transform(d))
    assert (back.noise, back.inverse) == (model.noise, model.inverse) and back.value("seed") == 3
    assert sorted(back.mask.collect()) == sorted(model.mask.collect())
    assert 0.8 < back.score(d) <= 1


def test_masks_of_the_clean_class(spark):
    d = frame(spark)
    every = {r["row_id"]: r["label"] for r in classifier().find_errors(d)[0].where("is_error").collect()}
    protect = {r["row_id"] for r in classifier(cleanClass=1).find_errors(d)[0].where("is_error").collect()}
    only = {r["row_id"] for r in classifier(cleanClass=1, puMask="reference").find_errors(d)[0].where("is_error").collect()}
    assert protect == {i for i, y in every.items() if y != 1} and only == {i for i, y in every.items() if y == 1}
    assert protect and only
    noise = classifier(cleanClass=1).find_errors(d)[1]
    assert noise[1][0] == 0 and noise[0][0] == 1
    with pytest.raises(ValueError, match="puMask"):
        classifier(puMask="other").find_errors(d)


def test_in_a_pipeline_with_other_column_names(spark):
    d = frame(spark).withColumnsRenamed({"label": "said", "row_id": "key"})
    est = N.NoisyLabelClassifier(estimator=LogisticRegression(maxIter=5), inputCols=["n_1"], labelCol="said", idCol="key", numFolds=2)
    est.estimator.setLabelCol("label")
    kept = est.find_errors(d)[0]
    assert kept.count() == 400 and {r["label"] for r in kept.collect()} == {0, 1}


def test_given_probabilities_and_thresholds(spark):
    d = frame(spark)
    psx = L.fold_rate_psx(L.stratified_folds(d, 5, 0), "c_1").select("row_id", "label", "psx")
    a = classifier().fit_with(d, psx)
    b = classifier(thresholds=[0.5, 0.5], converge=True).fit_with(d, psx)
    assert a.mask.where("is_error").count() > 20 and abs(sum(b.prior) - 1) < 1e-9
    assert all(abs(sum(b.noise[s][y] for s in (0, 1)) - 1) < 1e-9 for y in (0, 1))


# ------------------------------------------------------------------ staged booster

def brute(rows, cats, rounds, step, smoothing, patience):
    train = [r for r in rows if not r["valid"]]
    base = sum(r["label"] for r in train) / len(train)
    f, deltas, best, low = [base] * len(rows), [], 0, None
    for r in range(1, rounds + 1):
        c = cats[(r - 1) % len(cats)]
        sums = {}
        for x, p in zip(rows, f, strict=True):
            if not x["valid"]:
                s, n = sums.get(x[c], (0.0, 0))
                sums[x[c]] = (s + x["label"] - p, n + 1)
        delta = {v: step * s / (n + smoothing) for v, (s, n) in sums.items()}
        deltas.append((c, delta))
        f = [p + delta.get(x[c], 0.0) for x, p in zip(rows, f, strict=True)]
        errors = [(x["label"] - p) ** 2 for x, p in zip(rows, f, strict=True) if x["valid"]]
        loss = (sum(errors) / len(errors)) ** 0.5
        if low is None or loss < low:
            best, low = r, loss
        elif r - best >= patience:
            break
    return lambda x, n: base + sum(d.get(x[c], 0.0) for c, d in deltas[:min(n, best)]), best, low


def test_staged_booster_equals_plain_python(spark):
    g = np.random.default_rng(2)
    rows = [dict(row_id=i, a=str(g.integers(0, 4)), b=None if i % 9 == 0 else str(g.integers(0, 3)), n_1=0.0,
                 valid=bool(g.random() < 0.3), label=float(g.integers(0, 2))) for i in range(120)]
    d = spark.createDataFrame([tuple(r.values()) for r in rows], "row_id long, a string, b string, n_1 double, valid boolean, label double")
    est = StagedBooster(catCols=["a", "b"], maxIter=12, stepSize=0.4, smoothing=2.0, patience=3, validationCol="valid")
    model = est.fit(d)
    score, best, loss = brute(rows, ["a", "b"], 12, 0.4, 2.0, 3)
    assert model.numRounds == best and abs(model.loss - loss) < 1e-9
    path = stage_path(spark)
    PipelineModel([model]).write().save(path)
    back = PipelineModel.load(path).stages[0]
    assert isinstance(back, StagedModel) and back.numRounds == best
    new = [dict(a="9", b=None), dict(a="1", b="2"), dict(a=None, b="0")]
    asked = spark.createDataFrame([(i, x["a"], x["b"]) for i, x in enumerate(new)], "i int, a string, b string")
    for limit in (0, 1, 2, 99):
        got = [r["prediction"] for r in back.setTreeLimit(limit).transform(asked).orderBy("i").collect()]
        assert np.allclose(got, [score(x, limit or 99) for x in new])


def test_staged_booster_without_validation_or_labels(spark):
    d = frame(spark, 60)
    assert StagedBooster(catCols=["c_1"], maxIter=3).fit(d).numRounds == 3
    with pytest.raises(ValueError, match="no labelled row"):
        StagedBooster(catCols=["c_1"], maxIter=3).fit(d.limit(0))


def test_predict_under_a_budget_and_by_auc(spark):
    d = frame(spark)
    models = []
    for k, auc in ((0, 0.6), (1, 0.9)):
        m = Pipeline(stages=[assembler(["n_1"]), RateClassifier(catCol="c_1")]).fit(d.where(F.col("row_id") % 2 == k))
        m.valid_auc = auc
        models.append(m)
    score = lambda df: {r["row_id"]: r["score"] for r in df.collect()}
    both = score(AM.predict(models, d))
    slow = score(AM.predict(models, d, time_budget_s=1e9))
    assert all(abs(both[i] - slow[i]) < 1e-12 for i in both)
    assert score(AM.predict(models, d, time_budget_s=0.0)) == score(AM.predict(models[:1], d))
    assert score(AM.predict(models, d, time_budget_s=0.0, by_auc=True)) == score(AM.predict(models[1:], d))
    with pytest.raises(ValueError, match="first rounds"):
        AM.predict(models, d, tree_limit=2)
