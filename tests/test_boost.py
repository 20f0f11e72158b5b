"""Boosted trees over blocks against Spark's own."""
import re

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from noisyframe.operators import boost as B
from noisyframe.operators import learn as LN
from noisyframe.session import cut_lineage

COLS = ["n_1", "n_2", "c_1", "n_3"]


@pytest.fixture
def blocks(monkeypatch):
    """All fits go over blocks, several of them."""
    monkeypatch.setattr(B, "SMALL_ROWS", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 700)


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return cut_lineage(spark.range(12000).select(
        i.alias("row_id"), (F.pmod(F.xxhash64(i, F.lit(1)), F.lit(5000)) / 100 - 20).alias("n_1"),
        F.pmod(F.xxhash64(i, F.lit(2)), F.lit(9)).cast("double").alias("n_2"),
        F.pmod(F.xxhash64(i, F.lit(3)), F.lit(3)).cast("int").alias("c_1"), F.lit(4.0).alias("n_3"),
        (F.pmod(F.xxhash64(i, F.lit(4)), F.lit(4)) == 0).alias("_valid")).withColumn(
            "label", ((F.col("n_1") + F.col("n_2") * F.col("c_1") > 9) != (F.pmod(F.col("row_id"), F.lit(7)) == 0)).cast("int")))


def trees(model) -> str:
    text = model._java_obj.toDebugString().split("\n", 1)[1]
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda x: f"{float(x.group()):.9f}", text)


@pytest.mark.parametrize("given", [
    dict(maxIter=5, maxDepth=4), dict(maxIter=9, maxDepth=3, validationIndicatorCol="_valid", validationTol=0.001, stepSize=0.4),
    dict(maxIter=60, maxDepth=5, minInstancesPerNode=40, validationIndicatorCol="_valid", validationTol=0.0, stepSize=0.5),
    dict(maxIter=2, maxDepth=0), dict(maxIter=2, maxDepth=2, maxBins=300)])
@pytest.mark.parametrize("mine, sparks", [(B.BlockGBTClassifier, GBTClassifier), (B.BlockGBTRegressor, GBTRegressor)])
def test_the_trees_are_sparks(spark, rows, blocks, mine, sparks, given):
    d = LN.assembler(COLS).transform(rows)
    got, want = (kind(labelCol="label", seed=5, **({"maxBins": 64} | given)).fit(d) for kind in (mine, sparks))
    assert trees(got) == trees(want) and got.getNumTrees == want.getNumTrees and got.numFeatures == want.numFeatures
    a, b = (m.transform(d).agg(F.sum(F.col("prediction") * F.col("row_id"))).first()[0] for m in (got, want))
    assert abs(a - b) < 1e-6 * abs(b)


def test_no_training_point_is_kept_as_an_object(spark, rows, blocks, monkeypatch):
    """Spark's fit persists points, predictions and errors of every row; folds of a large table fill the disks."""
    def never(*a):
        raise AssertionError("Spark's own fit ran")

    monkeypatch.setattr(GBTClassifier, "_fit", never)
    psx = LN.oof_probabilities(rows.drop("_valid"), COLS, lambda: LN.gbt(4, 3), 3, 0)
    assert psx.count() == 12000


def test_fractions_of_rows_and_features(spark, rows, blocks):
    d = LN.assembler(COLS).transform(rows)
    est = LN.gbt(6, 4, 0.2, 0.6, 3, "0.5", 5, validation_col="_valid")
    first, second = est.fit(d), est.fit(d)
    assert trees(first) == trees(second) and "feature 3" not in trees(first)
    assert len(first.trees[0].toDebugString) > 100 and first.trees[0]._java_obj.rootNode().impurityStats().rawCount() < 0.65 * 9000
    assert LN.auc(first.transform(rows.transform(LN.assembler(COLS).transform))) > 0.7


def test_values_that_spark_refuses_are_refused(spark, rows, blocks):
    bad = rows.withColumn("n_2", F.when(F.col("row_id") != 77, F.col("n_2")))
    with pytest.raises(ValueError, match="NaN"):
        Pipeline(stages=[LN.assembler(COLS), LN.gbt(2, 2)]).fit(bad)
    with pytest.raises(ValueError, match="Labels"):
        Pipeline(stages=[LN.assembler(COLS), LN.gbt(2, 2)]).fit(rows.withColumn("label", F.lit(2)))


def test_a_model_over_blocks_is_saved_and_loaded(spark, rows, blocks, tmp_path):
    model = Pipeline(stages=[LN.assembler(COLS), LN.gbt(4, 3)]).fit(rows)
    model.write().save(str(tmp_path / "m"))
    loaded = type(model).load(str(tmp_path / "m"))
    assert trees(loaded.stages[-1]) == trees(model.stages[-1])
