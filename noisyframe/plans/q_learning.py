"""Queries of the learning layer (A11, A12, A14 with oracles; L1, L19, L20, M1-M14,
S3-S5 rows-only)."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.keys import argmax_first, r6
from ..operators import features as FE
from ..operators import labels as L
from ..operators import learn as LN
from ..session import Scratch, checkpoint_dir, cut_lineage
from ..sources.tables import (embeddings, noisy_documents, noisy_lineitem, pu_orders, ssl_events)
from ..sources.text import read_labelled_text, write_labelled_text
from . import automl as AM
from . import sqlparts as S
from .catalog import register
from .label_errors import lineitem_psx, p_columns

# Fixed parameters of the learning queries: small so a query stays quick at sf0.01.
ROUNDS = 5
MODELS = 2
FOLDS = 3


# ------------------------------------------------------------------ A11, A12, A14 (oracle)

@register("accuracy", f"""SELECT ROUND(SUM(n_1 * CASE WHEN {S.argmax()} = label THEN 1.0 ELSE 0.0 END) / SUM(n_1), 6)
       AS accuracy FROM ({S.psx_lineitem()}) p""")
def accuracy(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir, checkpoint=False)
    a = LN.accuracy(p, argmax_first(F.col("psx")), weight="n_1")
    return a.select(r6(F.col("accuracy")).alias("accuracy"))


EMB_K = 10
EMB_TOP = 3
# the place of the vector's largest component, of all its dimensions
EMB_SRC = """SELECT vec_id AS row_id, label,
  CAST(list_position(embedding, list_max(embedding)) AS STRING) AS c_1 FROM embeddings"""


def emb_psx(spark, sf_dir):
    f = embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("row_id"), "label",
        F.array_position("embedding", F.array_max("embedding")).cast("string").alias("c_1"))
    return L.fold_rate_psx(L.stratified_folds(f, 5, 0, write=True), "c_1", EMB_K)


def _prec_sql() -> str:
    src = S.fold_psx(S.folds(EMB_SRC), "c_1", EMB_K)
    own = "CASE " + " ".join(f"WHEN label = {k} THEN p{k}" for k in range(EMB_K)) + " END"
    ahead = " + ".join(f"CASE WHEN p{j} > own OR (p{j} = own AND {j} < label) THEN 1 ELSE 0 END"
                       for j in range(EMB_K))
    return f"""SELECT ROUND(AVG(CASE WHEN {ahead} < {EMB_TOP} THEN 1.0 ELSE 0.0 END), 6) AS precision_at_k
FROM (SELECT *, {own} AS own FROM ({src}) q) r"""


@register("precision_at_k", _prec_sql())
def precision_at_k(spark, sf_dir):
    p = LN.precision_at_k(emb_psx(spark, sf_dir), EMB_TOP, EMB_K)
    return p.select(r6(F.col("precision_at_k")).alias("precision_at_k"))


@register("auc", f"""WITH s AS (SELECT p1 AS x, label FROM ({S.psx_lineitem()}) q),
r AS (SELECT x, label, AVG(rn) OVER (PARTITION BY x) AS ar
      FROM (SELECT x, label, ROW_NUMBER() OVER (ORDER BY x) AS rn FROM s) a),
c AS (SELECT CAST(COUNT(CASE WHEN label = 1 THEN 1 END) AS DOUBLE) AS np,
             CAST(COUNT(CASE WHEN label <> 1 THEN 1 END) AS DOUBLE) AS nn FROM s)
SELECT ROUND((SUM(CASE WHEN label = 1 THEN ar END) - MAX(np) * (MAX(np) + 1) / 2) / (MAX(np) * MAX(nn)), 6)
       AS auc FROM r CROSS JOIN c""")
def auc(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    v = LN.auc(p, F.element_at(F.col("psx"), 2))
    return spark.createDataFrame([(v,)], "auc double").select(r6(F.col("auc")).alias("auc"))


# ------------------------------------------------------------------ model frames

F2_CATS = ["c_1", "c_2", "c_3", "c_4", "c_5"]


def coded_lineitem(spark, sf_dir):
    """F2 with block-coded categories and no time column: numeric model input."""
    with Scratch() as s:
        f = noisy_lineitem(spark, sf_dir)
        out = cut_lineage(FE.encode_blocks(f, F2_CATS)[1].drop("t_1"))
        s.keep(out)
    return out


def _features(df):
    return LN.feature_columns(df)


def _scored(models, df):
    return AM.predict(models, df).select("row_id", r6(F.col("score")).alias("score"))


# ------------------------------------------------------------------ rows-only

@register("oof_probs")
def oof_probs(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    p = LN.oof_probabilities(d, _features(d), lambda: LN.gbt(ROUNDS, 4), FOLDS, 0)
    return p.select("row_id", "label", *p_columns(p))


@register("clean_labels")
def clean_labels(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    res = LN.clean_labels(d, _features(d), rounds=1, k=FOLDS, max_iter=ROUNDS)
    return res.errors.join(d.select("row_id", "label", "y_true"), "row_id").withColumns(
        {"rou_0": F.lit(res.rou_0), "rou_1": F.lit(res.rou_1)})


@register("noisy_label_model")
def noisy_label_model(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    m = LN.NoisyLabelModel(_features(d), lambda: LN.gbt(ROUNDS, 4), FOLDS).fit(d)
    out = m.transform(d)
    return out.select("row_id", "label", F.col("prediction").cast("int").alias("prediction"),
                      r6(LN.prob1()).alias("p1"))


@register("feature_gain")
def feature_gain(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    return LN.feature_gain(d, _features(d), ROUNDS)


@register("random_search")
def random_search(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    params, score = LN.random_search(d, _features(d), 2, 0, ROUNDS)
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(params.items())] + [("auc", str(score))],
                                 "param string, value string")


def _ssl_coded(spark, sf_dir):
    e = ssl_events(spark, sf_dir)
    _, out = FE.encode_blocks(e, ["c_1", "c_2"])
    return cut_lineage(FE.date_parts(out, "t_1").drop("t_1"))


def _pu_coded(spark, sf_dir):
    f = pu_orders(spark, sf_dir)
    return cut_lineage(FE.encode_blocks(f, ["c_1", "c_2", "c_3", "c_4"])[1].drop("t_1"))


@register("ssl_ensemble")
def ssl_ensemble(spark, sf_dir):
    d = _ssl_coded(spark, sf_dir)
    models = AM.ssl_ensemble(d, _features(d), MODELS, ROUNDS, trials=0)
    return _scored(models, d)


@register("pu_ensemble")
def pu_ensemble(spark, sf_dir):
    d = _pu_coded(spark, sf_dir)
    models = AM.pu_ensemble(d, _features(d), MODELS, ROUNDS, trials=0)
    return _scored(models, d)


@register("noisy_single")
def noisy_single(spark, sf_dir):
    """M5 whole: the search on 30,000 rows, then up to 500 rounds on all."""
    d = coded_lineitem(spark, sf_dir)
    return _scored(AM.noisy_single(d, _features(d)), d)


@register("noisy_ensemble")
def noisy_ensemble(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    return _scored(AM.noisy_ensemble(d, _features(d), MODELS, ROUNDS, clean_rounds=0, folds=FOLDS,
                                     clean_iter=ROUNDS), d)


@register("noisy_regression")
def noisy_regression(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    models = AM.noisy_regression(d, _features(d), MODELS, ROUNDS, folds=FOLDS, clean_iter=ROUNDS)
    parts = [m.transform(d).select("row_id", F.col("prediction").alias(f"s{i}")) for i, m in enumerate(models)]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "row_id")
    tot = sum((F.col(f"s{i}") for i in range(len(parts))), F.lit(0.0))
    return out.select("row_id", r6(tot / len(parts)).alias("score"))


@register("pu_confident")
def pu_confident(spark, sf_dir):
    d = _pu_coded(spark, sf_dir)
    return _scored(AM.pu_confident(d, _features(d), 1, 0, ROUNDS, FOLDS), d)


@register("pu_bagging")
def pu_bagging(spark, sf_dir):
    d = _pu_coded(spark, sf_dir)
    return _scored(AM.pu_bagging(d, _features(d), MODELS, ROUNDS, trials=0), d)


@register("ssl_as_pu")
def ssl_as_pu(spark, sf_dir):
    d = _ssl_coded(spark, sf_dir)
    return _scored(AM.ssl_as_pu(d, _features(d), MODELS, ROUNDS), d)


@register("scores")
def scores(spark, sf_dir):
    d = coded_lineitem(spark, sf_dir)
    models = AM.noisy_single(d, _features(d), ROUNDS, trials=0)
    return models[0].transform(d).select("row_id", F.col("prediction").cast("int").alias("prediction"),
                                         r6(LN.prob1()).alias("p1"))


@register("text_probs")
def text_probs(spark, sf_dir):
    docs = noisy_documents(spark, sf_dir).where(F.col("label").isNotNull()).select("row_id", "text", "label")
    folded = L.stratified_folds(docs, FOLDS, 0, write=True)
    pipe = lambda: Pipeline(stages=[
        Tokenizer(inputCol="text", outputCol="_tok"),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=1 << 18),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=20, regParam=0.01)])
    parts = []
    for f in range(FOLDS):
        m = pipe().fit(folded.where(F.col("fold") != f))
        parts.append(m.transform(folded.where(F.col("fold") == f)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    arr = vector_to_array(F.col("probability"))
    return out.select("row_id", "label", r6(F.element_at(arr, 1)).alias("p0"), r6(F.element_at(arr, 2)).alias("p1"))


@register("feature_engine")
def feature_engine(spark, sf_dir):
    f = noisy_lineitem(spark, sf_dir).drop("y_true")
    return AM.FeatureEngine("noisy", rounds=ROUNDS, folds=FOLDS).fit_transform(f)


@register("weak_label_model")
def weak_label_model(spark, sf_dir):
    f = noisy_lineitem(spark, sf_dir).drop("y_true")
    m = AM.WeakLabelModel("noisy", max_models=1, rounds=ROUNDS, folds=FOLDS).train(f)
    path = f"{checkpoint_dir(spark).rstrip('/')}/weak-label-model-{uuid.uuid4().hex}"
    m.save(path)
    loaded = AM.WeakLabelModel.load(spark, path)
    return loaded.predict(f).select("row_id", r6(F.col("score")).alias("score"))


@register("labelled_text", """SELECT CAST(l.quality AS VARCHAR) AS label,
  replace(trim(regexp_replace(replace(d.text, chr(13), ''), chr(10) || '+$', '')), chr(10), ' __newline__ ')
    AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def labelled_text(spark, sf_dir):
    docs = noisy_documents(spark, sf_dir)
    ids = docs.where(F.col("label").isNotNull()).select(F.col("row_id").alias("doc_id"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/labelled-text-{uuid.uuid4().hex}"
    write_labelled_text(docs.withColumnRenamed("row_id", "doc_id"), path, ids=ids)
    return read_labelled_text(spark, path)


@register("labelled_text_subset", """SELECT CAST(l.quality AS VARCHAR) AS label,
  replace(trim(regexp_replace(replace(d.text, chr(13), ''), chr(10) || '+$', '')), chr(10), ' __newline__ ')
    || ' __newline__ __label__9 __newline__ ' || chr(92) || '__label__8' AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 0""")
def labelled_text_subset(spark, sf_dir):
    """Documents whose last lines start with the label token, written, and the records of one label read by their ids."""
    docs = noisy_documents(spark, sf_dir).where(F.col("label").isNotNull()).withColumn("text", F.concat(
        F.trim(F.regexp_replace(F.regexp_replace("text", "\r", ""), "\n+$", "")), F.lit("\n__label__9\n\\__label__8")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/labelled-text-{uuid.uuid4().hex}"
    write_labelled_text(docs, path)
    ids = cut_lineage(read_labelled_text(spark, path, with_ids=True).where(F.col("label") == "0").select("file", "record"))
    return read_labelled_text(spark, path, ids=ids)
