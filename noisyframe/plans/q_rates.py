"""Queries of the learning layer with the rate classifier, whose fit SQL can state.

The same operators as in :mod:`q_learning`, with the folds, cleaning passes, samples,
splits and ensemble sizes of the reference, and row-level oracles.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.keys import key_sql, r6
from ..operators import learn as LN
from ..operators.rates import RateClassifier
from ..session import cut_lineage
from ..sources.tables import noisy_lineitem, pu_orders, ssl_events
from . import automl as AM
from . import sqlparts as S
from .catalog import register
from .q_labels import errors_sql
from .q_sampling import balanced_sql, pu_sql, ssl_pu_sql, ssl_sql

# The category column of each frame that the classifier learns from.
F2_CAT, F3_CAT, F1_CAT = "c_3", "c_1", "c_2"
FOLDS = LN.CLEAN_FOLDS


def _rate(cat: str):
    return lambda params=None, seed=0: RateClassifier(catCol=cat)


def _mean(models: list, df):
    return AM.predict(models, df).select("row_id", r6(F.col("score")).alias("score"))


def _rates(train: str, cat: str) -> str:
    return f"""SELECT {cat} AS value, CAST(COUNT(CASE WHEN label = 1 THEN 1 END) AS DOUBLE) AS n1,
  CAST(COUNT(CASE WHEN label IN (0, 1) THEN 1 END) AS DOUBLE) AS n FROM ({train}) t GROUP BY {cat}"""


def _kept_for_fit(src: str, seed: int, share: float) -> str:
    """The rows that an exact split of ``share`` does not hold out."""
    return f"""SELECT * EXCLUDE (_rk, _n) FROM (SELECT *, COUNT(*) OVER () AS _n,
  RANK() OVER (ORDER BY {key_sql('row_id', seed, 'split')}, row_id) AS _rk FROM ({src}) a) b
WHERE _rk > CEIL(CAST({share} AS DOUBLE) * _n)"""


def mean_sql(src: str, cat: str, trains: list) -> str:
    """Mean over the models of the smoothed rate of the row's value."""
    joins = " ".join(f"LEFT JOIN ({_rates(t, cat)}) m{i} ON f.{cat} IS NOT DISTINCT FROM m{i}.value"
                     for i, t in enumerate(trains))
    terms = " + ".join(f"(COALESCE(m{i}.n1, 0) + 1) / (COALESCE(m{i}.n, 0) + 2)" for i in range(len(trains)))
    return f"SELECT f.row_id, ROUND(({terms}) / {len(trains)}.0, 6) AS score FROM ({src}) f {joins}"


def psx_sql(src: str, seed: int = 0, cat: str = F2_CAT) -> str:
    return S.fold_psx(S.folds(src, FOLDS, seed), cat, 2)


def without(src: str, errors: str) -> str:
    return f"SELECT * FROM ({src}) w WHERE row_id NOT IN (SELECT row_id FROM ({errors}) x)"


@register("oof_rate_probs", f"""SELECT row_id, label, ROUND(p0, 6) AS p0, ROUND(p1, 6) AS p1 FROM ({psx_sql(S.F2)}) p""")
def oof_rate_probs(spark, sf_dir):
    """L1: five models, each scores the fold it has not seen."""
    p = LN.oof_probabilities(noisy_lineitem(spark, sf_dir), ["n_1"], _rate(F2_CAT), FOLDS, 0)
    return p.select("row_id", "label", *[r6(F.element_at("psx", k + 1)).alias(f"p{k}") for k in (0, 1)])


_ERR1 = errors_sql(psx_sql(S.F2))
_ERR2 = errors_sql(psx_sql(without(S.F2, _ERR1), 1))


@register("clean_labels_rate", f"""SELECT row_id FROM ({_ERR1}) a UNION ALL SELECT row_id FROM ({_ERR2}) b""")
def clean_labels_rate(spark, sf_dir):
    """Two passes, the second on what the first one kept, with a new seed."""
    d = noisy_lineitem(spark, sf_dir)
    return LN.clean_labels(d, ["n_1"], rounds=1, estimator_factory=_rate(F2_CAT)).errors


@register("noisy_label_model_rate", mean_sql(S.F2, F2_CAT, [without(S.F2, _ERR1)]))
def noisy_label_model_rate(spark, sf_dir):
    """Prune the likely errors, train on the rest."""
    d = noisy_lineitem(spark, sf_dir)
    m = LN.NoisyLabelModel(["n_1"], _rate(F2_CAT)).fit(d)
    p1 = F.element_at(vector_to_array("probability"), 2)
    return m.transform(d).select("row_id", r6(p1).alias("score"))


@register("ssl_ensemble_rate", mean_sql(S.F3, F3_CAT, [_kept_for_fit(ssl_sql(i), i, 0.2)
                                                        for i in range(AM.SSL_MODELS)]))
def ssl_ensemble_rate(spark, sf_dir):
    """M3 + A13: five samples (T7), 80/20 fits, mean score."""
    d = cut_lineage(ssl_events(spark, sf_dir))
    return _mean(AM.ssl_ensemble(d, ["n_1"], trials=0, estimator=_rate(F3_CAT)), d)


@register("pu_ensemble_rate", mean_sql(S.F1, F1_CAT, [_kept_for_fit(pu_sql(i), i, 0.2)
                                                       for i in range(AM.PU_MODELS)]))
def pu_ensemble_rate(spark, sf_dir):
    """M4 + A13: ten samples (T8), 80/20 fits, mean score."""
    d = cut_lineage(pu_orders(spark, sf_dir))
    return _mean(AM.pu_ensemble(d, ["n_1"], trials=0, estimator=_rate(F1_CAT)), d)


@register("noisy_single_rate", mean_sql(S.F2, F2_CAT, [_kept_for_fit(S.F2, 0, 0.2)]))
def noisy_single_rate(spark, sf_dir):
    """M5 + M11: one model, all rows scored."""
    d = noisy_lineitem(spark, sf_dir)
    return _mean(AM.noisy_single(d, ["n_1"], trials=0, estimator=_rate(F2_CAT)), d)


def _cleaning(i: int) -> str:
    """CTEs n{i}a, n{i}b: the rows of f left by two cleaning passes with the seeds i and i + 1."""
    parts, src = [], "f"
    for step, seed in (("a", i), ("b", i + 1)):
        p = f"n{i}{step}"
        parts += [f"{p}_psx AS MATERIALIZED ({psx_sql(f'SELECT * FROM {src}', seed)})",
                  f"{p}_err AS MATERIALIZED (SELECT row_id FROM ({errors_sql(f'SELECT * FROM {p}_psx')}) e)",
                  f"{p} AS MATERIALIZED ({without(f'SELECT * FROM {src}', f'SELECT row_id FROM {p}_err')})"]
        src = p
    return ",\n".join(parts)


_CLEANED = ",\n".join(_cleaning(i) for i in range(AM.NOISY_MODELS))


@register("noisy_ensemble_rate", f"WITH f AS MATERIALIZED ({S.F2}),\n{_CLEANED}\n" + mean_sql(
    "SELECT * FROM f", F2_CAT, [_kept_for_fit(f"SELECT * FROM n{i}b", i, 0.2) for i in range(AM.NOISY_MODELS)]))
def noisy_ensemble_rate(spark, sf_dir):
    """M6: the noise is estimated (below 0.9 here); each of six rounds cleans all rows twice with
    its own seeds, then fits on the kept ones."""
    d = noisy_lineitem(spark, sf_dir)
    return _mean(AM.noisy_ensemble(d, ["n_1"], estimator=_rate(F2_CAT)), d)


_BAG = "4 * p0"     # four times the positives in all


@register("pu_bagging_rate", mean_sql(S.F1, F1_CAT, [_kept_for_fit(balanced_sql(S.F1, _BAG, i), i, 0.1)
                                                      for i in range(AM.PU_MODELS)]))
def pu_bagging_rate(spark, sf_dir):
    """M9: ten class-balanced bags, 90/10 fits, mean score."""
    d = cut_lineage(pu_orders(spark, sf_dir))
    return _mean(AM.pu_bagging(d, ["n_1"], trials=0, estimator=_rate(F1_CAT)), d)


def _confident(i: int) -> str:
    """CTEs: the balanced sample of round i, its errors but for positives, and the rows kept."""
    p = f"c{i}"
    sample = balanced_sql("SELECT * FROM f", _BAG, i)
    return ",\n".join([
        f"{p}_all AS MATERIALIZED ({sample})",
        f"{p}_psx AS MATERIALIZED ({psx_sql(f'SELECT * FROM {p}_all', i, F1_CAT)})",
        f"{p}_err AS MATERIALIZED (SELECT row_id FROM ({errors_sql(f'SELECT * FROM {p}_psx')}) e WHERE label <> 1)",
        f"{p} AS MATERIALIZED ({without(f'SELECT * FROM {p}_all', f'SELECT row_id FROM {p}_err')})"])


@register("pu_confident_rate", f"WITH f AS MATERIALIZED ({S.F1}),\n" + ",\n".join(_confident(i) for i in range(AM.PU_MODELS)) + "\n" + mean_sql(
    "SELECT * FROM f", F1_CAT, [f"SELECT * FROM c{i}" for i in range(AM.PU_MODELS)]))
def pu_confident_rate(spark, sf_dir):
    """M8: ten balanced samples, pruned with the positive class protected."""
    d = cut_lineage(pu_orders(spark, sf_dir))
    return _mean(AM.pu_confident(d, ["n_1"], estimator=_rate(F1_CAT)), d)


def _drawn(seed: int) -> str:
    return f"SELECT d.row_id, d.label, e.{F3_CAT} FROM ({ssl_pu_sql(seed)}) d JOIN ({S.F3}) e ON e.row_id = d.row_id"


@register("ssl_as_pu_rate", mean_sql(S.F3, F3_CAT, [_kept_for_fit(_drawn(i), i, 0.1) for i in range(AM.PU_MODELS)]))
def ssl_as_pu_rate(spark, sf_dir):
    """Draws with replacement (T9), 90/10 fits, mean score."""
    d = cut_lineage(ssl_events(spark, sf_dir))
    return _mean(AM.ssl_as_pu(d, ["n_1"], estimator=_rate(F3_CAT)), d)


@register("holdout_auc", f"""WITH t AS ({_kept_for_fit(S.F2, 0, 0.2)}),
v AS (SELECT f.label, (COALESCE(m.n1, 0) + 1) / (COALESCE(m.n, 0) + 2) AS x
      FROM ({without(S.F2, 'SELECT row_id FROM t')}) f
      LEFT JOIN ({_rates('SELECT * FROM t', F2_CAT)}) m ON f.{F2_CAT} IS NOT DISTINCT FROM m.value),
r AS (SELECT x, label, AVG(rn) OVER (PARTITION BY x) AS ar FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY x) AS rn FROM v) a),
c AS (SELECT CAST(COUNT(CASE WHEN label = 1 THEN 1 END) AS DOUBLE) AS np,
             CAST(COUNT(CASE WHEN label <> 1 THEN 1 END) AS DOUBLE) AS nn FROM v)
SELECT ROUND((SUM(CASE WHEN label = 1 THEN ar END) - MAX(np) * (MAX(np) + 1) / 2) / (MAX(np) * MAX(nn)), 6) AS auc
FROM r CROSS JOIN c""")
def holdout_auc(spark, sf_dir):
    """The validation AUC that every fit keeps."""
    d = noisy_lineitem(spark, sf_dir)
    model, = AM.noisy_single(d, ["n_1"], trials=0, estimator=_rate(F2_CAT))
    return spark.createDataFrame([(model.valid_auc,)], "auc double").select(r6(F.col("auc")).alias("auc"))
