"""Queries of the noisy-label estimator with given matrices and of the staged booster
(L20, P10, S3, M7, M11), with row-level oracles."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators.noisy import NoisyLabelClassifier, NoisyLabelClassifierModel
from ..operators.rates import RateClassifier
from ..operators.staged import StagedBooster
from ..session import cut_lineage, stage_path
from ..sources.tables import noisy_lineitem, pu_orders
from . import automl as AM
from . import sqlparts as S
from .catalog import register
from .q_labels import errors_sql, marks_sql
from .q_rates import F2_CAT, FOLDS, mean_sql, psx_sql, without
from .q_sampling import balanced_sql, smallest_sql

# Fixed parameters of these queries: P(s|y) and P(y|s) of two classes.
NOISE = [[0.85, 0.25], [0.15, 0.75]]
INVERSE = [[0.8, 0.2], [0.3, 0.7]]


def _classifier(**options) -> NoisyLabelClassifier:
    return NoisyLabelClassifier(estimator=RateClassifier(catCol=F2_CAT), inputCols=["n_1"], numFolds=FOLDS, **options)


# ------------------------------------------------------------------ L20 with given matrices

def _joint_sql(psx: str, noise: list | None, inverse: list | None) -> str:
    """s (psx rows) and cj (the calibrated joint that a matrix implies)."""
    if inverse is not None:
        inv = {(a, b): f"CAST({inverse[a][b]} AS DOUBLE)" for a in (0, 1) for b in (0, 1)}
    else:
        (a, b), (c, d) = noise
        prior = [f"(n0 * {d} - n1 * {b})", f"(n1 * {a} - n0 * {c})"]     # solved, up to a common factor
        clipped = [f"LEAST(GREATEST({p} / ((n0 + n1) * CAST({a * d - b * c} AS DOUBLE)), 1e-5), 1.0)" for p in prior]
        cell = {(s, y): f"{noise[s][y]} * {clipped[y]}" for s in (0, 1) for y in (0, 1)}
        inv = {(s, y): f"({cell[s, y]}) / ({cell[s, 0]} + {cell[s, 1]})" for s in (0, 1) for y in (0, 1)}
    cells = " UNION ALL ".join(
        f"SELECT CAST({s} AS INT) AS k_s, CAST({y} AS INT) AS k_y, ({inv[s, y]}) * n{s} AS v FROM n" for s in (0, 1) for y in (0, 1))
    return f"""WITH s AS ({psx}),
n AS (SELECT CAST(COUNT(CASE WHEN label = 0 THEN 1 END) AS DOUBLE) AS n0,
             CAST(COUNT(CASE WHEN label = 1 THEN 1 END) AS DOUBLE) AS n1 FROM s),
cj AS ({S.calibrate(cells, S.class_counts('SELECT * FROM s'))}), m AS ({marks_sql()})"""


def _given_sql(noise=None, inverse=None, rule: str = "TRUE") -> str:
    return f"""{_joint_sql(psx_sql(S.F2), noise, inverse)}
SELECT row_id, label, by_class AND by_count AND NOT agrees AND {rule} AS is_error FROM m"""


def _mask(spark, sf_dir, **options):
    return _classifier(**options).find_errors(noisy_lineitem(spark, sf_dir))[0]


@register("noisy_given_noise", _given_sql(noise=NOISE))
def noisy_given_noise(spark, sf_dir):
    """L20 with P(s|y) given: budgets from the matrix."""
    return _mask(spark, sf_dir, noiseMatrix=NOISE)


@register("noisy_given_inverse", _given_sql(inverse=INVERSE))
def noisy_given_inverse(spark, sf_dir):
    """L20 with P(y|s) given."""
    return _mask(spark, sf_dir, inverseNoiseMatrix=INVERSE)


@register("noisy_clean_class", _given_sql(inverse=INVERSE, rule="label <> 1"))
def noisy_clean_class(spark, sf_dir):
    """L20 with a class without wrong labels, which is protected."""
    return _mask(spark, sf_dir, inverseNoiseMatrix=INVERSE, cleanClass=1)


@register("noisy_clean_class_reference", _given_sql(inverse=INVERSE, rule="label = 1"))
def noisy_clean_class_reference(spark, sf_dir):
    """L20 with the reference's mask: only rows of that class can be pruned."""
    return _mask(spark, sf_dir, inverseNoiseMatrix=INVERSE, cleanClass=1, puMask="reference")


@register("noisy_saved_model", mean_sql(S.F2, F2_CAT, [
    without(S.F2, f"SELECT row_id FROM ({_given_sql(noise=NOISE)}) g WHERE is_error")]))
def noisy_saved_model(spark, sf_dir):
    """L20 + S3: fitted with a given matrix, saved, loaded, all rows scored."""
    d = noisy_lineitem(spark, sf_dir)
    path = stage_path(spark)
    _classifier(noiseMatrix=NOISE).fit(d).write().save(path)
    out = NoisyLabelClassifierModel.load(path).transform(d)
    return out.select("row_id", r6(F.element_at(vector_to_array("probability"), 2)).alias("score"))


# ------------------------------------------------------------------ M7, M11 with the staged booster

STAGED_CATS = ["c_1", "c_3"]
STAGED_ROUNDS = 8
STAGED_STEP, STAGED_SMOOTHING, STAGED_PATIENCE = 0.5, 10.0, 2


def _booster(params=None, seed=0) -> StagedBooster:
    return StagedBooster(catCols=STAGED_CATS, maxIter=STAGED_ROUNDS, stepSize=STAGED_STEP, smoothing=STAGED_SMOOTHING,
                         patience=STAGED_PATIENCE, validationCol="_valid")


def _staged_sql(p: str, src: str, cats: list = STAGED_CATS) -> str:
    """CTEs ``{p}d1 ..`` (value, delta), ``{p}base`` and ``{p}best`` of a fit on src (label, categories, is_valid)."""
    out = [f"{p}base AS MATERIALIZED (SELECT AVG(CAST(label AS DOUBLE)) AS base FROM ({src}) b WHERE NOT is_valid)",
           f"{p}s0 AS MATERIALIZED (SELECT label, {', '.join(cats)}, is_valid, base AS f FROM ({src}) b CROSS JOIN {p}base)"]
    for r in range(1, STAGED_ROUNDS + 1):
        c = cats[(r - 1) % len(cats)]
        out += [f"""{p}d{r} AS MATERIALIZED (SELECT {c} AS value, {STAGED_STEP} * (SUM(label - f) / (COUNT(*) + {STAGED_SMOOTHING})) AS delta
FROM {p}s{r - 1} WHERE NOT is_valid GROUP BY {c})""",
                f"""{p}s{r} AS MATERIALIZED (SELECT s.* REPLACE (f + COALESCE(delta, 0) AS f) FROM {p}s{r - 1} s
LEFT JOIN {p}d{r} d ON s.{c} IS NOT DISTINCT FROM d.value)"""]
    losses = " UNION ALL ".join(f"SELECT {r} AS r, SQRT(AVG((label - f) * (label - f))) AS loss FROM {p}s{r} WHERE is_valid"
                                for r in range(1, STAGED_ROUNDS + 1))
    out.append(f"""{p}best AS MATERIALIZED (WITH l AS ({losses}), m AS (SELECT *, MIN(loss) OVER (ORDER BY r) AS low FROM l),
b AS (SELECT m.r, (SELECT MIN(l.r) FROM l WHERE l.loss = m.low AND l.r <= m.r) AS best FROM m)
SELECT best FROM b ORDER BY CASE WHEN r - best >= {STAGED_PATIENCE} THEN r ELSE {STAGED_ROUNDS} + 1 END, r DESC LIMIT 1)""")
    return ",\n".join(out)


def _staged_score(p: str, f: str = "f", limit: str | None = None, cats: list = STAGED_CATS) -> tuple[str, str]:
    """Score expression and joins over rows f, by the first rounds."""
    upto = limit or f"(SELECT best FROM {p}best)"
    joins = " ".join(f"LEFT JOIN {p}d{r} ON {f}.{cats[(r - 1) % len(cats)]} IS NOT DISTINCT FROM {p}d{r}.value"
                     for r in range(1, STAGED_ROUNDS + 1))
    terms = " + ".join(f"CASE WHEN {r} <= {upto} THEN COALESCE({p}d{r}.delta, 0) ELSE 0 END" for r in range(1, STAGED_ROUNDS + 1))
    return f"(SELECT base FROM {p}base) + {terms}", joins


def _valid_sql(src: str, seed: int, share: float) -> str:
    """src with is_valid: an exact share of the rows by their split keys."""
    held = smallest_sql(f"SELECT row_id FROM ({src}) h", f"(SELECT CAST(CEIL({share} * COUNT(*)) AS BIGINT) FROM ({src}) h)",
                        seed, purpose="split")
    return f"SELECT v.*, row_id IN (SELECT row_id FROM ({held}) x) AS is_valid FROM ({src}) v"


def _regression_sql() -> str:
    parts, scores, joins, pruned = [f"f AS MATERIALIZED ({S.F2})"], [], [], []
    for i in range(AM.NOISY_MODELS):
        p = f"m{i}_"
        sample = smallest_sql("SELECT * FROM f", "(SELECT CAST(ROUND_EVEN(0.75 * COUNT(*), 0) AS BIGINT) FROM f)", i)
        parts += [f"{p}sample AS MATERIALIZED (SELECT * EXCLUDE (_rn) FROM ({sample}) a)",
                  f"{p}psx AS MATERIALIZED ({psx_sql(f'SELECT * FROM {p}sample', i)})",
                  f"{p}err AS MATERIALIZED ({_errors(f'SELECT * FROM {p}psx')})",
                  f"{p}kept AS MATERIALIZED ({without(f'SELECT * FROM {p}sample', f'SELECT row_id FROM {p}err')})",
                  f"{p}rows AS MATERIALIZED ({_valid_sql(f'SELECT * FROM {p}kept', i, 0.3)})",
                  _staged_sql(p, f"SELECT * FROM {p}rows")]
        score, join = _staged_score(p)
        parts.append(f"{p}out AS MATERIALIZED (SELECT f.row_id, {score} AS score, (SELECT best FROM {p}best) AS rounds FROM f {join})")
        scores.append(f"SELECT * FROM {p}out")
        pruned.append(f"SELECT best FROM {p}best")
    cut = f"SELECT best FROM ({' UNION ALL '.join(pruned)}) z ORDER BY best OFFSET {int(round(AM.NOISY_MODELS * 0.2, 9))} LIMIT 1"
    return f"""WITH {', '.join(parts)}
SELECT row_id, ROUND(AVG(score), 6) AS score FROM ({' UNION ALL '.join(scores)}) u
WHERE rounds >= ({cut}) GROUP BY row_id"""


def _errors(psx: str) -> str:
    return f"SELECT row_id FROM ({errors_sql(psx)}) e"


@register("noisy_regression_rate", _regression_sql())
def noisy_regression_rate(spark, sf_dir):
    """M7: six cleaned 75% samples, staged fits with early stopping, short models pruned, mean of the rest."""
    d = noisy_lineitem(spark, sf_dir)
    models = AM.noisy_regression(d, ["n_1"], estimator=_booster, cleaner=lambda: RateClassifier(catCol=F2_CAT))
    return AM.mean_prediction(models, d).select("row_id", r6(F.col("score")).alias("score"))


TREE_LIMIT = 3


def _limit_sql() -> str:
    score, join = _staged_score("m_", limit=f"LEAST({TREE_LIMIT}, (SELECT best FROM m_best))")
    return f"""WITH f AS MATERIALIZED ({S.F2}), rows AS MATERIALIZED ({_valid_sql('SELECT * FROM f', 0, 0.2)}),
{_staged_sql('m_', 'SELECT * FROM rows')}
SELECT f.row_id, ROUND(LEAST(GREATEST({score}, 0), 1), 6) AS score FROM f {join}"""


@register("scores_tree_limit", _limit_sql())
def scores_tree_limit(spark, sf_dir):
    """All rows scored by the first rounds of an early-stopped model."""
    d = noisy_lineitem(spark, sf_dir)
    models = AM.noisy_single(d, ["n_1"], trials=0, estimator=_booster, staged=True)
    return AM.predict(models, d, tree_limit=TREE_LIMIT).select("row_id", r6(F.col("score")).alias("score"))


# ------------------------------------------------------------------ M8 in full

PU_CATS = ["c_2", "c_1"]
PU_MODELS = 3


def _pu_booster(params=None, seed=0) -> StagedBooster:
    return StagedBooster(catCols=PU_CATS, maxIter=STAGED_ROUNDS, stepSize=STAGED_STEP, smoothing=STAGED_SMOOTHING,
                         patience=STAGED_PATIENCE, validationCol="_valid")


def _pu_round(i: int) -> tuple[str, str, str]:
    """CTEs of one round, and the score of its model over f with the joins that it needs."""
    p = f"u{i}_"
    rounds = f"(SELECT best FROM {p}first_best)"
    plain = f"SELECT *, FALSE AS is_valid FROM {p}folded"
    parts = [f"{p}all AS MATERIALIZED ({balanced_sql('SELECT * FROM f', '4 * p0', i)})",
             f"{p}rows AS MATERIALIZED ({_valid_sql(f'SELECT * EXCLUDE (side, rn) FROM {p}all', i, 0.1)})",
             _staged_sql(f"{p}first_", f"SELECT * FROM {p}rows", PU_CATS),
             f"{p}folded AS MATERIALIZED ({S.folds(f'SELECT * EXCLUDE (side, rn) FROM {p}all', FOLDS, i)})"]
    scored = []
    for k in range(FOLDS):
        parts.append(_staged_sql(f"{p}k{k}_", f"{plain} WHERE fold <> {k}", PU_CATS))
        score, join = _staged_score(f"{p}k{k}_", "t", rounds, PU_CATS)
        scored.append(f"SELECT t.*, LEAST(GREATEST({score}, 0), 1) AS p1 FROM {p}folded t {join} WHERE t.fold = {k}")
    parts += [f"{p}psx AS MATERIALIZED (SELECT *, 1 - p1 AS p0 FROM ({' UNION ALL '.join(scored)}) a)",
              f"{p}err AS MATERIALIZED (SELECT row_id FROM ({errors_sql(f'SELECT * FROM {p}psx')}) e WHERE label <> 1)",
              _staged_sql(f"{p}last_", f"{plain} WHERE row_id NOT IN (SELECT row_id FROM {p}err)", PU_CATS)]
    score, join = _staged_score(f"{p}last_", "f", rounds, PU_CATS)
    parts.append(f"{p}out AS MATERIALIZED (SELECT f.row_id, LEAST(GREATEST({score}, 0), 1) AS score FROM f {join})")
    return ",\n".join(parts), f"SELECT * FROM {p}out", rounds


_PU = [_pu_round(i) for i in range(PU_MODELS)]


@register("pu_confident_staged", f"""WITH f AS MATERIALIZED ({S.F1}),
{', '.join(r[0] for r in _PU)}
SELECT row_id, ROUND(AVG(score), 6) AS score FROM ({' UNION ALL '.join(r[1] for r in _PU)}) u GROUP BY row_id""")
def pu_confident_staged(spark, sf_dir):
    """M8 in full, three rounds: the early-stopped 90/10 fit sets the rounds of the folds and of the last fit."""
    d = cut_lineage(pu_orders(spark, sf_dir))
    return AM.predict(AM.pu_confident(d, ["n_1"], PU_MODELS, estimator=_pu_booster, staged=True), d).select(
        "row_id", r6(F.col("score")).alias("score"))
