"""Label errors among ten classes (F5): joint, budgets and pruning for K > 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators import labels as L
from ..operators import pruning as P
from ..session import cut_lineage
from . import sqlparts as S
from .catalog import register
from .q_learning import EMB_K, EMB_SRC, emb_psx

HALF = 0.5
GIVEN = {k: 3 + k for k in range(EMB_K)}    # rows to remove of each class

PSX = S.fold_psx(S.folds(EMB_SRC), "c_1", EMB_K)
_CJ = S.calibrate(S.cells(S.confident("SELECT * FROM s", EMB_K), "label", "y_conf", EMB_K),
                  S.class_counts("SELECT * FROM s", EMB_K))
_WITH = f"WITH s AS ({PSX}), cj AS ({_CJ})"
_FRAC = "SELECT k_s, k_y, CAST(FLOOR(v * {frac}) AS BIGINT) AS n FROM cj WHERE k_s <> k_y"
_GIVEN_ROWS = ", ".join(f"({k}, {m})" for k, m in GIVEN.items())
_SCALED = S.round_rows(f"""SELECT c.k_s, c.k_y, CASE WHEN c.k_s = c.k_y THEN CAST(size - m AS DOUBLE)
  WHEN noise = 0 THEN 0.0 ELSE v / noise * m END AS v
FROM (SELECT *, CAST(SUM(CASE WHEN k_s <> k_y THEN v END) OVER (PARTITION BY k_s) AS DOUBLE) AS noise FROM cj) c
JOIN (VALUES {_GIVEN_ROWS}) g(k_s, m) ON g.k_s = c.k_s
JOIN (SELECT k_s, n AS size FROM ({S.class_counts('SELECT * FROM s', EMB_K)}) q) z ON z.k_s = c.k_s""")


def _errors(budget: str) -> str:
    margins = ", ".join(f"p{j} - own AS m{j}" for j in range(EMB_K))
    ranks = " UNION ALL ".join(
        f"SELECT row_id, label, {j} AS j, RANK() OVER (PARTITION BY label ORDER BY m{j} DESC) AS rk FROM o" for j in range(EMB_K))
    return f"""{_WITH}, bud AS ({budget}), tot AS (SELECT k_s, SUM(n) AS m FROM bud GROUP BY k_s),
w AS (SELECT *, {S.own_p(EMB_K)} AS own FROM s), o AS (SELECT *, {margins} FROM w),
r AS ({ranks}),
moved AS (SELECT DISTINCT row_id FROM r JOIN bud ON k_s = label AND k_y = j WHERE n > 0 AND rk <= n),
c AS (SELECT row_id, label, own, {S.argmax(EMB_K)} AS best, own - GREATEST({', '.join(f'p{k}' for k in range(EMB_K))}) AS score,
  COUNT(*) OVER (PARTITION BY label ORDER BY own RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM w)
SELECT row_id, label, ROUND(score, 6) AS score, ROW_NUMBER() OVER (ORDER BY score, row_id) AS pos
FROM c JOIN tot ON k_s = label WHERE m > 0 AND upto <= m AND best <> label AND row_id IN (SELECT row_id FROM moved)"""


def _ordered(spark, sf_dir, **budget):
    psx = cut_lineage(emb_psx(spark, sf_dir))
    marked = P.find_label_errors(psx, num_classes=EMB_K, budget="own", **budget)
    found = P.order_label_errors(marked)
    return found.select("row_id", "label", r6(F.col("score")).alias("score"), "pos")


@register("confident_joint_k10", f"{_WITH} SELECT * FROM cj")
def confident_joint_k10(spark, sf_dir):
    psx = cut_lineage(emb_psx(spark, sf_dir))
    return L.confident_joint(psx, L.per_class_thresholds(psx, EMB_K))


@register("label_errors_k10", _errors(_FRAC.format(frac="1.0")))
def label_errors_k10(spark, sf_dir):
    return _ordered(spark, sf_dir)


@register("label_errors_k10_half", _errors(_FRAC.format(frac=HALF)))
def label_errors_k10_half(spark, sf_dir):
    """Half of the noise (``frac_noise``)."""
    return _ordered(spark, sf_dir, frac_noise=HALF)


@register("label_errors_k10_given", _errors(f"SELECT k_s, k_y, v AS n FROM ({_SCALED}) x WHERE k_s <> k_y"))
def label_errors_k10_given(spark, sf_dir):
    """A given number of rows of each class (``num_to_remove``)."""
    return _ordered(spark, sf_dir, num_to_remove=GIVEN)
