"""Queries of the label-quality core and pruning (W5, L1b, A1, A8, A10, L2-L6, W3, W4,
W6, L14-L17, T1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators import labels as L
from ..operators import pruning as P
from ..sources.tables import noisy_lineitem, table
from . import sqlparts as S
from .catalog import register
from .label_errors import label_errors, lineitem_psx, p_columns

PSX = S.psx_lineitem()


def _own_margin_sql() -> str:
    return f"""SELECT *, {S.own_p()} AS own, CASE WHEN label = 0 THEN p1 - p0 ELSE p0 - p1 END AS margin
FROM s"""


def _budget_sql() -> str:
    return """SELECT MAX(CASE WHEN k_s = 1 AND k_y = 0 THEN v END) AS cj10,
       MAX(CASE WHEN k_s = 0 AND k_y = 1 THEN v END) AS cj01 FROM cj"""


def marks_sql() -> str:
    """s (psx rows), cj (calibrated joint) -> by_class, by_count, agree flags."""
    return f"""SELECT m.*,
  (CASE WHEN label = 0 THEN cj10 ELSE cj01 END) > 0 AND
  COUNT(*) OVER (PARTITION BY label ORDER BY own RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
     <= (CASE WHEN label = 0 THEN cj10 ELSE cj01 END) AS by_class,
  (CASE WHEN label = 0 THEN cj01 ELSE cj10 END) > 0 AND
  RANK() OVER (PARTITION BY label ORDER BY margin DESC)
     <= (CASE WHEN label = 0 THEN cj01 ELSE cj10 END) AS by_count,
  {S.argmax()} = label AS agrees
FROM ({_own_margin_sql()}) m CROSS JOIN ({_budget_sql()}) b"""


def with_cj(psx: str) -> str:
    """s (psx rows) and cj (their calibrated joint)."""
    return f"""WITH s AS ({psx}),
cj AS ({S.calibrate(S.cells(S.confident('SELECT * FROM s'), 'label', 'y_conf'),
                    S.class_counts('SELECT * FROM s'))})"""


def errors_sql(psx: str) -> str:
    """Likely label errors of psx rows (L15, both methods)."""
    return f"""{with_cj(psx)}, m AS ({marks_sql()})
SELECT * FROM m WHERE by_class AND by_count AND NOT agrees"""


WITH_CJ = with_cj(PSX)


# ------------------------------------------------------------------ W5 / L1b / A1

@register("strat_folds", f"""SELECT label, fold, COUNT(*) AS n FROM ({S.folds(S.F2)}) f
GROUP BY label, fold""")
def strat_folds(spark, sf_dir):
    f = L.stratified_folds(noisy_lineitem(spark, sf_dir), 5, 0)
    return f.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("fold_rate_psx", f"""SELECT row_id, label, fold, ROUND(p0, 6) AS p0, ROUND(p1, 6) AS p1
FROM ({PSX}) p""")
def fold_rate_psx(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir, checkpoint=False)
    return p.select("row_id", "label", "fold", *p_columns(p))


@register("label_counts", """SELECT label, COUNT(*) AS n FROM (""" + S.F3 + """) e GROUP BY label""")
def label_counts(spark, sf_dir):
    from ..sources.tables import ssl_events
    return L.label_counts(ssl_events(spark, sf_dir))


# ------------------------------------------------------------------ A10, L2-L6, A8

@register("thresholds", f"""SELECT CAST(k AS INT) AS k, ROUND(thr, 6) AS thr FROM ({S.thresholds(PSX)}) t""")
def thresholds(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    thr = L.per_class_thresholds(p, 2)
    return L.thresholds_frame(spark, thr).select("k", r6(F.col("thr")).alias("thr"))


@register("confident_joint", S.cells(S.confident(PSX), "label", "y_conf"))
def confident_joint(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    return L.confident_joint(p, L.per_class_thresholds(p, 2), calibrate=False)


@register("off_diagonal_rows", f"""SELECT row_id, label, y_conf FROM ({S.confident(PSX)}) c
WHERE y_conf IS NOT NULL AND y_conf <> label""")
def off_diagonal_rows(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    return L.off_diagonal_rows(p, L.per_class_thresholds(p, 2)).select("row_id", "label", "y_conf")


@register("calibrated_joint", S.calibrated_joint_lineitem())
def calibrated_joint(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    return L.confident_joint(p, L.per_class_thresholds(p, 2))


@register("joint_dist", WITH_CJ + """
SELECT k_s, k_y, ROUND(v / SUM(v) OVER (), 6) AS p FROM cj""")
def joint_dist(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    j = L.joint_distribution(L.confident_joint(p, L.per_class_thresholds(p, 2)))
    return j.select("k_s", "k_y", r6(F.col("p")).alias("p"))


@register("num_label_errors", WITH_CJ + """
SELECT CAST(FLOOR((1.0 - SUM(CASE WHEN k_s = k_y THEN v / t END)) * (SELECT COUNT(*) FROM s)) AS BIGINT)
       AS num_errors
FROM cj CROSS JOIN (SELECT CAST(SUM(v) AS DOUBLE) AS t FROM cj) tt""")
def num_label_errors(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    return L.num_label_errors(cj, p.count())


@register("confusion_matrix", S.cells(f"SELECT label, {S.argmax()} AS am FROM ({PSX}) q",
                                      "label", "am"))
def confusion_matrix(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir, checkpoint=False)
    return P.argmax_confusion(p, 2)


ROUND_SRC = """SELECT CAST(l_linenumber AS INT) AS k_s,
       CAST(FLOOR(l_discount * 100) AS INT) % 5 AS k_y,
       SUM(l_quantity) / 7.0 AS v
FROM lineitem GROUP BY 1, 2"""


@register("round_rows", S.round_rows(ROUND_SRC))
def round_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cells = li.groupBy(F.col("l_linenumber").cast("int").alias("k_s"),
                       F.pmod(F.floor(F.col("l_discount") * 100).cast("int"), F.lit(5)).alias("k_y")
                       ).agg((F.sum("l_quantity") / 7.0).alias("v"))
    return L.round_rows(cells)


# ------------------------------------------------------------------ pruning

@register("prune_by_class", WITH_CJ + f""", m AS ({marks_sql()})
SELECT row_id, label FROM m WHERE by_class""")
def prune_by_class(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    by_class, _ = P.budgets(P._cells(cj), {}, 2)
    m_class, _ = P.exact_cut_masks(p, by_class, {}, 2)
    return p.where(m_class).select("row_id", "label")


@register("prune_by_count", WITH_CJ + f""", m AS ({marks_sql()})
SELECT row_id, label FROM m WHERE by_count""")
def prune_by_count(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    _, by_count = P.budgets(P._cells(cj), {}, 2)
    _, m_count = P.exact_cut_masks(p, {}, by_count, 2)
    return p.where(m_count).select("row_id", "label")


LABEL_ERRORS_SQL = WITH_CJ + f""", m AS ({marks_sql()}),
e AS (SELECT row_id, label, own - GREATEST(p0, p1) AS score FROM m
      WHERE by_class AND by_count AND NOT agrees)
SELECT row_id, label, ROUND(score, 6) AS score, ROW_NUMBER() OVER (ORDER BY score, row_id) AS pos
FROM e"""


@register("label_errors_lineitem", LABEL_ERRORS_SQL)
def label_errors_lineitem(spark, sf_dir):
    res = label_errors(lineitem_psx(spark, sf_dir))
    o = res.ordered
    return o.select("row_id", "label", r6(F.col("score")).alias("score"), "pos")


@register("order_errors", WITH_CJ + f""", m AS ({marks_sql()}),
e AS (SELECT row_id, label, own AS score FROM m WHERE by_count AND NOT agrees)
SELECT row_id, label, ROUND(score, 6) AS score, ROW_NUMBER() OVER (ORDER BY score, row_id) AS pos
FROM e""")
def order_errors(spark, sf_dir):
    res = label_errors(lineitem_psx(spark, sf_dir), method="prune_by_noise_rate",
                       order="prob_given_label")
    return res.ordered.select("row_id", "label", r6(F.col("score")).alias("score"), "pos")


@register("baseline_argmax", f"""SELECT row_id, label FROM ({PSX}) q WHERE {S.argmax()} <> label""")
def baseline_argmax(spark, sf_dir):
    return P.baseline_argmax(lineitem_psx(spark, sf_dir, checkpoint=False)).select("row_id", "label")


def _baseline_sql(calibrated: bool) -> str:
    am = S.cells(f"SELECT label, {S.argmax()} AS am FROM s", "label", "am")
    cj = S.calibrate(am, S.class_counts("SELECT * FROM s")) if calibrated else am
    return f"""WITH s AS ({PSX}), cj AS ({cj}), m AS ({marks_sql()})
SELECT row_id, label, {1 if calibrated else 0} AS calibrated FROM m WHERE by_count AND NOT agrees"""


@register("baseline_confusion", "SELECT * FROM (" + _baseline_sql(False) + ") r UNION ALL SELECT * FROM ("
          + _baseline_sql(True) + ") c")
def baseline_confusion(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir, checkpoint=False)
    counts = L.psx_counts(p)
    raw = P.baseline_confusion(p, 2, calibrate=False, counts=counts).where("is_error").select(
        "row_id", "label", F.lit(0).alias("calibrated"))
    cal = P.baseline_confusion(p, 2, calibrate=True, counts=counts).where("is_error").select(
        "row_id", "label", F.lit(1).alias("calibrated"))
    return raw.unionByName(cal)


# Fixed parameters of the prune_counts query: keep at least 2000 per class, half the noise.
PRUNE_KEEP_N = 2000
PRUNE_FRAC = 0.5


@register("prune_counts", WITH_CJ + f""",
t AS (SELECT k_y AS k_s, k_s AS k_y, CAST(v AS DOUBLE) AS v FROM cj),
d AS (SELECT *, MAX(CASE WHEN k_s = k_y THEN v END) OVER (PARTITION BY k_y) AS dg,
             GREATEST(SUM(CASE WHEN v <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY k_y) - 1, 1) AS nnz
      FROM t),
n AS (SELECT *, CASE WHEN k_s = k_y THEN GREATEST(dg, {PRUNE_KEEP_N})
                     ELSE GREATEST(v - (GREATEST(dg, {PRUNE_KEEP_N}) - dg) / nnz, 0.0) END AS nv FROM d),
r AS (SELECT *, CASE WHEN k_s = k_y THEN nv ELSE nv * {PRUNE_FRAC} END AS sv FROM n)
SELECT k_s, k_y, CAST(FLOOR(CASE WHEN k_s = k_y THEN nv + SUM(nv - sv) OVER (PARTITION BY k_y)
                                 ELSE sv END) AS BIGINT) AS v
FROM r""")
def prune_counts(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    return P.keep_at_least_n_per_class(P.transpose(cj), PRUNE_KEEP_N, PRUNE_FRAC)
