"""Queries of latent estimation and noise."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.keys import key_sql, r6
from ..operators import labels as L
from ..operators import latent as LT
from ..operators import sampling as SM
from ..session import cut_lineage
from ..sources.tables import multi_label_documents, noisy_lineitem
from . import sqlparts as S
from .catalog import register
from .label_errors import lineitem_psx, p_columns
from .q_labels import WITH_CJ


def _latent(spark, sf_dir, method="cnt"):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    py, nm, inv = LT.estimate_latent(cj, p, 2, method)
    return p, cj, py, nm, inv


def _clip_sql(src: str, col_key: str) -> str:
    return f"""SELECT k_s, k_y, v / SUM(v) OVER (PARTITION BY {col_key}) AS v FROM (
  SELECT k_s, k_y, CASE WHEN k_s = k_y THEN v ELSE LEAST(GREATEST(v, 0.0), {LT.NOISE_RATE_MAX}) END AS v
  FROM ({src}) c0) c1"""


NM0 = "SELECT k_s, k_y, v / SUM(v) OVER (PARTITION BY k_y) AS v FROM cj"
INV0 = "SELECT k_s, k_y, v / SUM(v) OVER (PARTITION BY k_s) AS v FROM cj"
PS = """SELECT k_s AS k, n / SUM(n) OVER () AS ps FROM ({cc})""".format(
    cc=S.class_counts("SELECT * FROM s"))


def _prior_sql(method: str) -> str:
    if method == "cnt":
        raw = f"""SELECT ps.k, i.v / n.v * ps.ps AS py FROM ({PS}) ps
  JOIN ({NM0}) n ON n.k_s = ps.k AND n.k_y = ps.k JOIN ({INV0}) i ON i.k_s = ps.k AND i.k_y = ps.k"""
    elif method == "marginal":
        raw = "SELECT k_y AS k, SUM(v) / SUM(SUM(v)) OVER () AS py FROM cj GROUP BY k_y"
    else:
        raw = f"""SELECT i.k_y AS k, SUM(i.v * ps.ps) AS py FROM ({INV0}) i JOIN ({PS}) ps ON ps.k = i.k_s
  GROUP BY i.k_y"""
    return f"""SELECT k, c * 1.0 / SUM(c) OVER () AS py FROM (
  SELECT k, LEAST(GREATEST(py, {LT.PRIOR_MIN}), 1.0) AS c FROM ({raw}) r0) r1"""


@register("noise_matrix", WITH_CJ + f"""
SELECT 'noise' AS kind, k_s, k_y, ROUND(v, 6) AS v FROM ({_clip_sql(NM0, 'k_y')}) a
UNION ALL SELECT 'inverse', k_s, k_y, ROUND(v, 6) FROM ({_clip_sql(INV0, 'k_s')}) b""")
def noise_matrix(spark, sf_dir):
    _, _, _, nm, inv = _latent(spark, sf_dir)
    return (nm.select(F.lit("noise").alias("kind"), "k_s", "k_y", r6(F.col("v")).alias("v"))
            .unionByName(inv.select(F.lit("inverse").alias("kind"), "k_s", "k_y",
                                    r6(F.col("v")).alias("v"))))


@register("latent_prior", WITH_CJ + "\n" + " UNION ALL ".join(
    f"SELECT '{m}' AS method, CAST(k AS INT) AS k, ROUND(py, 6) AS py FROM ({_prior_sql(m)}) p_{m}"
    for m in ("cnt", "marginal", "marginal_ps")))
def latent_prior(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    cj = L.confident_joint(p, L.per_class_thresholds(p, 2))
    out = None
    for m in ("cnt", "marginal", "marginal_ps"):
        py, _, _ = LT.estimate_latent(cj, p, 2, m)
        part = py.select(F.lit(m).alias("method"), F.col("k").cast("int").alias("k"),
                         r6(F.col("py")).alias("py"))
        out = part if out is None else out.unionByName(part)
    return out


BAYES_SQL = WITH_CJ + f""",
nm AS ({_clip_sql(NM0, 'k_y')}),
py AS ({_prior_sql('cnt')}),
ps AS ({PS}),
inv AS ({_clip_sql('SELECT nm.k_s, nm.k_y, nm.v * py.py / ps.ps AS v FROM nm JOIN py ON py.k = nm.k_y JOIN ps ON ps.k = nm.k_s', 'k_s')}),
jt AS (SELECT inv.k_s, inv.k_y, inv.v * ps.ps AS joint FROM inv JOIN ps ON ps.k = inv.k_s),
back AS ({_clip_sql('SELECT k_s, k_y, joint / SUM(joint) OVER (PARTITION BY k_y) AS v FROM jt', 'k_y')})
SELECT 'inverse' AS kind, k_s, k_y, ROUND(v, 6) AS v FROM inv
UNION ALL SELECT 'noise', k_s, k_y, ROUND(v, 6) FROM back"""


@register("bayes_flip", BAYES_SQL)
def bayes_flip(spark, sf_dir):
    p, cj, py, nm, _ = _latent(spark, sf_dir)
    ps = LT.class_shares(p, 2)
    inv = LT.bayes_inverse(nm, py, ps)
    back = LT.noise_from_inverse(inv, ps)
    return (inv.select(F.lit("inverse").alias("kind"), "k_s", "k_y", r6(F.col("v")).alias("v"))
            .unionByName(back.select(F.lit("noise").alias("kind"), "k_s", "k_y",
                                     r6(F.col("v")).alias("v"))))


def _diag_vals(m):
    return {r["k_s"]: r["v"] for r in m.where(F.col("k_s") == F.col("k_y")).collect()}


@register("corrected_probs", WITH_CJ + f""",
nm AS ({_clip_sql(NM0, 'k_y')}), inv AS ({_clip_sql(INV0, 'k_s')}),
d AS (SELECT MAX(CASE WHEN nm.k_s = 0 THEN inv.v / nm.v END) AS r0_unused,
             MAX(CASE WHEN nm.k_s = 0 THEN nm.v END) AS n0, MAX(CASE WHEN nm.k_s = 1 THEN nm.v END) AS n1,
             MAX(CASE WHEN nm.k_s = 0 THEN inv.v END) AS i0, MAX(CASE WHEN nm.k_s = 1 THEN inv.v END) AS i1
      FROM nm JOIN inv ON nm.k_s = inv.k_s AND nm.k_y = inv.k_y WHERE nm.k_s = nm.k_y),
c AS (SELECT row_id, LEAST(GREATEST(p0 * i0 / n0, 0.0), 1.0) AS a0,
             LEAST(GREATEST(p1 * i1 / n1, 0.0), 1.0) AS a1 FROM s CROSS JOIN d)
SELECT row_id, ROUND(a0 * 1.0 / (a0 + a1), 6) AS p0, ROUND(a1 * 1.0 / (a0 + a1), 6) AS p1 FROM c""")
def corrected_probs(spark, sf_dir):
    p, _, _, nm, inv = _latent(spark, sf_dir)
    dn, di = _diag_vals(nm), _diag_vals(inv)
    out = LT.corrected_probabilities(p, [dn[0], dn[1]], [di[0], di[1]])
    return out.select("row_id", *p_columns(out, 2, "pyx"))


@register("pu_clean_class", WITH_CJ + f""",
nm AS ({_clip_sql(NM0, 'k_y')}),
z AS (SELECT k_s, k_y, CASE WHEN k_s = 1 AND k_s <> k_y THEN 0.0 ELSE v END AS v FROM nm)
SELECT k_s, k_y, ROUND(CASE WHEN k_s = k_y THEN 1.0 - SUM(CASE WHEN k_s <> k_y THEN v ELSE 0.0 END)
                                             OVER (PARTITION BY k_y) ELSE v END, 6) AS v FROM z""")
def pu_clean_class(spark, sf_dir):
    _, _, _, nm, _ = _latent(spark, sf_dir)
    return LT.remove_noise_from_class(nm, 1).select("k_s", "k_y", r6(F.col("v")).alias("v"))


@register("pu_f1", f"""SELECT ROUND(CASE WHEN npred <> 0 THEN (tp / pos) * (tp / pos) / (2.0 * (npred / n)) END, 6)
       AS pu_f1
FROM (SELECT COUNT(CASE WHEN label = 1 AND p1 >= 0.5 THEN 1 END) AS tp, SUM(label) AS pos,
             COUNT(CASE WHEN p1 >= 0.5 THEN 1 END) AS npred, COUNT(*) AS n FROM ({S.psx_lineitem()}) q) a""")
def pu_f1(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir, checkpoint=False)
    return LT.pu_f1(p, F.element_at(F.col("psx"), 2)).select(r6(F.col("pu_f1")).alias("pu_f1"))


# ------------------------------------------------------------------ multi-label

F6 = f"""SELECT *, CASE WHEN toxic = 1 THEN [label, 2] ELSE [label] END AS labels
FROM ({S.F4}) d WHERE label IS NOT NULL"""


def multi_psx_sql(K: int = 3) -> str:
    counts = ", ".join(f"COUNT(CASE WHEN list_contains(labels, {k}) THEN 1 END) AS f{k}" for k in range(K))
    loo = ", ".join(f"SUM(f{k}) OVER (PARTITION BY c_1) - f{k} AS n{k}" for k in range(K))
    ps = ", ".join(f"CAST(lk.n{k} + 1 AS DOUBLE) / (lk.nn + {K}) AS p{k}" for k in range(K))
    fo = S.folds(F6)
    return f"""SELECT s.*, {ps} FROM ({fo}) s LEFT JOIN (
  SELECT c_1 AS lc, fold AS lf, SUM(fn) OVER (PARTITION BY c_1) - fn AS nn, {loo}
  FROM (SELECT c_1, fold, COUNT(*) AS fn, {counts} FROM ({fo}) a GROUP BY c_1, fold) pf) lk
  ON s.c_1 IS NOT DISTINCT FROM lk.lc AND s.fold = lk.lf"""


def multi_psx(spark, sf_dir):
    d = multi_label_documents(spark, sf_dir).select("row_id", "c_1", "label", "labels")
    return L.fold_rate_psx_multi(L.stratified_folds(d, 5, 0, write=True), "c_1", 3)


def multi_joint_sql(K: int = 3) -> str:
    thr = ", ".join(f"AVG(CASE WHEN list_contains(labels, {k}) THEN p{k} END) AS t{k}" for k in range(K))
    cells = " UNION ALL ".join(
        f"SELECT {k} AS k_s, {j} AS k_y, COUNT(CASE WHEN list_contains(labels, {k}) AND p{j} >= t{j} THEN 1 END) AS v FROM m CROSS JOIN th"
        for k in range(K) for j in range(K))
    cnt = " UNION ALL ".join(
        f"SELECT {k} AS k_s, COUNT(CASE WHEN list_contains(labels, {k}) THEN 1 END) AS n FROM m" for k in range(K))
    return f"""WITH m AS ({multi_psx_sql(K)}), th AS (SELECT {thr} FROM m)
SELECT * FROM ({S.calibrate(f'SELECT CAST(k_s AS INT) AS k_s, CAST(k_y AS INT) AS k_y, CAST(v AS BIGINT) AS v FROM ({cells}) c',
                            f'SELECT CAST(k_s AS INT) AS k_s, CAST(n AS BIGINT) AS n FROM ({cnt}) n')}) r"""


@register("joint_multilabel", multi_joint_sql(3))
def joint_multilabel(spark, sf_dir):
    return LT.multilabel_joint(multi_psx(spark, sf_dir), 3)


def boundary_sql(K: int = 3) -> str:
    bs = LT.boundaries()
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, CAST({b!r} AS DOUBLE) AS boundary, " +
        " + ".join(f"COUNT(CASE WHEN p{k} > CAST({b!r} AS DOUBLE) AND list_contains(labels, {k}) THEN 1 END)" for k in range(K)) + " AS tp, " +
        " + ".join(f"COUNT(CASE WHEN p{k} > CAST({b!r} AS DOUBLE) AND NOT list_contains(labels, {k}) THEN 1 END)" for k in range(K)) + " AS fp, " +
        " + ".join(f"COUNT(CASE WHEN NOT (p{k} > CAST({b!r} AS DOUBLE)) AND list_contains(labels, {k}) THEN 1 END)" for k in range(K)) + " AS fn FROM m"
        for i, b in enumerate(bs))
    return f"""WITH m AS ({multi_psx_sql(K)}), s AS ({rows}),
f AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM s)
SELECT ROUND(boundary, 6) AS boundary, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, ROUND(f1, 6) AS f1,
       ROW_NUMBER() OVER (ORDER BY f1 DESC, i) = 1 AS best FROM f"""


@register("multilabel_boundary", boundary_sql(3))
def multilabel_boundary(spark, sf_dir):
    b = LT.multilabel_boundary(multi_psx(spark, sf_dir), 3)
    return b.select(r6(F.col("boundary")).alias("boundary"), "tp", "fp", "fn",
                    r6(F.col("f1")).alias("f1"), "best")


# ------------------------------------------------------------------ L21, L22

# Fixed parameters of the noise queries: P(s | y) for two classes, columns sum to 1.
NOISE_MATRIX = [[0.8, 0.3], [0.2, 0.7]]
NOISE_SEED = 7


def _inject_sql() -> str:
    nm = NOISE_MATRIX
    return f"""WITH f AS (SELECT row_id, y_true FROM ({S.F2}) a),
c AS (SELECT y_true, COUNT(*) AS cnt, (SELECT COUNT(*) FROM f) AS n FROM f GROUP BY y_true),
fl AS (SELECT y_true, CAST(FLOOR(CASE WHEN y_true = 0 THEN {nm[1][0]} ELSE {nm[0][1]} END
                                 * (cnt / n) * n) AS BIGINT) AS flips, cnt FROM c),
r AS (SELECT f.*, ROW_NUMBER() OVER (PARTITION BY y_true ORDER BY {key_sql('row_id', NOISE_SEED, 'noise')}, row_id) AS pos
      FROM f)
SELECT row_id, y_true, CAST(CASE WHEN fl.flips > 0 AND fl.cnt >= fl.flips AND pos <= fl.flips
                            THEN 1 - r.y_true ELSE r.y_true END AS INT) AS s
FROM r JOIN fl USING (y_true)"""


@register("inject_noise", _inject_sql())
def inject_noise(spark, sf_dir):
    f = noisy_lineitem(spark, sf_dir).select("row_id", "y_true")
    return SM.inject_label_noise(f, NOISE_MATRIX, NOISE_SEED).select("row_id", "y_true", "s")


@register("matrix_valid", f"""WITH f AS (SELECT y_true FROM ({S.F2}) a),
py AS (SELECT CAST(y_true AS INT) AS k, COUNT(*) / (SELECT COUNT(*) FROM f) AS py FROM f GROUP BY y_true),
nm(k_s, k_y, v) AS (VALUES (0, 0, {NOISE_MATRIX[0][0]}), (0, 1, {NOISE_MATRIX[0][1]}),
                           (1, 0, {NOISE_MATRIX[1][0]}), (1, 1, {NOISE_MATRIX[1][1]})),
j AS (SELECT k_s, k_y, CAST(v AS DOUBLE) * py AS joint FROM nm JOIN py ON py.k = nm.k_y),
ps AS (SELECT k_s AS k, SUM(joint) AS ps FROM j GROUP BY k_s),
chk AS (SELECT j.k_s, ps.ps * py.py < j.joint AS ok FROM j JOIN ps ON ps.k = j.k_s
        JOIN py ON py.k = j.k_s WHERE j.k_s = j.k_y)
SELECT ABS((SELECT SUM(joint) FROM j) - 1) < 1e-6 AND BOOL_AND(ok) AS valid FROM chk""")
def matrix_valid(spark, sf_dir):
    f = noisy_lineitem(spark, sf_dir).select("y_true")
    py = f.groupBy(F.col("y_true").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("c"))
    py = py.select("k", (F.col("c") / F.sum("c").over(Window.partitionBy())).alias("py"))
    return valid_frame(spark, py)


def valid_frame(spark, py_df):
    """L22 over the K x K cells: joint sums to 1 and ps_k * py_k < joint_kk for all k
    (one windowed aggregation over at most K^2 rows)."""
    nm = spark.createDataFrame([(a, b, float(NOISE_MATRIX[a][b])) for a in range(2) for b in range(2)],
                               "k_s int, k_y int, v double")
    j = nm.join(F.broadcast(py_df.withColumnRenamed("k", "k_y")), "k_y").select(
        "k_s", "k_y", "py", (F.col("v") * F.col("py")).alias("joint"))
    j = (j.withColumn("ps", F.sum("joint").over(Window.partitionBy("k_s")))
         .withColumn("total", F.sum("joint").over(Window.partitionBy())))
    diag = F.col("k_s") == F.col("k_y")
    return j.agg(((F.abs(F.max("total") - 1) < 1e-6) &
                  F.bool_and(F.when(diag, F.col("ps") * F.col("py") < F.col("joint")))).alias("valid"))


# ------------------------------------------------------------------ rows-only

def _converge_sql(inv_iters: int = 5, nm_iters: int = 3) -> str:
    """L11 unrolled over the K^2 cells (same float operation order as the driver loop)."""
    clip_row = lambda src: _clip_sql(src, "k_s")
    clip_col = lambda src: _clip_sql(src, "k_y")

    def clip_py(src):
        return f"""SELECT k, c * 1.0 / SUM(c) OVER () AS py FROM (
  SELECT k, LEAST(GREATEST(py, {LT.PRIOR_MIN}), 1.0) AS c FROM ({src}) q0) q1"""

    ctes = [f"nm_0 AS ({_clip_sql(NM0, 'k_y')})", f"py_0 AS ({_prior_sql('cnt')})", f"ps AS ({PS})"]
    nm, py, inv = "nm_0", "py_0", None
    step = 0
    for j in range(nm_iters):
        for i in range(inv_iters):
            step += 1
            ctes.append(f"""inv_{step} AS ({clip_row(f'SELECT n.k_s, n.k_y, n.v * p.py / s.ps AS v FROM {nm} n JOIN {py} p ON p.k = n.k_y JOIN ps s ON s.k = n.k_s')})""")
            inv = f"inv_{step}"
            ctes.append(f"""py_{step} AS ({clip_py(f'SELECT i.k_s AS k, i.v / n.v * s.ps AS py FROM {inv} i JOIN {nm} n ON n.k_s = i.k_s AND n.k_y = i.k_y JOIN ps s ON s.k = i.k_s WHERE i.k_s = i.k_y')})""")
            py = f"py_{step}"
        ctes.append(f"""nm_{j + 1} AS ({clip_col(f'SELECT i.k_s, i.k_y, i.v * s.ps / p.py AS v FROM {inv} i JOIN ps s ON s.k = i.k_s JOIN {py} p ON p.k = i.k_y')})""")
        nm = f"nm_{j + 1}"
    return WITH_CJ + ",\n" + ",\n".join(ctes) + f"""
SELECT 'prior' AS kind, CAST(k AS INT) AS k_s, CAST(k AS INT) AS k_y, ROUND(py, 6) AS v FROM ({clip_py(f'SELECT * FROM {py}')}) a
UNION ALL SELECT 'noise', k_s, k_y, ROUND(v, 6) FROM ({clip_col(f'SELECT * FROM {nm}')}) b
UNION ALL SELECT 'inverse', k_s, k_y, ROUND(v, 6) FROM ({clip_row(f'SELECT * FROM {inv}')}) c"""


@register("converge_latent", _converge_sql())
def converge_latent(spark, sf_dir):
    p, cj, py, nm, inv = _latent(spark, sf_dir)
    K = 2
    ps = {r["k"]: r["ps"] for r in LT.class_shares(p, K).collect()}
    pyd = {r["k"]: r["py"] for r in py.collect()}
    py2, nm2, inv2 = LT.converge_latent([ps[k] for k in range(K)], [pyd[k] for k in range(K)],
                                        LT._mat(nm, K), LT._mat(inv, K))
    rows = ([("prior", k, k, float(py2[k])) for k in range(K)] +
            [("noise", a, b, float(nm2[a][b])) for a in range(K) for b in range(K)] +
            [("inverse", a, b, float(inv2[a][b])) for a in range(K) for b in range(K)])
    out = spark.createDataFrame(rows, "kind string, k_s int, k_y int, v double")
    return out.select("kind", "k_s", "k_y", r6(F.col("v")).alias("v"))


ADJUST_EPOCHS = 3


def _adjust_sql(epochs: int = ADJUST_EPOCHS) -> str:
    """L23 unrolled: each round counts the uncalibrated joint's rows under the
    current thresholds and moves them half way towards P(s)."""
    flags = ["(p0 >= t.t0 - 1e-6)", "(p1 >= t.t1 - 1e-6)"]
    nconf = " + ".join(f"CAST(COALESCE({f}, FALSE) AS INT)" for f in flags)
    yc = f"""CASE WHEN {nconf} = 1 THEN CASE WHEN {flags[0]} THEN 0 ELSE 1 END
               WHEN {nconf} > 1 THEN {S.argmax()} END"""
    ctes = [f"s AS ({S.psx_lineitem()})",
            """ps AS (SELECT COUNT(CASE WHEN label = 0 THEN 1 END) / COUNT(*) AS ps0,
                   COUNT(CASE WHEN label = 1 THEN 1 END) / COUNT(*) AS ps1 FROM s)""",
            """r0 AS (SELECT AVG(CASE WHEN label = 0 THEN p0 END) AS t0,
                   AVG(CASE WHEN label = 1 THEN p1 END) AS t1 FROM s)"""]
    for e in range(1, epochs + 1):
        ctes.append(f"""c{e} AS (SELECT label, {yc} AS yc FROM s CROSS JOIN r{e - 1} t)""")
        ctes.append(f"""r{e} AS (SELECT t.t0 + 0.5 * (sh0 - ps.ps0) AS t0, t.t1 + 0.5 * (sh1 - ps.ps1) AS t1
  FROM r{e - 1} t CROSS JOIN ps CROSS JOIN (
    SELECT COUNT(CASE WHEN label = 0 AND yc IS NOT NULL THEN 1 END)
             / CASE WHEN COUNT(yc) = 0 THEN 1.0 ELSE CAST(COUNT(yc) AS DOUBLE) END AS sh0,
           COUNT(CASE WHEN label = 1 AND yc IS NOT NULL THEN 1 END)
             / CASE WHEN COUNT(yc) = 0 THEN 1.0 ELSE CAST(COUNT(yc) AS DOUBLE) END AS sh1
    FROM c{e}) sh)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT 0 AS k, ROUND(t0, 6) AS thr FROM r{epochs} UNION ALL SELECT 1, ROUND(t1, 6) FROM r{epochs}"""


@register("adjusted_thresholds", _adjust_sql())
def adjusted_thresholds(spark, sf_dir):
    p = lineitem_psx(spark, sf_dir)
    thr = LT.adjusted_thresholds(p, 2, epochs=ADJUST_EPOCHS)
    return L.thresholds_frame(spark, thr).select("k", r6(F.col("thr")).alias("thr"))
