"""Latent noise estimation.

K x K objects are long tables ``(k_s, k_y, v)``:

* joint / confident joint: ``v = count(s = k_s, y = k_y)``;
* noise matrix P(s|y): ``v = P(s = k_s | y = k_y)`` (columns k_y sum to 1);
* inverse noise matrix P(y|s): stored with the same keys, ``v = P(y = k_y | s = k_s)``
  (rows k_s sum to 1).

These tables have at most K^2 rows, so their finishing steps (clipping,
normalising, Bayes flips) are small Spark windows; the iterative convergence
(L11) runs on the collected K^2 cells on the driver.  Row-level work (L12,
L7, L18) is one pass of column expressions with the K diagonal values
broadcast as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import labels as L

# Fixed values of the reference's clipping rules.
NOISE_RATE_MAX = 0.9999
PRIOR_MIN = 1e-5
BOUNDARY_START = 0.05
BOUNDARY_STEP = 0.05
BOUNDARY_STOP = 0.9


def _diag(c: str = "k_s", d: str = "k_y") -> Column:
    return F.col(c) == F.col(d)


def clip_noise_rates(m: DataFrame, column_key: str) -> DataFrame:
    """Off-diagonal cells clipped to [0, 0.9999], diagonal kept, then every
    column (cells sharing ``column_key``) divided by its sum."""
    v = F.when(_diag(), F.col("v")).otherwise(F.least(F.greatest(F.col("v"), F.lit(0.0)),
                                                      F.lit(NOISE_RATE_MAX)))
    c = m.withColumn("v", v)
    return c.withColumn("v", F.col("v") / F.sum("v").over(Window.partitionBy(column_key)))


def noise_matrix(cj: DataFrame, clip: bool = True) -> DataFrame:
    """P(s|y) = cj / column total."""
    m = cj.select("k_s", "k_y", (F.col("v") / F.sum("v").over(Window.partitionBy("k_y"))).alias("v"))
    return clip_noise_rates(m, "k_y") if clip else m


def inverse_noise_matrix(cj: DataFrame, clip: bool = True) -> DataFrame:
    """P(y|s) = cj^T / row total (L8), kept in (k_s, k_y) keys."""
    m = cj.select("k_s", "k_y", (F.col("v") / F.sum("v").over(Window.partitionBy("k_s"))).alias("v"))
    return clip_noise_rates(m, "k_s") if clip else m


def class_shares(df: DataFrame, num_classes: int, label: str = "label", weight: str | None = None) -> DataFrame:
    """ps: (k, ps) share of each observed class."""
    cc = L.class_count_frame(df, num_classes, label, weight)
    return cc.select(F.col("k_s").alias("k"),
                     (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("ps"))


def clip_prior(py: DataFrame, low: float = PRIOR_MIN) -> DataFrame:
    """clip to [low, 1], then scale to sum 1."""
    c = py.withColumn("py", F.least(F.greatest(F.col("py"), F.lit(low)), F.lit(1.0)))
    return c.withColumn("py", F.col("py") * F.lit(1.0) / F.sum("py").over(Window.partitionBy()))


def latent_prior(ps: DataFrame, nm: DataFrame, inv: DataFrame, method: str = "cnt",
                 cj: DataFrame | None = None) -> DataFrame:
    """P(y) as (k, py).

    ``cnt``: diag(inv) / diag(nm) * ps; ``marginal``: column share of the joint;
    ``marginal_ps``: inv . ps.  Clipped to >= 1e-5 and renormalised.
    """
    if method == "cnt":
        dn = nm.where(_diag()).select(F.col("k_s").alias("k"), F.col("v").alias("dn"))
        di = inv.where(_diag()).select(F.col("k_s").alias("k"), F.col("v").alias("di"))
        py = ps.join(dn, "k").join(di, "k").select("k", (F.col("di") / F.col("dn") * F.col("ps")).alias("py"))
    elif method == "marginal":
        if cj is None:
            raise ValueError("marginal needs the joint")
        yc = cj.groupBy(F.col("k_y").alias("k")).agg(F.sum("v").alias("yc"))
        py = yc.select("k", (F.col("yc") / F.sum("yc").over(Window.partitionBy())).alias("py"))
    elif method == "marginal_ps":
        # py[y] = sum_s P(y|s) ps[s]
        j = inv.join(ps.withColumnRenamed("k", "k_s"), "k_s")
        py = j.groupBy(F.col("k_y").alias("k")).agg(F.sum(F.col("v") * F.col("ps")).alias("py"))
    else:
        raise ValueError(f"unknown py method {method!r}")
    return clip_prior(py)


def estimate_latent(cj: DataFrame, df: DataFrame, num_classes: int, py_method: str = "cnt",
                    label: str = "label", weight: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(py, noise matrix, inverse noise matrix); py from the unclipped matrices."""
    ps = class_shares(df, num_classes, label, weight)
    nm0 = noise_matrix(cj, clip=False)
    inv0 = inverse_noise_matrix(cj, clip=False)
    py = latent_prior(ps, nm0, inv0, py_method, cj)
    return py, clip_noise_rates(nm0, "k_y"), clip_noise_rates(inv0, "k_s")


def bayes_inverse(nm: DataFrame, py: DataFrame, ps: DataFrame) -> DataFrame:
    """P(y|s) = P(s|y) P(y) / P(s), clipped."""
    j = (nm.join(py.withColumnRenamed("k", "k_y"), "k_y")
         .join(ps.withColumnRenamed("k", "k_s"), "k_s"))
    m = j.select("k_s", "k_y", (F.col("v") * F.col("py") / F.col("ps")).alias("v"))
    return clip_noise_rates(m, "k_s")


def noise_from_inverse(inv: DataFrame, ps: DataFrame, py: DataFrame | None = None) -> DataFrame:
    """P(s|y) = P(y|s) P(s) / P(y), clipped; P(y) defaults to the joint's column sums."""
    j = inv.join(ps.withColumnRenamed("k", "k_s"), "k_s").select(
        "k_s", "k_y", (F.col("v") * F.col("ps")).alias("joint"))
    if py is None:
        j = j.withColumn("_py", F.sum("joint").over(Window.partitionBy("k_y")))
    else:
        j = j.join(py.select(F.col("k").alias("k_y"), F.col("py").alias("_py")), "k_y")
    m = j.select("k_s", "k_y", (F.col("joint") / F.col("_py")).alias("v"))
    return clip_noise_rates(m, "k_y")


# ------------------------------------------------------------------ L11 (driver, K^2 cells)

def _mat(df: DataFrame, K: int) -> list:
    m = [[0.0] * K for _ in range(K)]
    for r in df.collect():
        m[r["k_s"]][r["k_y"]] = float(r["v"])
    return m


def _clip_cols(m: list, by_row: bool) -> list:
    """clip_noise_rates on a python matrix stored as m[k_s][k_y]."""
    K = len(m)
    c = [[m[a][b] if a == b else min(max(m[a][b], 0.0), NOISE_RATE_MAX) for b in range(K)]
         for a in range(K)]
    if by_row:  # inverse: normalise over k_y for each k_s
        return [[c[a][b] / sum(c[a]) for b in range(K)] for a in range(K)]
    tot = [sum(c[a][b] for a in range(K)) for b in range(K)]
    return [[c[a][b] / tot[b] for b in range(K)] for a in range(K)]


def _clip_py(py: list) -> list:
    x = [min(max(v, PRIOR_MIN), 1.0) for v in py]
    s = sum(x)
    return [v * 1.0 / s for v in x]


def converge_latent(ps: list, py: list, nm: list, inv: list, inv_iters: int = 5,
                    nm_iters: int = 3) -> tuple[list, list, list]:
    """nm_iters x (inv_iters x (inverse from nm, prior 'cnt'), nm from inverse),
    then the final clipping.  Works on the K^2 cells (m[k_s][k_y])."""
    K = len(ps)
    for _ in range(nm_iters):
        for _ in range(inv_iters):
            inv = _clip_cols([[nm[a][b] * py[b] / ps[a] for b in range(K)] for a in range(K)], True)
            py = _clip_py([inv[k][k] / nm[k][k] * ps[k] for k in range(K)])
        joint = [[inv[a][b] * ps[a] for b in range(K)] for a in range(K)]
        nm = _clip_cols([[joint[a][b] / py[b] for b in range(K)] for a in range(K)], False)
    return _clip_py(py), _clip_cols(nm, False), _clip_cols(inv, True)


# ------------------------------------------------------------------ L12, L13

def corrected_probabilities(df: DataFrame, nm_diag: list, inv_diag: list, psx: str = "psx",
                            name: str = "pyx") -> DataFrame:
    """P(y|x) ∝ psx * diag(inv) / diag(nm), clipped to [0, 1], rows sum to 1."""
    K = len(nm_diag)
    raw = [F.least(F.greatest(F.element_at(F.col(psx), k + 1) * F.lit(float(inv_diag[k]))
                              / F.lit(float(nm_diag[k])), F.lit(0.0)), F.lit(1.0)) for k in range(K)]
    d = df.withColumn("_pyx", F.array(*raw))
    tot = None
    for k in range(K):
        t = F.element_at(F.col("_pyx"), k + 1)
        tot = t if tot is None else tot + t
    out = F.array(*[F.element_at(F.col("_pyx"), k + 1) * F.lit(1.0) / tot for k in range(K)])
    return d.withColumn(name, out).drop("_pyx")


def remove_noise_from_class(nm: DataFrame, clean_class: int) -> DataFrame:
    """Class ``clean_class`` is never a noisy label of another class (its row
    off the diagonal is zeroed); each diagonal becomes 1 - rest of its column."""
    zeroed = nm.withColumn("v", F.when((F.col("k_s") == clean_class) & ~_diag(), F.lit(0.0))
                           .otherwise(F.col("v")))
    rest = F.sum(F.when(~_diag(), F.col("v")).otherwise(F.lit(0.0))).over(Window.partitionBy("k_y"))
    return zeroed.withColumn("v", F.when(_diag(), F.lit(1.0) - rest).otherwise(F.col("v")))


# ------------------------------------------------------------------ A9

def pu_f1(df: DataFrame, prob: Column, label: str = "label") -> DataFrame:
    """recall^2 / (2 P(pred = 1)) with pred = prob >= 0.5; NULL if nothing predicted."""
    pred = prob >= 0.5
    a = df.agg(F.count(F.when((F.col(label) == 1) & pred, 1)).alias("tp"),
               F.sum(F.col(label)).alias("pos"),
               F.count(F.when(pred, 1)).alias("npred"),
               F.count(F.lit(1)).alias("n"))
    recall = F.col("tp") / F.col("pos")
    frac = F.col("npred") / F.col("n")
    return a.select(F.when(F.col("npred") != 0, recall * recall / (F.lit(2.0) * frac)).alias("pu_f1"))


# ------------------------------------------------------------------ L7, L18 multi-label

def multilabel_thresholds(df: DataFrame, num_classes: int, labels: str = "labels",
                          psx: str = "psx") -> list:
    """Mean of psx[k] over rows whose label list contains k (one aggregation)."""
    r = df.agg(*[F.avg(F.when(F.array_contains(F.col(labels), k),
                              F.element_at(F.col(psx), k + 1))).alias(f"t{k}")
                 for k in range(num_classes)]).first()
    return [r[f"t{k}"] for k in range(num_classes)]


def multilabel_joint(df: DataFrame, num_classes: int, labels: str = "labels", psx: str = "psx",
                     thresholds: list | None = None, calibrate: bool = True) -> DataFrame:
    """cj[k][j] = rows with k in their labels and psx[j] >= thr[j] (double
    counting allowed); K comes from the classes, thresholds are honoured (D10).
    Calibration uses the label total (each label of each row counts once)."""
    K = num_classes
    thr = thresholds if thresholds is not None else multilabel_thresholds(df, K, labels, psx)
    aggs = []
    for k in range(K):
        for j in range(K):
            aggs.append(F.count(F.when(F.array_contains(F.col(labels), k) &
                                       (F.element_at(F.col(psx), j + 1) >= F.lit(float(thr[j]))), 1))
                        .alias(f"c_{k}_{j}"))
    wide = df.agg(*aggs, *[F.count(F.when(F.array_contains(F.col(labels), k), 1)).alias(f"n_{k}")
                           for k in range(K)])
    stack = ", ".join(f"{k}, {j}, c_{k}_{j}" for k in range(K) for j in range(K))
    cj = wide.selectExpr(f"stack({K * K}, {stack}) AS (k_s, k_y, v)").select(
        F.col("k_s").cast("int"), F.col("k_y").cast("int"), F.col("v").cast("bigint"))
    if not calibrate:
        return cj
    nst = ", ".join(f"{k}, n_{k}" for k in range(K))
    counts = wide.selectExpr(f"stack({K}, {nst}) AS (k_s, n)").select(
        F.col("k_s").cast("int"), F.col("n").cast("bigint"))
    return L.calibrate_joint(cj, counts)


def boundaries() -> list:
    out = []
    i = 0
    while True:
        b = BOUNDARY_START + i * BOUNDARY_STEP
        if b >= BOUNDARY_STOP - 1e-12:
            break
        out.append(b)
        i += 1
    return out


def multilabel_boundary(df: DataFrame, num_classes: int, labels: str = "labels",
                        pyx: str = "psx") -> DataFrame:
    """Micro-F1 of ``pyx > b`` against the label lists for b in 0.05..0.85;
    all boundaries are scored in ONE aggregation (no join), ``best`` marks the
    first boundary with the highest F1."""
    K = num_classes
    bs = boundaries()
    aggs = []
    for i, b in enumerate(bs):
        tp = fp = fn = None
        for k in range(K):
            p = F.element_at(F.col(pyx), k + 1) > F.lit(b)
            y = F.array_contains(F.col(labels), k)
            t1, t2, t3 = (F.when(p & y, 1).otherwise(0), F.when(p & ~y, 1).otherwise(0),
                          F.when(~p & y, 1).otherwise(0))
            tp = t1 if tp is None else tp + t1
            fp = t2 if fp is None else fp + t2
            fn = t3 if fn is None else fn + t3
        aggs += [F.sum(tp).alias(f"tp{i}"), F.sum(fp).alias(f"fp{i}"), F.sum(fn).alias(f"fn{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{i}, CAST({b!r} AS DOUBLE), tp{i}, fp{i}, fn{i}" for i, b in enumerate(bs))
    long = wide.selectExpr(f"stack({len(bs)}, {stack}) AS (i, boundary, tp, fp, fn)")
    f1 = F.when((2 * F.col("tp") + F.col("fp") + F.col("fn")) > 0,
                2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0))
    long = long.withColumn("f1", f1)
    w = Window.orderBy(F.col("f1").desc(), F.col("i").asc())  # 17 rows
    return long.withColumn("best", F.row_number().over(w) == 1).select(
        "boundary", F.col("tp").cast("bigint"), F.col("fp").cast("bigint"),
        F.col("fn").cast("bigint"), "f1", "best")


# ------------------------------------------------------------------ L23

def adjusted_thresholds(df: DataFrame, num_classes: int, epochs: int = 10, label: str = "label",
                        psx: str = "psx") -> list:
    """Start from per-class mean probabilities, then ``epochs`` rounds of
    ``thr += 0.5 * (row share of the uncalibrated joint - P(s))``; each round is
    one aggregation over the rows, the thresholds are re-broadcast as literals."""
    K = num_classes
    r = df.agg(*[F.avg(F.when(F.col(label) == k, F.element_at(F.col(psx), k + 1))).alias(f"m{k}")
                 for k in range(K)]).first()
    thr = [r[f"m{k}"] for k in range(K)]
    sizes = L.class_sizes(df, label, K)
    n = float(sum(sizes.values()))
    ps = [sizes[k] / n for k in range(K)]
    for _ in range(epochs):
        cj = _mat(L.confident_joint(df, thr, label, psx, calibrate=False), K)
        tot = float(sum(map(sum, cj))) or 1.0
        share = [sum(cj[k]) / tot for k in range(K)]
        thr = [thr[k] + 0.5 * (share[k] - ps[k]) for k in range(K)]
    return thr
