"""Finding label errors: rank pruning by class and by noise rate.

Cuts are exact order statistics.  The default path finds each cut with
:func:`kth_smallest` (a few aggregation passes, the class never sits in one
task) and then marks rows with a plain filter expression.  The window forms
(``*_window``) give the same answer and are kept for tests and small data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import argmax_first
from ..functions.ranking import global_row_number, kth_smallest
from . import labels as L
from . import latent as LT


def _cells(cj: DataFrame) -> dict:
    return {(r["k_s"], r["k_y"]): r["v"] for r in cj.collect()}  # K*K rows


def budgets(cj_cells: dict, sizes: dict, K: int, budget: str = "reference", frac_noise: float = 1.0,
            num_to_remove: dict | None = None, spark=None) -> tuple[dict, dict]:
    """Per-class prune budgets.

    Returns ``(by_class, by_count)``: ``by_class[k]`` rows of class k to drop by
    self-confidence; ``by_count[(k, j)]`` rows of class k to drop by margin
    ``p_j - p_k``.  ``reference`` (K = 2 only) reproduces the forced budget of the
    original (by class: class 0 loses cj[1,0], class 1 loses cj[0,1]); ``own``
    gives class k the off-diagonal mass of its own row, of which ``frac_noise`` is
    used, or which is scaled to ``num_to_remove[k]`` rows (rounded by W6).
    """
    if budget == "reference":
        if K != 2:
            raise ValueError("budget='reference' is defined for two classes only")
        by_class = {0: int(cj_cells[(1, 0)]), 1: int(cj_cells[(0, 1)])}
        by_count = {(0, 1): int(cj_cells[(0, 1)]), (1, 0): int(cj_cells[(1, 0)])}
        return by_class, by_count
    pairs = [(k, j) for k in range(K) for j in range(K) if j != k]
    if num_to_remove is None:
        by_count = {(k, j): int(cj_cells[(k, j)] * frac_noise) for k, j in pairs}
    else:
        noise = {k: sum(cj_cells[(k, j)] for j in range(K) if j != k) for k in range(K)}
        cells = [(k, j, cj_cells[(k, j)] / noise[k] * num_to_remove.get(k, 0) if noise[k] else 0.0) for k, j in pairs]
        cells += [(k, k, float(sizes.get(k, 0) - num_to_remove.get(k, 0))) for k in range(K)]
        rounded = _cells(L.round_rows(spark.createDataFrame(cells, "k_s int, k_y int, v double")))
        by_count = {at: int(rounded[at]) for at in pairs}
    return {k: sum(by_count[(k, j)] for j in range(K) if j != k) for k in range(K)}, by_count


def _p(psx: str, k: int) -> Column:
    return F.element_at(F.col(psx), k + 1)


def prune_by_class_window(df: DataFrame, by_class: dict, label: str = "label",
                          psx: str = "psx") -> Column:
    """W3, window form: count of class rows with p <= own p is at most m."""
    own = F.element_at(F.col(psx), F.col(label).cast("int") + 1)
    w = Window.partitionBy(label).orderBy(own).rangeBetween(Window.unboundedPreceding, 0)
    m = F.lit(0)
    for k, v in by_class.items():
        m = F.when(F.col(label) == k, F.lit(int(v))).otherwise(m)
    return (m > 0) & (F.count(F.lit(1)).over(w) <= m)


def prune_by_count_window(df: DataFrame, by_count: dict, K: int, label: str = "label",
                          psx: str = "psx") -> Column:
    """W4, window form: rank of the margin (descending) within the class <= n."""
    mask = F.lit(False)
    for (k, j), n in by_count.items():
        if n <= 0:
            continue
        margin = _p(psx, j) - _p(psx, k)
        w = Window.partitionBy(label).orderBy(margin.desc())
        mask = mask | ((F.col(label) == k) & (F.rank().over(w) <= n))
    return mask


def exact_cut_masks(df: DataFrame, by_class: dict, by_count: dict, K: int, label: str = "label",
                    psx: str = "psx", member=None, weight: str | None = None) -> tuple[Column, Column]:
    """W3 and W4 masks from ONE exact selection over the union of the values
    both methods rank: own probability per class (group k) and the negated
    margin per (class k, other j) (group K + k*K + j).

    ``member(k)`` says which rows are ranked in class k: by default those labelled k.  A
    row may be in several classes; it is marked if any of them marks it.  The masks hold for any
    frame with these columns; a row of df stands for ``weight`` rows, if that is given."""
    member = member or (lambda k: F.col(label) == k)
    values = [F.when(member(k), F.struct(F.lit(k).alias("g"), _p(psx, k).alias("v")))
              for k in range(K) if by_class.get(k, 0) > 0]
    values += [F.when(member(k), F.struct(F.lit(K + k * K + j).alias("g"),
                                                  (_p(psx, k) - _p(psx, j)).alias("v")))
               for (k, j), n in by_count.items() if n > 0]
    if not values:
        return F.lit(False), F.lit(False)
    # one scan: every row gives the values that its own class ranks
    own = [weight] if weight else []
    allv = df.select(F.explode(F.array(*values)).alias("x"), *own).where("x is not null").select(
        F.col("x.g").alias("_g"), F.col("x.v").alias("_v"), *own)

    def ranks(sizes):
        want = {}
        for k in range(K):
            m = by_class.get(k, 0)
            if m > 0:
                want[k] = m + 1          # (m+1)-th smallest own probability
        for (k, j), n in by_count.items():
            if n > 0:
                want[K + k * K + j] = n  # n-th smallest of -margin = n-th largest margin
        return want

    cuts = kth_smallest(allv, "_v", ranks, "_g", weight=weight)
    m_class = F.lit(False)
    for k in range(K):
        if by_class.get(k, 0) <= 0:
            continue
        cut = cuts.get(k)
        in_k = member(k)
        m_class = m_class | (in_k if cut is None else in_k & (_p(psx, k) < F.lit(cut)))
    m_count = F.lit(False)
    for (k, j), n in by_count.items():
        if n <= 0:
            continue
        cut = cuts.get(K + k * K + j)
        in_k = member(k)
        # n beyond the class size marks the whole class (numpy would raise)
        m_count = m_count | (in_k if cut is None else in_k & ((_p(psx, k) - _p(psx, j)) <= F.lit(cut)))
    return m_class, m_count


def find_label_errors(df: DataFrame, cj: DataFrame | None = None, thresholds: list | None = None,
                      num_classes: int = 2, method: str = "both", budget: str = "reference",
                      label: str = "label", psx: str = "psx", form: str = "cut",
                      name: str = "is_error", frac_noise: float = 1.0,
                      num_to_remove: dict | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Mark likely label errors; a row whose argmax equals its label is never marked.

    ``method``: ``prune_by_class``, ``prune_by_noise_rate`` or ``both`` (AND).
    ``cj`` defaults to the calibrated confident joint (D1).  ``form='window'``
    uses the window expressions instead of exact cuts.  Where psx has few values, ``counts``
    (``labels.psx_counts`` of df) is read in place of the rows for all but the mask.
    """
    K = num_classes
    rows, weight = (df, None) if counts is None else (counts, L.ROWS)
    if cj is None:
        if thresholds is None:
            thresholds = L.per_class_thresholds(rows, K, label, psx, weight)
        cj = L.confident_joint(rows, thresholds, label, psx, weight=weight)
    cells = _cells(cj)
    sizes = L.class_sizes(rows, label, K, weight) if budget == "own" else {}
    by_class, by_count = budgets(cells, sizes, K, budget, frac_noise, num_to_remove, df.sparkSession)
    if method == "prune_by_class":
        by_count = {}
    elif method == "prune_by_noise_rate":
        by_class = {}
    elif method != "both":
        raise ValueError(f"unknown method {method!r}")
    if form == "window":
        m_class = prune_by_class_window(df, by_class, label, psx)
        m_count = prune_by_count_window(df, by_count, K, label, psx)
    else:
        m_class, m_count = exact_cut_masks(rows, by_class, by_count, K, label, psx, weight=weight)
    mask = {"prune_by_class": m_class, "prune_by_noise_rate": m_count}.get(method, m_class & m_count)
    mask = mask & (argmax_first(F.col(psx)) != F.col(label))
    return df.withColumn(name, mask)


def find_label_errors_multi(df: DataFrame, num_classes: int, cj: DataFrame | None = None, method: str = "both",
                            labels: str = "labels", psx: str = "psx", name: str = "is_error",
                            frac_noise: float = 1.0) -> DataFrame:
    """L15 for label lists: a row is ranked in every class of its list, with budgets from
    the multi-label joint (L7), and marked if any of these classes marks it.

    A row whose list equals its predicted classes, those above the boundary of the best
    F1 (L18), is never marked.  The masks are column expressions over the cuts: rows aren't
    exploded and joined back.  A null or empty list is in no class.
    """
    K = num_classes
    cells = _cells(cj if cj is not None else LT.multilabel_joint(df, K, labels, psx))
    by_class, by_count = budgets(cells, {}, K, "own", frac_noise)

    def member(k: int) -> Column:
        return F.coalesce(F.array_contains(F.col(labels), k), F.lit(False))

    m_class, m_count = exact_cut_masks(df, by_class if method != "prune_by_noise_rate" else {},
                                       by_count if method != "prune_by_class" else {}, K, psx=psx, member=member)
    mask = {"prune_by_class": m_class, "prune_by_noise_rate": m_count, "both": m_class & m_count}[method]
    boundary = LT.multilabel_boundary(df, K, labels, psx).where("best").first()["boundary"]
    agrees = F.lit(True)
    for k in range(K):
        agrees = agrees & (member(k) == (_p(psx, k) > F.lit(boundary)))
    return df.withColumn(name, mask & ~agrees)


def order_label_errors_multi(df: DataFrame, method: str = "normalized_margin", labels: str = "labels",
                             psx: str = "psx", mask: str = "is_error", row_id: str = "row_id") -> DataFrame:
    """T1 for label lists: by the mean probability of the row's classes, less the largest one
    for the margin (D19); positions over (score, row_id)."""
    own = F.array_distinct(F.col(labels))
    total = F.aggregate(own, F.lit(0.0), lambda s, k: s + F.element_at(F.col(psx), k + 1))
    mean = F.when(F.size(own) > 0, total / F.size(own))
    score = mean if method == "prob_given_label" else mean - F.array_max(F.col(psx))
    errs = df.where(F.col(mask)).select(row_id, labels, score.alias("score"))
    return global_row_number(errs, [F.col("score"), F.col(row_id)], "pos")


def keep_at_least_n_per_class(pcm: DataFrame, n: int, frac_noise: float = 1.0) -> DataFrame:
    """Raise each diagonal to >= n taking the same amount off the column's
    non-zero noise cells (clipped at 0), scale noise by ``frac_noise`` moving the
    rest to the diagonal, truncate to integers.  ``pcm`` is ``(k_s, k_y, v)``
    with rows ``k_s`` and columns ``k_y``."""
    col_w = Window.partitionBy("k_y")
    diag = F.max(F.when(F.col("k_s") == F.col("k_y"), F.col("v"))).over(col_w)
    c = pcm.withColumn("_d", diag.cast("double"))
    c = c.withColumn("_nd", F.greatest(F.col("_d"), F.lit(float(n))))
    nnz = F.greatest(F.sum(F.when(F.col("v") != 0, 1).otherwise(0)).over(col_w) - 1, F.lit(1))
    c = c.withColumn("_nnz", nnz.cast("double"))
    off = F.greatest(F.col("v") - (F.col("_nd") - F.col("_d")) / F.col("_nnz"), F.lit(0.0))
    c = c.withColumn("_new", F.when(F.col("k_s") == F.col("k_y"), F.col("_nd")).otherwise(off))
    c = c.withColumn("_scaled", F.when(F.col("k_s") == F.col("k_y"), F.col("_new"))
                     .otherwise(F.col("_new") * F.lit(float(frac_noise))))
    moved = F.sum(F.col("_new") - F.col("_scaled")).over(col_w)
    out = F.when(F.col("k_s") == F.col("k_y"), F.col("_new") + moved).otherwise(F.col("_scaled"))
    return c.select("k_s", "k_y", F.floor(out).cast("bigint").alias("v"))


def transpose(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("k_y").alias("k_s"), F.col("k_s").alias("k_y"), "v")


def order_label_errors(df: DataFrame, method: str = "normalized_margin", label: str = "label",
                       psx: str = "psx", mask: str = "is_error", row_id: str = "row_id") -> DataFrame:
    """Label errors ordered by self-confidence or by margin p_s - max(p).

    The position is an exact global row number over (score, row_id): many rows of one
    score are split by their id.
    """
    own = F.element_at(F.col(psx), F.col(label).cast("int") + 1)
    score = own if method == "prob_given_label" else own - F.array_max(F.col(psx))
    errs = df.where(F.col(mask)).select(row_id, label, score.alias("score"))
    return global_row_number(errs, [F.col("score"), F.col(row_id)], "pos")


def baseline_argmax(df: DataFrame, label: str = "label", psx: str = "psx") -> DataFrame:
    """Rows whose argmax differs from the label."""
    return df.where(argmax_first(F.col(psx)) != F.col(label))


def argmax_confusion(df: DataFrame, num_classes: int, label: str = "label", psx: str = "psx",
                     calibrate: bool = False, weight: str | None = None) -> DataFrame:
    """L17 joint: counts (s, argmax psx), calibrated on request."""
    cm = L.confusion_cells(df.withColumn("_am", argmax_first(F.col(psx))), label, "_am",
                           num_classes, weight)
    if not calibrate:
        return cm
    return L.calibrate_joint(cm, L.class_count_frame(df, num_classes, label, weight))


def baseline_confusion(df: DataFrame, num_classes: int = 2, calibrate: bool = False,
                       method: str = "prune_by_noise_rate", label: str = "label",
                       psx: str = "psx", counts: DataFrame | None = None) -> DataFrame:
    """The argmax confusion matrix as the joint, then L15; ``counts`` as there."""
    cj = argmax_confusion(df if counts is None else counts, num_classes, label, psx, calibrate,
                          None if counts is None else L.ROWS)
    return find_label_errors(df, cj=cj, num_classes=num_classes, method=method,
                             label=label, psx=psx, counts=counts)
