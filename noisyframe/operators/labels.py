"""Label-quality core: folds, out-of-fold probabilities, thresholds, confident joint.

Row-level work is one pass of column expressions over N rows; every K x K
object is a long table ``(k_s, k_y, v)`` of at most K^2 rows, so it is safe to
broadcast and cheap to finish with small windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import KEY_MODULUS, argmax_first, seeded_key
from ..functions.ranking import MAX_GROUPS, exact_median, keyed_row_number, localize, settled
from ..session import cut_lineage

# Slack on the per-class threshold comparison.
THRESHOLD_SLACK = 1e-6
# Number of rows that a row of psx_counts stands for.
ROWS = "_rows"


# ------------------------------------------------------------------ W5 folds

def stratified_folds(df: DataFrame, k: int = 5, seed: int = 0, label: str = "label",
                     row_id: str = "row_id", name: str = "fold", write: bool = False) -> DataFrame:
    """Stratified k-fold: within each class, rows ordered by a seeded key are dealt
    round-robin, ``fold = (rank - 1) mod k``.  Exact and repeatable.

    The per-class rank comes from even buckets of the key, so a class is spread over
    many tasks.  With ``write`` the rows are written on the way, for callers that read them again.
    """
    ranked = keyed_row_number(df.withColumn("_key", seeded_key(row_id, seed, "fold")), label, "_key", row_id,
                              KEY_MODULUS, "_rank", write)
    return ranked.withColumn(name, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank", "_key")


# ------------------------------------------------------------------ L1b psx

def fold_rate_psx(df: DataFrame, cat: str, num_classes: int = 2, label: str = "label",
                  fold: str = "fold") -> DataFrame:
    """Out-of-fold psx from a category: class counts of the row's category value
    in the *other* folds, smoothed ``(n_k + 1) / (n + K)``.

    One aggregation per (category value, fold) — partial aggregation happens
    map side — and one join back; the lookup has at most (#values x #folds) rows,
    and is broadcast where they are few.  A NULL category is treated as its own value (null-safe join).
    """
    K = num_classes
    per_fold = df.groupBy(cat, fold).agg(
        *[F.count(F.when(F.col(label) == k, 1)).alias(f"_f{k}") for k in range(K)])
    w = Window.partitionBy(cat)
    lookup = settled(per_fold.select(
        F.col(cat).alias("_lc"), F.col(fold).alias("_lf"),
        *[(F.sum(f"_f{k}").over(w) - F.col(f"_f{k}")).alias(f"_n{k}") for k in range(K)]))
    joined = df.join(lookup, df[cat].eqNullSafe(lookup["_lc"]) & (df[fold] == lookup["_lf"]),
                     "left")
    n_all = sum((F.col(f"_n{k}") for k in range(K)), F.lit(0))
    psx = F.array(*[((F.col(f"_n{k}") + 1) / (n_all + K)).cast("double") for k in range(K)])
    return joined.withColumn("psx", psx).drop("_lc", "_lf", *[f"_n{k}" for k in range(K)])


def psx_counts(df: DataFrame, label: str = "label", psx: str = "psx") -> DataFrame:
    """Rows per (label, psx), ``_rows`` of them, written out: for a psx of few values, as one by
    category counts has, it stands for df in all that follows up to the cuts."""
    return cut_lineage(df.groupBy(label, psx).agg(F.count(F.lit(1)).alias(ROWS)))


def row_count(weight: str | None) -> Column:
    """Rows of a group, of a frame whose rows stand for ``weight`` rows if that is given."""
    return F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))


# ------------------------------------------------------------------ A1 counts

def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Value counts of the label in class order (D9: class, not frequency)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def class_sizes(df: DataFrame, label: str = "label", num_classes: int | None = None, weight: str | None = None) -> dict:
    rows = df.groupBy(label).agg(row_count(weight)).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} classes in {label}")
    got = {r[0]: r[1] for r in rows}
    if num_classes is not None:
        return {k: int(got.get(k, 0)) for k in range(num_classes)}
    return {k: int(v) for k, v in got.items()}


# ------------------------------------------------------------------ A10 thresholds

def per_class_thresholds(df: DataFrame, num_classes: int = 2, label: str = "label",
                         psx: str = "psx", weight: str | None = None) -> list:
    """Exact per-class median of the own-class probability ``psx[s]`` (A10).

    Computed with distributed exact selection (no single task holds a class).
    """
    own = df.select(F.col(label).alias("_s"),
                    F.element_at(F.col(psx), F.col(label).cast("int") + 1).alias("_p"), *([weight] if weight else []))
    med = exact_median(own, "_p", "_s", list(range(num_classes)), weight)
    return [med.get(k) for k in range(num_classes)]


def thresholds_frame(spark: SparkSession, thresholds: list) -> DataFrame:
    return spark.createDataFrame([(k, float(t) if t is not None else None)
                                  for k, t in enumerate(thresholds)], "k int, thr double")


# ------------------------------------------------------------------ L2 confident joint

def confident_class(psx: Column, thresholds: list) -> Column:
    """The confident class of a row, NULL when no class clears its threshold.

    Exactly one confident class -> it; several -> the overall argmax (first on
    ties).  ``K`` is unrolled so the expression stays in whole-stage codegen.
    """
    K = len(thresholds)
    flags = []
    for k, t in enumerate(thresholds):
        if t is None:
            flags.append(F.lit(False))
        else:
            flags.append(F.element_at(psx, k + 1) >= F.lit(float(t) - THRESHOLD_SLACK))
    n_conf = sum((f.cast("int") for f in flags), F.lit(0))
    first = None
    for k in reversed(range(K)):
        first = F.when(flags[k], F.lit(k)) if first is None else F.when(flags[k], F.lit(k)).otherwise(first)
    return (F.when(n_conf == 1, first)
            .when(n_conf > 1, argmax_first(psx))
            .otherwise(F.lit(None)).cast("int"))


def with_confident_class(df: DataFrame, thresholds: list, psx: str = "psx",
                         name: str = "y_conf") -> DataFrame:
    return df.withColumn(name, confident_class(F.col(psx), thresholds))


def grid(spark: SparkSession, num_classes: int) -> DataFrame:
    """All K x K cells (k_s, k_y)."""
    K = num_classes
    return spark.createDataFrame([(a, b) for a in range(K) for b in range(K)], "k_s int, k_y int")


def confusion_cells(df: DataFrame, row_col: str, col_col: str, num_classes: int, weight: str | None = None) -> DataFrame:
    """Counts per (row class, column class) on the full K x K grid (zeros kept)."""
    spark = df.sparkSession
    cells = (df.where(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
             .groupBy(F.col(row_col).cast("int").alias("k_s"), F.col(col_col).cast("int").alias("k_y"))
             .agg(row_count(weight).alias("v")))
    return localize(grid(spark, num_classes).join(F.broadcast(cells), ["k_s", "k_y"], "left")
                    .select("k_s", "k_y", F.coalesce(F.col("v"), F.lit(0)).cast("bigint").alias("v")))


def confident_joint_raw(df: DataFrame, thresholds: list, label: str = "label",
                        psx: str = "psx") -> DataFrame:
    """L2 (uncalibrated): counts (s, y_conf) over rows with a confident class."""
    K = len(thresholds)
    return confusion_cells(with_confident_class(df, thresholds, psx), label, "y_conf", K)


def off_diagonal_rows(df: DataFrame, thresholds: list, label: str = "label",
                      psx: str = "psx") -> DataFrame:
    """L3: rows counted off the diagonal of the confident joint."""
    c = with_confident_class(df, thresholds, psx)
    return c.where(F.col("y_conf").isNotNull() & (F.col("y_conf") != F.col(label)))


# ------------------------------------------------------------------ W6 rounding

def round_rows(cells: DataFrame, row: str = "k_s", col: str = "k_y", value: str = "v",
               name: str = "v") -> DataFrame:
    """Round every matrix row to integers keeping the row's rounded total.

    ``i = rint(f)``, ``diff = rint(sum f) - sum i``; diff > 0 adds 1 to the
    ``diff`` cells with the largest ``f - i`` (ties: highest column first);
    diff < 0 takes 1 from the cells with the smallest ``f - i`` (ties: lowest
    column first).  Works on the long form, one small window per row.
    """
    w = Window.partitionBy(row)
    c = (cells.withColumn("_f", F.col(value).cast("double"))
         .withColumn("_i", F.rint("_f"))
         .withColumn("_r", F.col("_f") - F.col("_i"))
         .withColumn("_d", F.rint(F.sum("_f").over(w)) - F.sum("_i").over(w)))
    up = Window.partitionBy(row).orderBy(F.col("_r").desc(), F.col(col).desc())
    down = Window.partitionBy(row).orderBy(F.col("_r").asc(), F.col(col).asc())
    c = (c.withColumn("_up", F.row_number().over(up))
         .withColumn("_dn", F.row_number().over(down)))
    adj = (F.when((F.col("_d") > 0) & (F.col("_up") <= F.col("_d")), 1)
           .when((F.col("_d") < 0) & (F.col("_dn") <= -F.col("_d")), -1).otherwise(0))
    keep = [x for x in cells.columns if x != value]
    return c.select(*keep, (F.col("_i") + adj).cast("bigint").alias(name))


# ------------------------------------------------------------------ L4 calibration

def calibrate_joint(cj: DataFrame, class_counts: DataFrame) -> DataFrame:
    """L4: scale rows to the class counts, the total to N, then W6 per row.

    ``class_counts`` is ``(k_s, n)``.  A row with no confident rows would divide
    by zero in the reference; here it puts ``n`` on its diagonal.
    """
    rs = Window.partitionBy("k_s")
    allw = Window.partitionBy()
    c = cj.join(F.broadcast(class_counts), "k_s", "left").withColumn(
        "n", F.coalesce(F.col("n"), F.lit(0)))
    rowsum = F.sum("v").over(rs)
    v1 = (F.when(rowsum == 0, F.when(F.col("k_s") == F.col("k_y"), F.col("n").cast("double"))
                 .otherwise(F.lit(0.0)))
          .otherwise(F.col("v") / rowsum * F.col("n")))
    c = c.withColumn("_v1", v1)
    total_n = F.sum(F.when(F.col("k_s") == F.col("k_y"), F.col("n"))).over(allw)
    c = c.withColumn("_v2", F.col("_v1") / F.sum("_v1").over(allw) * total_n)
    return round_rows(c.select("k_s", "k_y", F.col("_v2").alias("v")))


def class_count_frame(df: DataFrame, num_classes: int, label: str = "label", weight: str | None = None) -> DataFrame:
    spark = df.sparkSession
    counts = df.groupBy(F.col(label).cast("int").alias("k_s")).agg(row_count(weight).alias("n"))
    ks = spark.createDataFrame([(k,) for k in range(num_classes)], "k_s int")
    return localize(ks.join(F.broadcast(counts), "k_s", "left").select(
        "k_s", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def confident_joint(df: DataFrame, thresholds: list, label: str = "label",
                    psx: str = "psx", calibrate: bool = True, weight: str | None = None) -> DataFrame:
    """L2 + L4: the confident joint, calibrated by default (K x K long table).

    One aggregation over the rows gives both the (s, y_conf) cells and the
    class counts (rows without a confident class included)."""
    K = len(thresholds)
    spark = df.sparkSession
    rows = (with_confident_class(df, thresholds, psx)
            .groupBy(F.col(label).cast("int").alias("k_s"), F.col("y_conf").alias("k_y"))
            .agg(row_count(weight).alias("v")).limit(2 * K * (K + 1) + 1).collect())
    cells = {(a, b): 0 for a in range(K) for b in range(K)}
    counts = {a: 0 for a in range(K)}
    for r in rows:
        if r["k_s"] is None or not 0 <= r["k_s"] < K:
            raise ValueError(f"{r['v']} rows have the label {r['k_s']}, which is none of 0..{K - 1}")
        counts[r["k_s"]] += r["v"]
        if r["k_y"] is not None:
            cells[(r["k_s"], r["k_y"])] += r["v"]
    raw = spark.createDataFrame([(a, b, int(v)) for (a, b), v in sorted(cells.items())],
                                "k_s int, k_y int, v bigint")
    if not calibrate:
        return raw
    cc = spark.createDataFrame([(a, int(n)) for a, n in sorted(counts.items())], "k_s int, n bigint")
    return localize(calibrate_joint(raw, cc))


# ------------------------------------------------------------------ L5 / L6

def joint_distribution(cj: DataFrame) -> DataFrame:
    """The joint P(s, y) = cj / sum(cj)."""
    return cj.select("k_s", "k_y",
                     (F.col("v") / F.sum("v").over(Window.partitionBy())).alias("p"))


def num_label_errors(cj: DataFrame, n_rows: Column | int) -> DataFrame:
    """int((1 - trace(joint)) * N), the joint being cj / sum(cj)."""
    n = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    t = cj.withColumn("_t", F.sum("v").over(Window.partitionBy()).cast("double"))
    tr = F.sum(F.when(F.col("k_s") == F.col("k_y"), F.col("v") / F.col("_t")))
    return t.agg(F.floor((F.lit(1.0) - tr) * n).cast("bigint").alias("num_errors"))


def fold_rate_psx_multi(df: DataFrame, cat: str, num_classes: int, labels: str = "labels",
                        fold: str = "fold") -> DataFrame:
    """L1b for label lists: p_k = (rows of the value in other folds whose list holds
    k, plus 1) / (rows of the value in other folds, plus K)."""
    K = num_classes
    per_fold = df.groupBy(cat, fold).agg(
        F.count(F.lit(1)).alias("_fn"),
        *[F.count(F.when(F.array_contains(F.col(labels), k), 1)).alias(f"_f{k}") for k in range(K)])
    w = Window.partitionBy(cat)
    lookup = settled(per_fold.select(
        F.col(cat).alias("_lc"), F.col(fold).alias("_lf"),
        (F.sum("_fn").over(w) - F.col("_fn")).alias("_nn"),
        *[(F.sum(f"_f{k}").over(w) - F.col(f"_f{k}")).alias(f"_n{k}") for k in range(K)]))
    joined = df.join(lookup, df[cat].eqNullSafe(lookup["_lc"]) & (df[fold] == lookup["_lf"]), "left")
    psx = F.array(*[((F.col(f"_n{k}") + 1) / (F.col("_nn") + K)).cast("double") for k in range(K)])
    return joined.withColumn("psx", psx).drop("_lc", "_lf", "_nn", *[f"_n{k}" for k in range(K)])
