"""Exact, repeatable sampling.

Every draw orders rows by the seeded key of ``row_id`` (ties by ``row_id``), so
the result never depends on partitioning or on re-running a lost task.  "Take
the n smallest keys of a class" never ranks the class in one task: the exact
cut key is found by :func:`kth_smallest`, then a filter keeps the rows below it.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import KEY_MODULUS, seeded_key
from ..functions.ranking import MAX_GROUPS, distributed_row_number, kth_smallest
from ..session import cut_lineage

# Fixed values of the reference's sampling rules.
SSL_MAX_POSITIVES = 20000
PU_UNLABELLED_FACTOR = 3
ENTITY_PERCENT = 0.1
ENTITY_MIN = 10
ENTITY_MAX = 10000
MIN_NEG_POS_RATIO = 2
# Groups whose cuts are looked for near their expected keys, and how many standard deviations around.
NEAR_GROUPS = 16
NEAR_DEVIATIONS = 8


def take_smallest(df: DataFrame, n, seed: int = 0, row_id: str = "row_id",
                  by: str | None = None, purpose: str = "sample") -> DataFrame:
    """Rows with the ``n`` smallest (key, row_id); ``n`` may be a dict per ``by`` value.

    Exact: the cut is the n-th smallest key, and at the cut key the first rows by
    row_id fill the remainder.  Groups not in the dict keep no rows.  The rows are
    filtered where they are: no sort, no join.
    """
    return df.where(smallest_filter(df, n, seed, row_id, by, purpose))


def smallest_filter(df: DataFrame, n, seed: int = 0, row_id: str = "row_id",
                    by: str | Column | None = None, purpose: str = "sample", sizes: dict | None = None) -> Column:
    """The condition of :func:`take_smallest`, over the columns of ``df``.

    Where the rows per group are known (``sizes``), the cuts are expected near their share of the
    key's range, and one aggregation counts the rows before and keeps those around."""
    key = seeded_key(row_id, seed, purpose)
    group = F.lit(None).cast("int") if by is None else F.col(by) if isinstance(by, str) else by
    want = {g: int(v) for g, v in (n if isinstance(n, dict) else {None: n}).items() if v is not None and v > 0}
    if sizes is not None and len(want) <= NEAR_GROUPS and dict(df.dtypes)[row_id] in ("tinyint", "smallint", "int", "bigint"):
        near = _cuts_near(df, key, row_id, group, {g: v for g, v in want.items() if v < sizes.get(g, 0)}, sizes)
        if near is not None:
            return _keep(key, row_id, group, want, sizes, *near)
    # the cut search reads three narrow columns several times: persist only those
    narrow = df.select(F.col(row_id).alias("_id"), key.alias("_key"), group.alias("_grp")).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = _sizes(narrow)
        cuts = kth_smallest(narrow, "_key", {g: v for g, v in want.items() if v < sizes.get(g, 0)}, "_grp", cached=True)

        def at(column: str, test) -> Column:
            out = F.lit(False)
            for g, cut in cuts.items():
                out = out | (_is(F.col("_grp"), g) & test(F.col(column), F.lit(cut)))
            return out

        below = _sizes(narrow.where(at("_key", lambda x, c: x < c))) if cuts else {}
        ids = kth_smallest(narrow.where(at("_key", lambda x, c: x == c)), "_id",
                           {g: want[g] - below.get(g, 0) for g in cuts}, "_grp") if cuts else {}
    finally:
        narrow.unpersist()
    return _keep(key, row_id, group, want, sizes, cuts, ids)


def _keep(key: Column, row_id: str, group: Column, want: dict, sizes: dict, cuts: dict, ids: dict) -> Column:
    keep = F.lit(False)
    for g, v in want.items():
        if g in cuts:
            if isinstance(ids[g], int):     # as a pair, the key is computed once
                rank = F.col(row_id).isNotNull() & (F.struct(key, F.col(row_id).cast("bigint")) <= F.struct(
                    F.lit(cuts[g]).cast("bigint"), F.lit(ids[g]).cast("bigint")))
            else:
                rank = (key < F.lit(cuts[g])) | ((key == F.lit(cuts[g])) & (F.col(row_id) <= F.lit(ids[g])))
            keep = keep | (_is(group, g) & rank)
        elif sizes.get(g, 0):
            keep = keep | _is(group, g)
    return F.coalesce(keep, F.lit(False))


def _cuts_near(df: DataFrame, key: Column, row_id: str, group: Column, want: dict, sizes: dict) -> tuple[dict, dict] | None:
    """Key and id of the n-th row of each group in ``want``, in the order (key, id), or None.

    Keys are even over their range, so that the n-th of N lies within a few standard deviations
    of n / N of it.  The rows there, about ``sqrt(N)`` of them, are written with their running
    number; those before are only counted.  None if a cut is not among them (ids that repeat).
    """
    if not want:
        return {}, {}
    spans = {}
    for g, n in want.items():
        share, rows = n / sizes[g], sizes[g]
        spread = NEAR_DEVIATIONS * math.sqrt(share * (1 - share) / rows) + NEAR_DEVIATIONS ** 2 / rows
        spans[g] = max(0, int((share - spread) * KEY_MODULUS)), min(KEY_MODULUS, int((share + spread) * KEY_MODULUS))
    before = inside = F.lit(False)
    for g, (lo, hi) in spans.items():
        before = before | (_is(F.col("_grp"), g) & (F.col("_key") < F.lit(lo)))
        inside = inside | (_is(F.col("_grp"), g) & F.col("_key").between(F.lit(lo), F.lit(hi)))
    # no filter: one on the key would compute it once more
    rows = df.select(F.col(row_id).alias("_id"), key.alias("_key"), group.alias("_grp"))
    found = cut_lineage(rows.groupBy("_grp", F.when(inside, F.col("_key")).alias("_key"), F.when(inside, F.col("_id")).alias("_id"))
                        .agg(F.count_if(before | inside).alias("_n")))
    upto = Window.partitionBy("_grp").orderBy(F.col("_key").asc_nulls_first(), "_id").rowsBetween(Window.unboundedPreceding, 0)
    target = F.lit(None).cast("bigint")
    for g, n in want.items():
        target = F.when(_is(F.col("_grp"), g), F.lit(n)).otherwise(target)
    # the first row, of those in order, up to which there are n
    numbered = found.withColumn("_upto", F.sum("_n").over(upto))
    cuts = numbered.where((F.col("_upto") >= target) & (F.col("_upto") - F.col("_n") < target)).collect()
    at = {r["_grp"]: r for r in cuts if r["_key"] is not None and r["_id"] is not None}
    if set(at) != set(want):
        return None
    return {g: r["_key"] for g, r in at.items()}, {g: r["_id"] for g, r in at.items()}


def _is(column: Column, value) -> Column:
    return column.isNull() if value is None else column == F.lit(value)


def _sizes(df: DataFrame) -> dict:
    """Rows per class of ``_grp``; more than MAX_GROUPS classes raise."""
    rows = df.groupBy("_grp").count().limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} classes")
    return {r["_grp"]: r["count"] for r in rows}


def class_sizes(df: DataFrame, label: str | Column) -> dict:
    """Rows per class of a column; more than MAX_GROUPS classes raise."""
    return _sizes(df.select((F.col(label) if isinstance(label, str) else label).alias("_grp")))


def holdout_split(df: DataFrame, test_size: float = 0.2, seed: int = 0,
                  row_id: str = "row_id") -> DataFrame:
    """Exact split; ``ceil(test_size * N)`` rows with the smallest keys are
    ``test``, the rest ``train``."""
    rows = df.count()
    test = smallest_filter(df, int(math.ceil(test_size * rows)), seed, row_id, purpose="split", sizes={None: rows})
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def frac_sample(df: DataFrame, frac: float, seed: int = 0, row_id: str = "row_id",
                by: str | None = None) -> DataFrame:
    """T4: ``frac`` < 1 keeps ``rint(frac * N)`` rows; > 1 repeats every row
    ``floor(frac)`` times plus ``rint((frac - floor(frac)) * N)`` extra rows; = 1
    keeps all rows.  Adds ``copy`` (1-based).  With ``by``, ``frac`` is a dict
    and each group is sampled on its own."""
    fracs = frac if isinstance(frac, dict) else {None: frac}
    group = F.lit(None).cast("int") if by is None else F.col(by)
    sizes = class_sizes(df, group)
    extra = {g: int(round((f - math.floor(f)) * sizes.get(g, 0))) for g, f in fracs.items()}
    copies = F.lit(0)
    for g, f in fracs.items():
        copies = F.when(_is(group, g), F.lit(int(math.floor(f)))).otherwise(copies)
    drawn = smallest_filter(df, extra, seed, row_id, by, sizes=sizes)
    if all(f < 1 for f in fracs.values()):
        return df.where(drawn).withColumn("copy", F.lit(1))
    copies = copies + drawn.cast("int")
    return (df.withColumn("_n", copies).where(F.col("_n") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"))


def balance_plan(npos: int, nneg: int, sample_num: int, unbalanced_ratio: float | None = None,
                 min_neg_pos_ratio: float = MIN_NEG_POS_RATIO) -> tuple[int, int]:
    """T5: target (positive, negative) counts from a size cap and imbalance ratio.

    Over the cap, the share of the smaller class depends on the band its ratio
    falls in: proportional, one part in ``min_neg_pos_ratio + 1``, or one part in
    ``unbalanced_ratio + 1``.  The larger class never exceeds the ratio.
    """
    small, large = sorted((npos, nneg))
    if unbalanced_ratio is None:
        thousands = max(small, 1000) // 1000
        unbalanced_ratio = 3 if thousands >= 8 else 10 - thousands
    cap = min(small * (unbalanced_ratio + 1), sample_num)
    few, many = float(small), float(large)
    if small + large > cap:
        proportional = large <= min_neg_pos_ratio * small
        parts = (min_neg_pos_ratio if large <= unbalanced_ratio * small else unbalanced_ratio) + 1
        few = small / (small + large) * cap if proportional else min(small, cap / parts)
        many = large / (small + large) * cap if proportional else cap - few
    plan = int(few), int(min(many, few * unbalanced_ratio))
    return plan if npos <= nneg else plan[::-1]


def class_counts_binary(df: DataFrame, label: str = "label") -> tuple[int, int]:
    r = df.agg(F.count(F.when(F.col(label) == 1, 1)).alias("p"),
               F.count(F.when(F.col(label) != 1, 1)).alias("n")).first()
    return int(r["p"]), int(r["n"])


def class_balanced(df: DataFrame, sample_num: int, seed: int = 2019,
                   label: str = "label", row_id: str = "row_id") -> DataFrame:
    """The plan of T5 applied per class with T4 (positives vs the rest)."""
    npos, nneg = class_counts_binary(df, label)
    pos_num, neg_num = balance_plan(npos, nneg, sample_num)
    side = F.when(F.col(label) == 1, 1).otherwise(0)
    fr = {1: pos_num / float(npos) if npos else 0.0, 0: neg_num / float(nneg) if nneg else 0.0}
    return frac_sample(df.withColumn("_side", side), fr, seed, row_id, by="_side").drop("_side")


def ssl_sample(df: DataFrame, seed: int = 0, label: str = "label", row_id: str = "row_id",
               max_pos: int = SSL_MAX_POSITIVES) -> DataFrame:
    """Drop unlabelled (0), map -1 -> 0; at most ``max_pos`` positives and no
    more negatives than positives."""
    lab = df.where(F.col(label) != 0).withColumn(label, F.when(F.col(label) == -1, 0).otherwise(
        F.col(label)))
    cnt = class_sizes(lab, label)
    p = min(cnt.get(1, 0), max_pos)
    n = min(cnt.get(0, 0), p)
    return take_smallest(lab, {1: p, 0: n}, seed, row_id, by=label)


def pu_sample(df: DataFrame, seed: int = 0, label: str = "label", row_id: str = "row_id",
              factor: int = PU_UNLABELLED_FACTOR) -> DataFrame:
    """All positives plus ``3 * min(p, u)`` unlabelled rows, clamped to u."""
    cnt = class_sizes(df, label)
    p, u = cnt.get(1, 0), cnt.get(0, 0)
    n = min(factor * min(p, u), u)
    return take_smallest(df, {1: p, 0: n}, seed, row_id, by=label)


def equal_sample(df: DataFrame, seed: int = 0, label: str = "label",
                 row_id: str = "row_id") -> DataFrame:
    """The same number of rows from label 1 and from the rest."""
    side = F.when(F.col(label) == 1, 1).otherwise(0)
    d = df.withColumn("_side", side)
    cnt = class_sizes(d, "_side")
    n = min(cnt.get(0, 0), cnt.get(1, 0))
    return take_smallest(d, {0: n, 1: n}, seed, row_id, by="_side").drop("_side")


def ssl_pu_sample(df: DataFrame, seed: int = 0, label: str = "label",
                  row_id: str = "row_id") -> DataFrame:
    """n = min(#negatives, #positives) draws with replacement from the
    unlabelled rows and from the negatives (both relabelled 0), plus all positives.

    Draw ``d`` of class c picks position ``key(d, seed, purpose c) mod size(c)`` of the
    class in key order; positions are exact row numbers over key buckets and
    the draws are a distributed range joined on (class, position).
    """
    spark = df.sparkSession
    cnt = class_sizes(df, label)
    n = min(cnt.get(-1, 0), cnt.get(1, 0))
    pools = df.where(F.col(label).isin(0, -1)).withColumn("_key", seeded_key(row_id, seed, "pool"))
    ranked = distributed_row_number(pools, [label], [F.col("_key"), F.col(row_id)], "_pos")
    draws = None
    for c in (0, -1):
        size = cnt.get(c, 0)
        if n == 0 or size == 0:
            continue
        d = spark.range(n).select(
            F.lit(c).alias("_c"), F.col("id").alias("draw"),
            (F.pmod(seeded_key(F.col("id"), seed, f"draw{abs(c)}"), F.lit(size)) + 1).alias("_dpos"))
        draws = d if draws is None else draws.unionByName(d)
    pos = df.where(F.col(label) == 1).select(row_id, F.lit(1).alias("label_out"),
                                            F.lit(None).cast("bigint").alias("draw"))
    if draws is None:
        return pos.withColumnRenamed("label_out", label)
    picked = ranked.join(draws, (ranked[label] == draws["_c"]) & (ranked["_pos"] == draws["_dpos"]))
    neg = picked.select(row_id, F.lit(0).alias("label_out"), "draw")
    return neg.unionByName(pos).withColumnRenamed("label_out", label)


def entity_sample(df: DataFrame, col: str, row_id: str = "row_id", percent: float = ENTITY_PERCENT,
                  minimum: int = ENTITY_MIN, maximum: int = ENTITY_MAX) -> DataFrame:
    """All rows of the first ceil(10%) distinct ids (first by their lowest
    row_id), at most 10,000 ids; all ids when that is fewer than 10."""
    ids = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(row_id).alias("_first"))
    total = ids.count()
    share = math.ceil(total * percent)
    wanted = total if share < minimum else min(share, maximum)
    cut = kth_smallest(ids, "_first", {None: wanted})[None] if wanted else None
    return df.join(ids.where(F.col("_first") <= F.lit(cut)).select(col), col, "left_semi")


# ------------------------------------------------------------------ L21, L22

def noise_matrix_valid(nm: list, py: list) -> bool:
    """L22 (driver side, K x K): joint sums to 1 and ps_k * py_k < joint_kk for all k."""
    K = len(py)
    ps = [sum(nm[i][j] * py[j] for j in range(K)) for i in range(K)]
    joint = [[nm[i][j] * py[j] for j in range(K)] for i in range(K)]
    if abs(sum(map(sum, joint)) - 1) >= 1e-6:
        return False
    return all(ps[i] * py[i] < joint[i][i] for i in range(K))


def inject_label_noise(df: DataFrame, noise_matrix: list, seed: int = 0, y: str = "y_true",
                       row_id: str = "row_id", name: str = "s") -> DataFrame:
    """In each true class k flip exactly ``int(nm[i][k] * py[k] * N)`` rows to
    each class i != k, drawn without replacement (rows in seeded key order: the
    first block goes to the lowest i, and so on).  A class with fewer rows than
    its flips is left clean, as in the reference."""
    K = len(noise_matrix)
    N = df.count()
    cnt = class_sizes(df, y)
    ranges = {}  # k -> list of (lo, hi, target) over 1-based positions
    for k in range(K):
        pyk = cnt.get(k, 0) / float(N)
        pos = 0
        spans = []
        for i in range(K):
            if i == k:
                continue
            c = int(noise_matrix[i][k] * pyk * N)
            if c > 0:
                spans.append((pos + 1, pos + c, i))
                pos += c
        if spans and cnt.get(k, 0) >= pos:
            ranges[k] = spans
    keyed = df.withColumn("_key", seeded_key(row_id, seed, "noise"))
    ranked = distributed_row_number(keyed, [y], [F.col("_key"), F.col(row_id)], "_pos")
    s = F.col(y)
    for k, spans in ranges.items():
        for lo, hi, tgt in spans:
            s = F.when((F.col(y) == k) & F.col("_pos").between(lo, hi), F.lit(tgt)).otherwise(s)
    return ranked.withColumn(name, s.cast("int")).drop("_key", "_pos")
