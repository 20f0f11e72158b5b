"""Exact order statistics that do not funnel a group into one task.

``Window.partitionBy(g).orderBy(k)`` sends every row of group ``g`` to one task.
With two classes, or one category holding a third of the rows, that is one task
for a third of the table.  The helpers below give the same exact answers while
the heavy work stays spread over many tasks:

* :func:`global_row_number` and :func:`distributed_row_number` — ``row_number() over
  (partition by g order by o)`` from a range partitioning on the complete order,
  with the partition sizes as offsets.
* :func:`kth_smallest` — exact k-th smallest value per group by histogram
  refinement: a few aggregation passes, each returning at most
  ``bins`` rows per group to the driver, never the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Buckets whose sums are literals of a plan, and those that a broadcast may hold (16 bytes each).
LITERAL_BUCKETS = 256
BROADCAST_BUCKETS = 500_000
# Rows of a lookup that a broadcast may hold, and buckets that a seeded key is cut into.
BROADCAST_ROWS = 200_000
KEY_BUCKETS = 4096


def bucket_of(value: Column, bounds: Sequence, strict: bool = False) -> Column:
    """Number of ``bounds`` (sorted) that are <= value (``strict``: < value), as a
    binary decision tree.

    The tree is ``log2(len(bounds))`` comparisons deep and stays inside
    whole-stage codegen (no lambda functions).  NULL goes to the last bucket.
    """
    bounds = sorted(set(b for b in bounds if b is not None))

    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]: number of bounds <= value
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2  # is bounds[mid] <= value ?
        test = value > F.lit(bounds[mid]) if strict else value >= F.lit(bounds[mid])
        return F.when(test, build(mid + 1, hi)).otherwise(build(lo, mid))

    if not bounds:
        return F.lit(0)
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(build(0, len(bounds)))


def global_row_number(df: DataFrame, order_cols: Sequence[Column], name: str = "rn",
                      rows: int | None = None) -> DataFrame:
    """Exact ``row_number()`` over the whole frame, 1-based, without one task for it all.

    The rows are range partitioned on the complete order, so that ties of the leading
    column are split as well, and sorted within their partitions.  A row's number is
    its place in its partition plus the sizes of the partitions before it, of which
    there are as many as ``buckets_for`` gives.  The sorted rows are written to the
    shared folder first: the bounds are sampled, and numbering must not see two draws.
    """
    parts = buckets_for(df.sparkSession, df.count() if rows is None else rows)
    placed = cut_lineage(df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    counted = with_total_before(placed, part.cast("int"), sizes, parts, "_before")
    place = F.col("_at") - F.shiftleft(part, 33)
    return counted.withColumn(name, (place + F.col("_before") + 1).cast("bigint")).drop("_at", "_before")


def with_total_before(df: DataFrame, bucket: Column, sizes: DataFrame, buckets: int, name: str) -> DataFrame:
    """df with the sum of n over the buckets before the row's, from sizes (b, n): one row per bucket.

    A few buckets are literals of the plan; more are a table (their prefix sums take one small
    task), which is broadcast up to ``BROADCAST_BUCKETS`` rows and joined otherwise.
    """
    if buckets <= LITERAL_BUCKETS:
        found = {r["b"]: r["n"] for r in sizes.collect()}
        before, seen = [], 0
        for i in range(max(found, default=0) + 1):
            before.append(seen)
            seen += found.get(i, 0)
        return df.withColumn(name, F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), bucket))
    earlier = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    table = cut_lineage(sizes.select(F.col("b").alias("_b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(name)))
    keyed = df.withColumn("_bucket", bucket)
    small = F.broadcast(table) if buckets <= BROADCAST_BUCKETS else table
    return keyed.join(small, keyed["_bucket"] == small["_b"], "left").drop("_b", "_bucket")


def distributed_row_number(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[Column],
                           name: str = "rn") -> DataFrame:
    """Exact ``row_number()`` over (partition_cols, order_cols), 1-based, for a bounded
    number of groups (the classes, or the blocks of a dictionary): the global number
    in the order (group, order_cols) less the sizes of the groups before."""
    pcols = list(partition_cols)
    ranked = global_row_number(df, [*[F.col(c).asc_nulls_first() for c in pcols], *order_cols], name)
    if not pcols:
        return ranked
    firsts = ranked.groupBy(*pcols).agg(F.min(name).alias("n")).limit(MAX_GROUPS + 1).collect()
    if len(firsts) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: number them over buckets")
    start = F.lit(1).cast("bigint")
    for r in firsts:
        test = F.lit(True)
        for c in pcols:
            test = test & (F.col(c).isNull() if r[c] is None else F.col(c) == F.lit(r[c]))
        start = F.when(test, F.lit(r["n"])).otherwise(start)
    return ranked.withColumn(name, F.col(name) - start + 1)


def keyed_row_number(df: DataFrame, partition_col: str, key: str, tie: str, modulus: int, name: str = "rn",
                     write: bool = False) -> DataFrame:
    """Exact ``row_number()`` over (partition_col order by key, tie), 1-based, for a key that is
    spread evenly over [0, modulus), as a seeded key is.

    Even cuts of the key need no sampled bounds: one aggregation counts the rows per group and
    bucket, and a row's number is its place in its bucket plus the rows of the buckets before.
    The rows are shuffled once.  A null key comes first.

    With ``write`` the rows are written with their places, for a caller that reads them again:
    the buckets are counted on the written rows, so that the key is computed once and not kept.
    """
    width = -(-modulus // KEY_BUCKETS)
    bucket = F.coalesce(F.floor(F.col(key) / F.lit(width)).cast("int"), F.lit(-1))
    within = F.row_number().over(Window.partitionBy("_bucket", partition_col).orderBy(key, tie))
    earlier = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)

    def place(rows: int) -> DataFrame:
        parts = buckets_for(df.sparkSession, rows)
        return df.withColumn("_bucket", bucket).repartition(parts, partition_col, "_bucket").withColumn("_place", within)

    written = cut_lineage(place(df.count()).drop(key)) if write else None
    counted = df.withColumn("_bucket", bucket) if written is None else written
    sizes = cut_lineage(counted.groupBy(F.col(partition_col).alias("_g"), F.col("_bucket").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n")).select("_g", "_b", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    buckets, rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    placed = place(rows) if written is None else written
    before = sizes.select("_g", "_b", "_before")
    before = F.broadcast(before) if buckets <= BROADCAST_BUCKETS else before
    return placed.join(before, placed[partition_col].eqNullSafe(before["_g"]) & (placed["_bucket"] == before["_b"])).withColumn(
        name, (F.col("_place") + F.col("_before")).cast("bigint")).drop("_g", "_b", "_before", "_place", "_bucket")


def settled(lookup: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A lookup, written out and counted: up to ``rows`` rows are marked for a broadcast, so that the
    rows that look up stay where they are; more are left to the planner."""
    kept = cut_lineage(lookup)
    return F.broadcast(kept) if kept.count() <= rows else kept


def ids_repeat(df: DataFrame, row_id: str = "row_id") -> bool:
    """Whether two rows have the same (non-null) id.

    Whole ids are marked as bits of words of 64: ids that lie close together take a row per word in
    the shuffle, not one each."""
    if dict(df.dtypes)[row_id] in ("tinyint", "smallint", "int", "bigint"):
        i = F.col(row_id).cast("bigint")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(i, F.lit(64)).cast("int"))
        words = df.where(i.isNotNull()).groupBy(F.shiftright(i, 6).alias("_word")).agg(
            F.count(F.lit(1)).alias("_n"), F.bit_or(bit).alias("_bits"))
        return bool(words.where(F.col("_n") > F.bit_count("_bits")).take(1))
    return bool(df.where(F.col(row_id).isNotNull()).groupBy(row_id).count().where("count > 1").take(1))


def position_bucket(ranked: DataFrame, name: str = "rn") -> Column:
    """Even buckets of a global row number: monotone in its order, and no tie is larger than a row."""
    rows = ranked.count()
    size = max(1, -(-rows // buckets_for(ranked.sparkSession, rows)))
    return F.floor((F.col(name) - 1) / F.lit(size)).cast("int")


def kth_smallest(df: DataFrame, value: str, ks: dict, group: str | None = None,
                 bins: int = 1024, cached: bool = False, weight: str | None = None) -> dict:
    """Exact k-th smallest (1-based) non-null ``value`` per group.

    ``ks`` maps group value -> k, or group value -> list of k (use the key
    ``None`` when ``group`` is None); it may also be a function of the group
    sizes returning that map.  Answers mirror the shape of ``ks``.  A k
    below 1 or above the group size is answered with ``None``.

    Integers stay integers: a histogram over their high bits ends after at most
    seven rounds at 1,024 bins.  Doubles start with equal-width histograms; where
    one round leaves more than half of the values in one bin, the next one cuts at
    approximate quantiles of what is left, so that every round shrinks a skewed
    range too.  A round is one aggregation for all open requests, returning at most
    ``bins`` + 1 buckets each to the driver, never the rows.

    Where the values are few (a sketch of their number tells), the rows are first counted per
    value; else two narrow columns are kept for the rounds, unless df is ``cached``.  A row of df
    stands for ``weight`` rows, if that is given: df is then small and written.
    """
    gcol = F.col(group) if group else F.lit(None).cast("int")
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    base = df.select(gcol.alias("_g"), F.col(value).cast("bigint" if whole else "double").alias("_v"),
                     *([F.col(weight).alias("_w")] if weight else [])).where(F.col("_v").isNotNull())
    sketch = F.lit(None) if cached or weight else F.approx_count_distinct("_v")
    found = base.groupBy("_g").agg((F.sum("_w") if weight else F.count(F.lit(1))).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
                                   sketch.cast("bigint").alias("values")).limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: this is not a class column")
    stats = {r["_g"]: (r["n"], r["lo"], r["hi"]) for r in found}
    if weight:
        return _kth_rounds(base, stats, ks, bins, whole)
    if cached:
        return _kth_rounds(base.withColumn("_w", F.lit(1)), stats, ks, bins, whole)
    if FEW_VALUES * sum(r["values"] for r in found) <= sum(r["n"] for r in found):
        return _kth_rounds(cut_lineage(base.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_w"))), stats, ks, bins, whole)
    # the refinement rounds re-read two narrow columns: keep them (spills to disk)
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _kth_rounds(base.withColumn("_w", F.lit(1)), stats, ks, bins, whole)
    finally:
        base.unpersist()


MAX_GROUPS = 100000
FEW_VALUES = 16     # rows per value from which values are counted first
MAX_ROUNDS = 64


class _Request:
    """The k-th smallest of a group, among its values in [lo, hi]."""

    def __init__(self, group, k: int, lo, hi, size: int):
        self.group, self.k, self.lo, self.hi, self.size = group, k, lo, hi, size
        self.skewed = not self._even()

    def _even(self) -> bool:
        """The range can be cut into bins of equal width."""
        width = (self.hi - self.lo) / 65536
        return 0 < width < float("inf")

    def inside(self) -> Column:
        own = F.col("_g").isNull() if self.group is None else F.col("_g") == F.lit(self.group)
        return own & F.col("_v").between(F.lit(self.lo), F.lit(self.hi))

    def bucket(self, bins: int, whole: bool, cuts: list | None) -> Column:
        if cuts is not None:  # a cut's own value gets a bucket of its own
            return bucket_of(F.col("_v"), cuts) + bucket_of(F.col("_v"), cuts, strict=True)
        if whole:
            shift = 0
            while (self.hi >> shift) - (self.lo >> shift) >= bins:
                shift += 1
            return F.shiftright(F.col("_v"), shift) - F.lit(self.lo >> shift)
        width = (self.hi - self.lo) / bins
        return F.least(F.floor((F.col("_v") - F.lit(self.lo)) / F.lit(width)), F.lit(bins - 1))

    def narrow(self, hist: list, whole: bool):
        """The answer, or None with the range narrowed to the bucket of the k-th value."""
        seen = 0
        for _, count, lo, hi in sorted(hist):
            if seen + count >= self.k:
                stuck = count > self.size / 2
                self.k, self.lo, self.hi, self.size = self.k - seen, lo, hi, count
                self.skewed = not whole and (stuck or not self._even())
                return lo if lo == hi else None
            seen += count
        raise RuntimeError(f"{seen} values counted, {self.k} wanted: the rows changed between two passes")


def _kth_rounds(base: DataFrame, stats: dict, ks: dict, bins: int, whole: bool) -> dict:
    """Rounds over (_g, _v, _w: rows), stats being rows, smallest and largest value per group."""
    if callable(ks):  # ranks chosen from the group sizes counted here (saves a job)
        ks = ks({g: v[0] for g, v in stats.items()})
    asked = [(g, i, kk) for g, k in ks.items() for i, kk in enumerate(k if isinstance(k, (list, tuple)) else [k])]
    answer: dict = {}
    open_: dict = {}
    for g, i, k in asked:
        n, lo, hi = stats.get(g, (0, None, None))
        if k is None or k < 1 or k > n:
            answer[g, i] = None
        elif lo == hi:
            answer[g, i] = lo
        else:
            open_[g, i] = _Request(g, k, lo, hi, n)
    for _ in range(MAX_ROUNDS):
        if not open_:
            break
        # requests with the same group and range share one histogram
        ranges: dict = {}
        for at, r in open_.items():
            ranges.setdefault((r.group, r.lo, r.hi), []).append(at)
        firsts = {tag: open_[ats[0]] for tag, ats in enumerate(ranges.values())}
        skewed = {tag: r for tag, r in firsts.items() if r.skewed}
        cuts = _quantile_cuts(base, skewed) if skewed else {}
        parts = F.array(*[F.when(r.inside(), F.struct(
            F.lit(tag).alias("t"), r.bucket(bins, whole, cuts.get(tag)).cast("bigint").alias("b")))
            for tag, r in firsts.items()])
        hist: dict = {}
        for r in (base.select("_v", "_w", F.explode(parts).alias("p")).where("p is not null")
                  .groupBy("p.t", "p.b").agg(F.sum("_w").alias("c"), F.min("_v").alias("lo"),
                                             F.max("_v").alias("hi")).collect()):
            hist.setdefault(r["t"], []).append((r["b"], r["c"], r["lo"], r["hi"]))
        for tag, ats in enumerate(ranges.values()):
            for at in ats:
                found = open_[at].narrow(hist.get(tag, []), whole)
                if found is not None:
                    answer[at] = found
                    del open_[at]
    if open_:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds: {sorted(map(str, open_))}")
    return {g: [answer[g, i] for i in range(len(k))] if isinstance(k, (list, tuple)) else answer[g, 0]
            for g, k in ks.items()}


def _quantile_cuts(base: DataFrame, requests: dict, points: int = 255) -> dict:
    """Approximate quantiles of each request's range, all of them values of it."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    row = base.agg(*[F.percentile_approx(F.when(r.inside(), F.col("_v")), probs, 10000).alias(f"q{tag}")
                     for tag, r in requests.items()]).first()
    return {tag: sorted({*(row[f"q{tag}"] or []), r.hi}) for tag, r in requests.items()}


def exact_median(df: DataFrame, value: str, group: str | None, groups: list, weight: str | None = None) -> dict:
    """Exact median per group (mean of the two middle values for even sizes), of rows that stand
    for ``weight`` rows each, if that is given."""

    def ranks(sizes):
        out = {}
        for g in groups:
            n = sizes.get(g, 0)
            if n <= 0:
                out[g] = [None, None]
            elif n % 2:
                out[g] = [(n + 1) // 2, (n + 1) // 2]
            else:
                out[g] = [n // 2, n // 2 + 1]
        return out

    vals = kth_smallest(df, value, ranks, group, weight=weight)
    out = {}
    for g in groups:
        a, b = vals.get(g, [None, None])
        out[g] = None if a is None or b is None else (a + b) / 2.0
    return out


def localize(df: DataFrame) -> DataFrame:
    """Materialise a small result (K x K cells, per-class numbers) as a local
    relation so later steps do not recompute it from the rows.  Only for
    results whose size is bounded by a constant such as K^2: more rows than
    ``MAX_GROUPS`` raise."""
    rows = df.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} rows: not a bounded result")
    return df.sparkSession.createDataFrame(rows, df.schema)


ROWS_PER_BUCKET = 2000000


def buckets_for(spark, rows: int | None = None) -> int:
    """Bucket count for split windows: the shuffle width, and where the number of
    rows is known at least one for each two million of them."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return n if rows is None else max(n, -(-rows // ROWS_PER_BUCKET))
