"""Feature operators over a weak-label frame.

Each operator is ``df -> df`` or ``fit(df) -> lookups`` plus ``apply``.  Lookup
joins follow one rule: a lookup whose size is bounded by a constant (classes,
blocks, edges) is broadcast; a lookup whose size grows with the data (values
of a category) is written out and counted first: a small one is broadcast, so that
the rows stay where they are, a larger one is left to a shuffle join with skew
splitting.
"""

from __future__ import annotations

import itertools
import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import (BROADCAST_ROWS, ROWS_PER_BUCKET, bucket_of, buckets_for, distributed_row_number,
                                 global_row_number, ids_repeat, position_bucket, with_total_before)
from ..session import cut_lineage, drop_read
from ..sources.tables import Roles

LOG = logging.getLogger(__name__)

# Fixed values of the reference's feature rules.
FILL_NUM = -1
FILL_CAT = "0"
FILL_TIME = "1970-01-01 00:00:00"
MAX_COUNT_CATS = 100
MAX_COMBINED = 5            # categories and numbers that pairs, means and differences take
DATE_PARTS = ("year", "month", "day", "hour", "weekday")
BIN_MIN_DISTINCT = 100      # more distinct values than this -> quantile bins
BIN_PER_VALUES = 10         # bins = min(nunique // 10, 255)
BIN_MAX = 255
BLOCK_OVERLAP = 0.1         # share of the smaller value set
BUCKETS_PER_TASK = 4        # time buckets of a split value, so that tasks get even shares


def feat_name(prefix: str, cls: str, feat: str) -> str:
    """Generated column name ``{prefix}{Class}:{source}``."""
    return f"{prefix}{cls}:{feat}"


# ------------------------------------------------------------------ P1, P2, P3, P7, P8, P9

def fillna_roles(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Number -> -1, category -> "0", time -> 1970-01-01, in one projection."""
    roles = roles or Roles.infer(df)
    out = []
    for c in df.columns:
        if c in roles.num:
            out.append(F.coalesce(F.col(c), F.lit(FILL_NUM).cast(dict(df.dtypes)[c])).alias(c))
        elif c in roles.cat:
            out.append(F.coalesce(F.col(c), F.lit(FILL_CAT)).alias(c))
        elif c in roles.time:
            out.append(F.coalesce(F.col(c), F.lit(FILL_TIME).cast(dict(df.dtypes)[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def drop_time(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Drop the time columns."""
    roles = roles or Roles.infer(df)
    return df.drop(*roles.time)


def hash_categories(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Replace categories by a stable 60-bit hash (Python's ``hash`` is salted): the
    first 15 hex digits of the MD5.  A null stays null."""
    roles = roles or Roles.infer(df)

    def hashed(c: str) -> Column:
        return F.conv(F.substring(F.md5(F.col(c).cast("string")), 1, 15), 16, 10).cast("bigint")

    return df.select(*[hashed(c).alias(c) if c in roles.cat else F.col(c) for c in df.columns])


def nonneg_rows(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Keep rows with a non-negative index."""
    return df.where(F.col(row_id) >= 0)


def select_raw(df: DataFrame, roles: Roles | None = None, keep=("row_id", "label")) -> DataFrame:
    """The raw input columns (plus id and label)."""
    roles = roles or Roles.infer(df)
    return df.select(*[c for c in keep if c in df.columns], *roles.raw)


# ------------------------------------------------------------------ P4 narrowing

FLOAT_MAX = 3.4028234663852886e38
INT_TYPES = (("tinyint", -128, 127), ("smallint", -32768, 32767),
             ("int", -2147483648, 2147483647), ("bigint", -(2 ** 63), 2 ** 63 - 1))


def narrow_stats(df: DataFrame, cols: list) -> DataFrame:
    """Per column min, max and the number of values that do not survive a
    float round trip, all in one aggregation; then the narrowest type.

    Integers: smallest integer type holding [min, max].  Doubles: ``float``
    when every value round-trips exactly (lossless mode), else ``double``.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.count(F.when(x.cast("float").cast("double") != x, 1)).alias(f"{c}__lossy"),
                 F.count(F.when(x != F.floor(x), 1)).alias(f"{c}__frac")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`, `{c}__lossy`, `{c}__frac`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (col, min, max, n_lossy, n_frac)")
    int_type = None
    for name, lo, hi in INT_TYPES:
        cond = (F.col("min") >= lo) & (F.col("max") <= hi)
        int_type = F.when(cond, F.lit(name)) if int_type is None else int_type.when(cond, F.lit(name))
    kind = (F.when(F.col("n_frac") == 0, int_type.otherwise(F.lit("double")))
            .when(F.col("n_lossy") == 0, F.lit("float")).otherwise(F.lit("double")))
    return long.select("col", "min", "max", F.col("n_lossy").cast("bigint").alias("n_lossy"),
                       kind.alias("type"))


def narrow(df: DataFrame, cols: list, lossy: bool = False) -> DataFrame:
    """The columns cast to the types of ``narrow_stats``.

    ``lossy``: a fractional column becomes ``float`` wherever its range allows it, whether or
    not its values survive; integers never lose anything.  Nulls stay null.
    """
    stats = {r["col"]: r for r in narrow_stats(df, cols).collect()}     # one row per column

    def kind(r) -> str:
        if lossy and r["type"] == "double" and r["max"] is not None and max(abs(r["min"]), abs(r["max"])) <= FLOAT_MAX:
            return "float"
        return r["type"]

    return df.select(*[F.col(f"`{c}`").cast(kind(stats[c])).alias(c) if c in stats else F.col(f"`{c}`") for c in df.columns])


# ------------------------------------------------------------------ P5, P11, P12

def pair_code(df: DataFrame, a: str, b: str, name: str = "pair_code") -> DataFrame:
    """P5: the reference's pair code ``a * max(b) + b`` (it collides; D6)."""
    mx = df.agg(F.max(F.col(b).cast("bigint"))).first()[0] or 0
    return df.withColumn(name, F.col(a).cast("bigint") * F.lit(int(mx)) + F.col(b).cast("bigint"))


def _part(t: Column, part: str) -> Column:
    return {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
            "weekday": F.weekday}[part](t)


def date_parts_fit(df: DataFrame, time_col: str) -> list:
    """P11 fit: the date parts with more than one distinct value (smallest below largest)."""
    parts = {p: _part(F.col(time_col), p) for p in DATE_PARTS}
    row = df.agg(*[(F.min(x) < F.max(x)).alias(p) for p, x in parts.items()]).first()
    return [p for p in DATE_PARTS if row[p]]


def date_parts(df: DataFrame, time_col: str, parts: list | None = None) -> DataFrame:
    """Year, month, day, hour, weekday (Monday = 0) as category columns."""
    parts = date_parts_fit(df, time_col) if parts is None else parts
    return df.select("*", *[_part(F.col(time_col), p).alias(
        feat_name("c_", "KeyTimeDate", f"{time_col}:{p}")) for p in parts])


def _first_columns(cols: list, limit: int, what: str) -> list:
    """The rule's first ``limit`` columns; the ones left out are logged by name."""
    if len(cols) > limit:
        LOG.warning("%s takes %d columns and leaves out %s", what, limit, ", ".join(cols[limit:]))
    return cols[:limit]


def num_diff(df: DataFrame, nums: list, limit: int = MAX_COMBINED) -> DataFrame:
    """The first number minus each of the next (``limit`` numbers in all)."""
    nums = _first_columns(nums, limit, "num_diff")
    if len(nums) < 2:
        return df
    first = nums[0]
    return df.select("*", *[(F.col(first) - F.col(o)).alias(
        feat_name("n_", "NumDiffOrder2LEVEL", f"{first}_{o}_diff")) for o in nums[1:]])


# ------------------------------------------------------------------ A2-A7 aggregates

def cat_cardinality(df: DataFrame, cats: list, approx: bool = False) -> DataFrame:
    """A2: distinct values per category column: the distinct (column, value) pairs, counted."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in cats])
    return _value_pairs(df, cats).agg(*[F.count_if(F.col("col") == c).alias(f"n_{c}") for c in cats])


def attach(df: DataFrame, lookups: list) -> DataFrame:
    """Left joins with (lookup, keys) on non-null keys (a NULL key never matches: result NULL).

    The rows are shuffled for large lookups only, and for these first, while they are narrow.
    Columns come in the order of plain joins one after the other."""
    order = df.columns
    for lookup, keys in lookups:
        order = [*keys, *(c for c in order if c not in keys), *(c for c in lookup.columns if c not in keys)]
    written = [(cut_lineage(lookup), keys) for lookup, keys in lookups]
    small = [lookup.count() <= BROADCAST_ROWS for lookup, _ in written]
    out = df
    for lookup, keys in (w for w, s in zip(written, small, strict=True) if not s):
        out = out.join(lookup, keys, "left")
    for lookup, keys in (w for w, s in zip(written, small, strict=True) if s):
        out = out.join(F.broadcast(lookup), keys, "left")
    return out.select(*[F.col(f"`{c}`") for c in order])


def pair_counts(df: DataFrame, pairs: list) -> DataFrame:
    """Counts of value pairs (a, b, name), for rows in which neither is null.

    Pairs of columns with few values are counted and broadcast.  The others take their turns
    at the column with more values: the rows are shuffled by it once, and all its pairs are
    counted in windows within its values.  Where one value (or the nulls) fills more than a
    bucket, its pairs are counted and joined instead, with skew splitting.
    """
    names = dict.fromkeys(c for a, b, _ in pairs for c in (a, b))
    most, size = {}, {}
    for c in names:
        size[c], most[c], rows = df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    order, joined, turns = df.columns, [], {}
    for a, b, name in pairs:
        order = [a, b, *(c for c in order if c not in (a, b)), name]
        first = max((a, b), key=lambda c: size[c])
        if size[a] * size[b] > BROADCAST_ROWS and (most[first] or 0) <= ROWS_PER_BUCKET:
            turns.setdefault(first, []).append((a, b, name))
        else:
            joined.append((df.where(all_known([a, b])).groupBy(F.col(f"`{a}`"), F.col(f"`{b}`")).agg(
                F.count(F.lit(1)).alias(name)), [a, b]))
    out = df
    for first, own in turns.items():
        out = out.repartition(buckets_for(df.sparkSession, rows or 0), F.col(f"`{first}`"))
        for a, b, name in own:
            count = F.count(F.lit(1)).over(Window.partitionBy(F.col(f"`{a}`"), F.col(f"`{b}`")))
            out = out.withColumn(name, F.when(all_known([a, b]), count))
    return attach(out, joined).select(*[F.col(f"`{c}`") for c in order])


def all_known(keys: list) -> Column:
    """None of the key columns is null."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    return known


def cat_count(df: DataFrame, cats: list, limit: int = MAX_COUNT_CATS) -> DataFrame:
    """A3: count of the row's value in each category column (the first ``limit``).

    Each column is counted by itself, with map-side partial counts, and its counts
    are joined back.
    """
    return attach(df, [
        (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(feat_name("n_", "CatCnt", c))), [c])
        for c in _first_columns(cats, limit, "cat_count")])


def cat_pair_count(df: DataFrame, cats: list, limit: int = MAX_COMBINED) -> DataFrame:
    """A4: count of the exact pair (a, b) for every pair of the first ``limit`` cats."""
    return pair_counts(df, [(a, b, feat_name("n_", "CatCnt2LEVEL", f"{a}_{b}_cnt")) for a, b in itertools.combinations(
        _first_columns(cats, limit, "cat_pair_count"), 2)])


def num_mean_by_cat(df: DataFrame, cats: list, nums: list, limit: int = MAX_COMBINED) -> DataFrame:
    """A5: mean of each number per category value; one aggregation per category
    computes all its means (numbers that are also categories are skipped)."""
    cats = _first_columns(cats, limit, "num_mean_by_cat")
    nums = _first_columns([n for n in nums if n not in cats], limit, "num_mean_by_cat")
    return attach(df, [(df.where(F.col(c).isNotNull()).groupBy(c).agg(
        *[F.avg(n).alias(feat_name("n_", "NumMean2LEVEL", f"{c}_{n}_mean")) for n in nums]), [c]) for c in cats])


def cat_label_rate(df: DataFrame, cat: str, label: str = "label", inverted: bool = True) -> DataFrame:
    """Per category value ``count / positive count`` (the reference's inverted
    rate, D7) or, with ``inverted=False``, the positive rate.  NULL without positives."""
    name = feat_name("n_", "CatMeanLabel", cat)
    g = df.where(F.col(cat).isNotNull()).groupBy(cat).agg(
        F.count(F.lit(1)).alias("_cnt"), F.count(F.when(F.col(label) == 1, 1)).alias("_pos"))
    rate = (F.col("_cnt") / F.col("_pos")) if inverted else (F.col("_pos") / F.col("_cnt"))
    lk = g.select(cat, F.when(F.col("_pos") > 0, rate).alias(name))
    return attach(df, [(lk, [cat])])


# ------------------------------------------------------------------ W1, W2 windows

def _long_values(df: DataFrame, cats: list, *keep: str) -> DataFrame:
    """(keep, col, value) for the non-null values of the category columns."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cats
    ])).alias("p")).select(*keep, "p.col", "p.value").where(F.col("value").isNotNull())


def _time_ordered(df: DataFrame, cats: list, time_col: str | None, row_id: str) -> DataFrame:
    """(row_id, _us, _pos, _bkt, col, value): the values in time order (nulls last, ties
    by row_id), in buckets of equal size, so that equal times are split as well."""
    order = ([F.col(time_col).asc_nulls_last()] if time_col else []) + [F.col(row_id).asc()]
    narrow = df.select(row_id, *([time_col] if time_col else []), *cats)
    ranked = global_row_number(narrow, order, "_pos")
    us = F.unix_micros(F.col(time_col).cast("timestamp")) if time_col else F.lit(None).cast("bigint")
    return _long_values(ranked.withColumn("_us", us).withColumn("_bkt", position_bucket(ranked, "_pos")),
                        cats, row_id, "_us", "_pos", "_bkt")


def _attach_long(df: DataFrame, long: DataFrame, names: dict, value: str, row_id: str) -> DataFrame:
    """One column per key of ``names`` (source column -> new name), from (row_id, col, value)."""
    wide = long.groupBy(row_id).agg(*[F.max(F.when(F.col("col") == c, F.col(value))).alias(n)
                                      for c, n in names.items()])
    return df.join(wide, row_id, "left")


_VALUE = ["col", "value"]


def _value_windows(df: DataFrame, cats: list, time_col: str | None, row_id: str, names: dict, within, total,
                   combine) -> DataFrame:
    """One column per category from the earlier rows of the row's value, in time order (ties by row_id).

    A column whose values are all small is shuffled by its value once, and its windows run over whole
    values.  For the others the rows are numbered in time order and cut into even buckets: they are
    shuffled by bucket once, a window runs per (value, bucket), and ``combine(within, before)`` adds what
    ``total`` finds in the earlier buckets of the value, from one small row per value and bucket.
    ``within(window)`` is the column over rows in order.  Rows with a null value or no id get NULL.
    """
    order = [*([F.col(time_col).asc_nulls_last()] if time_col else []), F.col(row_id).asc()]
    us = F.unix_micros(F.col(time_col).cast("timestamp")) if time_col else F.lit(None).cast("bigint")
    most, rows = {}, 0
    for c in cats:
        most[c], rows = df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = buckets_for(df.sparkSession, rows)
    split = [c for c in cats if most[c] > ROWS_PER_BUCKET or most[c] * parts > 2 * rows]
    # many columns stay behind and are joined once, instead of being shuffled for each category
    wide = len(df.columns) > 2 * (len(cats) + 2)
    out = (df.select(row_id, *([time_col] if time_col else []), *cats) if wide else df).withColumn("_us", us)

    def known(c: str, found: Column) -> Column:
        return F.when(F.col(f"`{c}`").isNotNull() & F.col(row_id).isNotNull(), found)

    if split:
        ranked = global_row_number(out, order, "_pos", rows)
        size = max(1, -(-rows // (BUCKETS_PER_TASK * parts)))
        bucketed = ranked.withColumn("_bkt", F.floor((F.col("_pos") - 1) / F.lit(size)).cast("int"))
        out = bucketed.repartition(parts, "_bkt")
        lookups = []
        for c in split:
            own, before = F.col(f"`{c}`"), f"_before_{c}"
            earlier = Window.partitionBy(c).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
            lookups.append((bucketed.where(own.isNotNull()).groupBy(own, "_bkt").agg(total[0].alias("_t")).select(
                own, "_bkt", total[1](F.col("_t")).over(earlier).alias(before)), [c, "_bkt"]))
            out = out.withColumn(f"_within_{c}", within(Window.partitionBy(own, "_bkt").orderBy("_pos")))
        out = attach(out, lookups)
        for c in split:
            out = out.withColumn(names[c], known(c, combine(F.col(f"_within_{c}"), F.col(f"_before_{c}"))))
    shuffled, before = bool(split), None
    for c in (c for c in cats if c not in split):
        if shuffled:        # written in between: one shuffle of the rows at a time is on disk
            written = cut_lineage(out)
            if before is not None:
                drop_read(before)
            out = before = written
        shuffled = True
        out = out.repartition(parts, F.col(f"`{c}`")).withColumn(
            names[c], known(c, combine(within(Window.partitionBy(F.col(f"`{c}`")).orderBy(*order)), None)))
    found = [F.col(f"`{names[c]}`") for c in cats]
    if wide:        # written first, so that the shuffles so far are gone when the many columns are shuffled
        return df.join(cut_lineage(out.select(row_id, *found)), row_id, "left")
    return out.select(row_id, *[F.col(f"`{c}`") for c in df.columns if c != row_id], *found)


def cat_running_count(df: DataFrame, cats: list, time_col: str | None = "t_1",
                      row_id: str = "row_id") -> DataFrame:
    """0-based running count of the row's value in time order (ties by row_id).

    A hot value is counted per time bucket, with the counts of its earlier buckets added, so
    that it is spread over many tasks (X3).  The rows are not unpivoted; where an id repeats they are,
    and are joined back on ``row_id``.  NULL -> NULL.
    """
    names = {c: feat_name("n_", "CatCumCnt", c) for c in cats}
    if not ids_repeat(df, row_id):
        return _value_windows(df, cats, time_col, row_id, names, lambda w: (F.row_number().over(w) - 1).cast("bigint"),
                              (F.count(F.lit(1)), F.sum),
                              lambda own, before: own if before is None else own + F.coalesce(before, F.lit(0)))
    rows = _time_ordered(df, cats, time_col, row_id)
    earlier = Window.partitionBy(*_VALUE).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*_VALUE, "_bkt").agg(F.count(F.lit(1)).alias("_n")).select(
        *_VALUE, "_bkt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*_VALUE, "_bkt").orderBy("_pos")) - 1
    counted = rows.join(before, [*_VALUE, "_bkt"]).select(row_id, "col", (within + F.col("_before")).alias("_run"))
    return _attach_long(df, counted, names, "_run", row_id)


def cat_time_gap(df: DataFrame, cats: list, time_col: str = "t_1", row_id: str = "row_id",
                 drop_time_col: bool = False) -> DataFrame:
    """Seconds since the previous row with the same value (time order, ties by
    row_id).  Per (value, time bucket) lag plus the latest time of the earlier
    buckets of that value, so no hot value sits in one task.  NULL value -> NULL."""
    names = {c: feat_name("n_", "CatTimeDiff2LEVEL", f"{c}_{time_col}_diff:1") for c in cats}
    if not ids_repeat(df, row_id):
        out = _value_windows(df, cats, time_col, row_id, names, lambda w: F.lag("_us", 1).over(w), (F.max("_us"), F.max),
                             lambda own, before: (F.col("_us") - (own if before is None else F.coalesce(own, before))) / F.lit(1e6))
        return out.drop(time_col) if drop_time_col else out
    rows = _time_ordered(df, cats, time_col, row_id)
    earlier = Window.partitionBy(*_VALUE).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.groupBy(*_VALUE, "_bkt").agg(F.max("_us").alias("_mx")).select(
        *_VALUE, "_bkt", F.max("_mx").over(earlier).alias("_before"))
    within = F.lag("_us", 1).over(Window.partitionBy(*_VALUE, "_bkt").orderBy("_pos"))
    gaps = rows.join(last, [*_VALUE, "_bkt"]).select(
        row_id, "col", ((F.col("_us") - F.coalesce(within, F.col("_before"))) / F.lit(1e6)).alias("_gap"))
    out = _attach_long(df, gaps, names, "_gap", row_id)
    return out.drop(time_col) if drop_time_col else out


# ------------------------------------------------------------------ E1 blocks, A7, E2

def capped_sample(df: DataFrame, n: int, seed: int = 0, row_id: str = "row_id") -> DataFrame:
    """Exactly ``min(n, N)`` rows — the n smallest seeded keys (ties by row_id)."""
    from .sampling import take_smallest
    return take_smallest(df, n, seed, row_id)


def _value_pairs(df: DataFrame, cats: list) -> DataFrame:
    return _long_values(df, cats).distinct()


def value_table(df: DataFrame, cats: list) -> DataFrame:
    """The distinct (col, value) of the category columns, nulls included, written out: one pass over
    the rows for the blocks, the dictionary and the codes."""
    return cut_lineage(df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for c in cats])).alias("p")).select("p.*").distinct())


def block_edges(df: DataFrame, cats: list, overlap: float = BLOCK_OVERLAP, values: DataFrame | None = None) -> DataFrame:
    """Edges (col_a, col_b) whose value sets overlap by more than ``overlap`` of the
    smaller set (both sets larger than one value)."""
    pairs = _value_pairs(df, cats) if values is None else values.where("value is not null")
    sizes = pairs.groupBy("col").agg(F.count(F.lit(1)).alias("n"))
    a = pairs.select(F.col("col").alias("col_a"), "value")
    b = pairs.select(F.col("col").alias("col_b"), "value")
    inter = (a.join(b, "value").where(F.col("col_a") < F.col("col_b"))
             .groupBy("col_a", "col_b").agg(F.count(F.lit(1)).alias("n_both")))
    sa = sizes.select(F.col("col").alias("col_a"), F.col("n").alias("n_a"))
    sb = sizes.select(F.col("col").alias("col_b"), F.col("n").alias("n_b"))
    j = inter.join(F.broadcast(sa), "col_a").join(F.broadcast(sb), "col_b")
    less = F.least("n_a", "n_b")
    return j.where((less > 1) & (F.col("n_both") / less > F.lit(overlap))).select("col_a", "col_b")


def cat_blocks(df: DataFrame, cats: list, values: DataFrame | None = None) -> DataFrame:
    """Connected components of the overlap graph over category columns.

    The value work (unpivot, distinct, self join on value) runs on Spark over all
    rows (or on their ``value_table``, if given); only the edge list — at most C*(C-1)/2
    column-name pairs — reaches the driver, where components are numbered from 1 in column order.
    """
    edges = [(r["col_a"], r["col_b"]) for r in block_edges(df, cats, values=values).collect()]
    adj = {c: set() for c in cats}
    for x, y in edges:
        adj[x].add(y)
        adj[y].add(x)
    block = {}
    nxt = 0
    for c in cats:
        if c in block:
            continue
        nxt += 1
        stack = [c]
        block[c] = nxt
        while stack:
            u = stack.pop()
            for v in adj[u]:
                if v not in block:
                    block[v] = nxt
                    stack.append(v)
    spark = df.sparkSession
    return spark.createDataFrame([(c, block[c]) for c in cats], "col string, block int")


def block_values(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """Distinct values per block (union of the block's columns)."""
    cats = [r["col"] for r in blocks.collect()]
    pairs = _value_pairs(df, cats)
    return pairs.join(F.broadcast(blocks), "col").select("block", "value").distinct()


@dataclass
class BlockEncoder:
    """One dictionary per block shared by its columns; codes follow sorted value
    order (the reference uses first-seen order); values unseen at fit time are
    appended after the existing codes at transform time (J4 anti join)."""

    blocks: dict = field(default_factory=dict)   # col -> block
    dictionary: DataFrame | None = None          # (block, value, code)

    def fit(self, df: DataFrame, blocks: DataFrame, values: DataFrame | None = None) -> "BlockEncoder":
        self.blocks = {r["col"]: r["block"] for r in blocks.collect()}
        vals = self._values(df) if values is None else self._in_blocks(values).select("block", "value").distinct()
        self.dictionary = cut_lineage(_number_values(vals))  # fitted state is materialised
        return self

    def _values(self, df: DataFrame) -> DataFrame:
        """Distinct (block, value), a null of any of the block's columns included."""
        return self._long(df).select("block", "value").distinct()

    def _in_blocks(self, values: DataFrame) -> DataFrame:
        """(col, block, value) of a ``value_table``."""
        block = F.lit(None).cast("int")
        for c, b in self.blocks.items():
            block = F.when(F.col("col") == c, F.lit(b)).otherwise(block)
        return values.select("col", block.alias("block"), "value").where("block is not null")

    def _long(self, df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.lit(b).cast("int").alias("block"), F.col(c).cast("string").alias("value"))
            for c, b in self.blocks.items()])).alias("p")).select(*keep, "p.*")

    def extend(self, df: DataFrame) -> "BlockEncoder":
        """Append codes for values not yet in the dictionary (a null only has a code from fit)."""
        vals = self._values(df).where(F.col("value").isNotNull())
        new = vals.join(self.dictionary, ["block", "value"], "left_anti")
        size = self.dictionary.groupBy("block").agg(F.count(F.lit(1)).alias("_base"))
        appended = _number_values(new).join(F.broadcast(size), "block", "left").select(
            "block", "value", (F.col("code") + F.coalesce(F.col("_base"), F.lit(0))).alias("code"))
        self.dictionary = cut_lineage(self.dictionary.unionByName(appended))
        return self

    def transform(self, df: DataFrame, append: bool = True, row_id: str = "row_id",
                  values: DataFrame | None = None) -> DataFrame:
        """The columns replaced by codes: each one's own values (``value_table`` of df, if given) are looked
        up once, and the rows take their codes from there; a row without an id gets none."""
        if append:
            self.extend(df)
        names = {c: f"_code_{c}" for c in self.blocks}
        own_values = self._long(df).distinct() if values is None else self._in_blocks(values)
        values = cut_lineage(own_values.alias("l").join(
            self.dictionary.alias("d"), (F.col("l.block") == F.col("d.block"))
            & F.col("l.value").eqNullSafe(F.col("d.value"))).select("l.col", "l.value", "d.code"))
        sizes = {r["col"]: r["count"] for r in values.groupBy("col").count().collect()}      # one row per column
        out = df
        for c in sorted(names, key=lambda c: -sizes.get(c, 0)):
            own = values.where(F.col("col") == c).select(F.col("value").alias(f"_value_{c}"), F.col("code").alias(names[c]))
            own = F.broadcast(own) if sizes.get(c, 0) <= BROADCAST_ROWS else own
            out = out.join(own, out[c].cast("string").eqNullSafe(own[f"_value_{c}"]), "left").drop(f"_value_{c}")
        return out.select(*[F.when(F.col(row_id).isNotNull(), F.col(names[c])).cast("int").alias(c) if c in names
                            else F.col(c) for c in df.columns])


def encode_blocks(df: DataFrame, cats: list) -> tuple[BlockEncoder, DataFrame]:
    """E1 + E2 on the same rows: the fitted encoder and the rows with codes, from one value table."""
    values = value_table(df, cats)
    encoder = BlockEncoder().fit(df, cat_blocks(df, cats, values), values)
    return encoder, encoder.transform(df, append=False, values=values)


def _number_values(vals: DataFrame) -> DataFrame:
    """code = rank of the value within its block (0-based, sorted, null last)."""
    ranked = distributed_row_number(vals, ["block"], [F.col("value").asc_nulls_last()], "_rn")
    return ranked.select("block", "value", (F.col("_rn") - 1).cast("bigint").alias("code"))


# ------------------------------------------------------------------ E3, E4

def _exact_order_stats(df: DataFrame, col: str, ranks: list) -> dict:
    """Values at the given 1-based ranks of ``col`` (non-null), exactly.

    The distinct values are counted (a value held by most rows is one row then),
    numbered in order, and their counts summed up over even buckets.
    """
    counts = (df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
              .groupBy("_x").agg(F.count(F.lit(1)).alias("_n")))
    ranked = global_row_number(counts, [F.col("_x")], "_r")
    ranked = ranked.withColumn("_bkt", position_bucket(ranked, "_r"))
    sums = ranked.groupBy(F.col("_bkt").alias("b")).agg(F.sum("_n").alias("n"))
    running = F.sum("_n").over(Window.partitionBy("_bkt").orderBy("_r"))
    ranked = with_total_before(ranked.withColumn("_run", running), F.col("_bkt"), sums, sums.count(), "_before")
    upto = F.col("_run") + F.col("_before")
    want = F.array(*[F.lit(int(r)).cast("bigint") for r in sorted(set(ranks))])
    held = ranked.select("_x", "_n", upto.alias("_upto")).withColumn(
        "_held", F.filter(want, lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n"))))
    rows = held.where(F.size("_held") > 0).select("_x", F.explode("_held").alias("_k")).collect()  # one per rank
    return {r["_k"]: r["_x"] for r in rows}


def quantile_edges(df: DataFrame, col: str, bins: int) -> list:
    """Edges at quantiles i/bins (linear interpolation), duplicates removed."""
    n = df.where(F.col(col).isNotNull()).count()
    if n == 0:
        return []
    qs = [i * (1.0 / bins) for i in range(bins + 1)]
    pos = [(n - 1) * q for q in qs]
    ranks = set()
    for h in pos:
        lo = int(h // 1)
        ranks.add(lo + 1)
        ranks.add(min(lo + 2, n))
    stats = _exact_order_stats(df, col, sorted(ranks))
    edges = []
    for h in pos:
        lo = int(h // 1)
        a = stats[lo + 1]
        b = stats[min(lo + 2, n)]
        edges.append(a + (h - lo) * (b - a))
    return sorted(set(edges))


def bin_index(x: Column, edges: list) -> Column:
    """Index i with edges[i] < x <= edges[i+1]; NULL at or below the first edge
    (D8) or above the last."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    idx = bucket_of(x, edges, strict=True) - 1  # edges strictly below x, minus one
    return F.when(x.isNull() | (x <= F.lit(edges[0])) | (x > F.lit(edges[-1])),
                  F.lit(None)).otherwise(idx).cast("int")


@dataclass
class NumBucketer:
    """E3 / E4 fit: quantile bins for columns with > 100 distinct values, a value
    index for columns with 2..99 distinct values (exactly 100: neither)."""

    edges: dict = field(default_factory=dict)
    index: dict = field(default_factory=dict)    # col -> DataFrame (value, idx)

    def fit(self, df: DataFrame, cols: list) -> "NumBucketer":
        nun = df.agg(*[F.countDistinct(c).alias(c) for c in cols]).first()
        for c in cols:
            u = nun[c]
            if u > BIN_MIN_DISTINCT:
                self.edges[c] = quantile_edges(df, c, min(u // BIN_PER_VALUES, BIN_MAX))
        for c in cols:
            u = nun[c]
            if 1 < u < BIN_MIN_DISTINCT:
                vals = df.select(F.col(c).alias("value")).where(F.col("value").isNotNull()).distinct()
                w = Window.orderBy("value")  # at most 99 rows
                self.index[c] = vals.select("value", (F.row_number().over(w) - 1).alias("idx"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, e in self.edges.items():
            out = out.withColumn(feat_name("c_", "NumsBucket", f"{c}_bucket"), bin_index(F.col(c), e))
        for c, lk in self.index.items():
            name = feat_name("c_", "NumsBucket", f"{c}_bucket")
            lk2 = lk.select(F.col("value").alias(f"_val_{c}"), F.col("idx").cast("int").alias(name))
            out = out.join(F.broadcast(lk2), out[c] == lk2[f"_val_{c}"], "left").drop(f"_val_{c}")
        return out
