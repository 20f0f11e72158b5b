"""Split gain of features from class histograms.

All features are cut into ``bins`` equal widths between their extremes (a null is a bin of its
own, before the others).  One aggregation gives rows and positives per (node, feature, bin);
windows over a feature's bins then give the impurity that each cut takes off,

    gain = 2 * (S (N - S) / N  -  s (n - s) / n  -  (S - s) (N - n - S + s) / (N - n))

(Gini impurity times rows), and a feature's gain is that of its best cut, summed over the nodes
of a tree grown ``levels`` deep: each node is cut by its best feature (ties: the first
one by name, then the lowest cut).  A level is one pass over the rows; only the nodes' cuts,
fewer than 2 ** levels, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import sampling as SM
from .learn import GAIN_FLOOR, GAIN_ROWS

BINS = 64
TOP = 500
MAX_LEVELS = 10


def _binned(df: DataFrame, features: list, bins: int, label: str) -> DataFrame:
    """The features as bins b0, b1, ... and the label as y."""
    ends = df.agg(*[F.min(F.col(f"`{c}`").cast("double")).alias(f"lo{i}") for i, c in enumerate(features)],
                  *[F.max(F.col(f"`{c}`").cast("double")).alias(f"hi{i}") for i, c in enumerate(features)]).first()

    def at(i: int, c: str) -> Column:
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or lo == hi:
            return F.when(F.col(f"`{c}`").isNull(), -1).otherwise(0)
        x = F.col(f"`{c}`").cast("double")
        cut = F.floor((x - F.lit(lo)) / (F.lit(hi) - F.lit(lo)) * F.lit(bins))
        return F.when(x.isNull(), -1).otherwise(F.least(cut, F.lit(bins - 1)))

    return df.where(F.col(label).isNotNull()).select(
        *[at(i, c).cast("int").alias(f"b{i}") for i, c in enumerate(features)], (F.col(label) == 1).cast("int").alias("y"))


def _impurity(n: Column, s: Column) -> Column:
    return F.when(n > 0, s * (n - s) / n).otherwise(0.0)


def _cuts(rows: DataFrame, names: DataFrame, count: int) -> DataFrame:
    """node, feature, bin, gain of every cut between the bins that are met."""
    long = rows.select("node", "y", F.posexplode(F.array(*[f"b{i}" for i in range(count)])).alias("i", "bin"))
    cells = long.groupBy("node", "i", "bin").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    upto = Window.partitionBy("node", "i").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("node", "i")
    c = cells.select("node", "i", "bin", *[F.sum(x).over(upto).cast("double").alias(x) for x in ("n", "s")],
                     *[F.sum(x).over(whole).cast("double").alias(f"{x}_all") for x in ("n", "s")]).where("n < n_all")
    n, s, big, pos = F.col("n"), F.col("s"), F.col("n_all"), F.col("s_all")
    gain = F.lit(2.0) * (_impurity(big, pos) - _impurity(n, s) - _impurity(big - n, pos - s))
    return c.select("node", "i", "bin", gain.alias("gain")).join(F.broadcast(names), "i")


def histogram_gain(df: DataFrame, features: list, min_gain: float = GAIN_FLOOR, top: int = TOP, levels: int = 2,
                   bins: int = BINS, label: str = "label") -> DataFrame:
    """feature, gain: features of at least ``min_gain``, at most ``top``, the largest gain first."""
    if not 1 <= levels <= MAX_LEVELS:
        raise ValueError(f"levels is between 1 and {MAX_LEVELS}")
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "i int, feature string")
    rows = cut_lineage(_binned(df, features, bins, label).withColumn("node", F.lit(1)))
    total = None
    for level in range(levels):
        best = _cuts(rows, names, len(features)).groupBy("node", "i", "feature").agg(
            F.max(F.struct("gain", F.negate("bin"))).alias("m"))
        found = cut_lineage(best.select("node", "i", "feature", F.col("m.gain").alias("gain"), (-F.col("m.col2")).alias("bin")))
        total = found if total is None else total.unionByName(found)
        if level + 1 < levels:
            chosen = found.where("gain > 0").groupBy("node").agg(
                F.min(F.struct((-F.col("gain")).alias("g"), "feature", "i", "bin")).alias("m")).select("node", "m.i", "m.bin").collect()
            if not chosen:
                break
            side = F.lit(None).cast("int")
            for r in chosen:
                side = F.when(F.col("node") == r["node"], 2 * F.col("node") + (F.col(f"b{r['i']}") > r["bin"]).cast("int")).otherwise(side)
            rows = rows.withColumn("node", side).where("node is not null")
    gains = names.join(total.groupBy("feature").agg(F.sum("gain").alias("gain")), "feature", "left").select(
        "feature", F.coalesce("gain", F.lit(0.0)).alias("gain"))
    return gains.where(F.col("gain") >= min_gain).orderBy(F.desc("gain"), "feature").limit(top)


def balanced_gain(df: DataFrame, features: list, min_gain: float = GAIN_FLOOR, top: int = TOP, levels: int = 2,
                  sample_rows: int = GAIN_ROWS, seed: int = 0) -> DataFrame:
    """M1 + T2: ``histogram_gain`` on a class-balanced sample of labelled rows."""
    return histogram_gain(cut_lineage(SM.class_balanced(df, sample_rows, seed).drop("copy")), features, min_gain, top, levels)
