"""Label normalisation and input validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_labels(df: DataFrame, task: str, label: str = "label") -> DataFrame:
    """``ssl`` drops unlabelled (0) rows and maps -1 -> 0; ``noisy`` maps
    label == 1 -> 1 and anything else -> 0; ``pu`` keeps 0 / 1."""
    if task == "ssl":
        return df.where(F.col(label) != 0).withColumn(
            label, F.when(F.col(label) == -1, 0).otherwise(F.col(label)))
    if task == "noisy":
        return df.withColumn(label, F.when(F.col(label) == 1, 1).otherwise(0))
    if task == "pu":
        return df.withColumn(label, F.when(F.col(label) == 1, 1).otherwise(0))
    raise ValueError(f"unknown task {task!r}")


def validate_psx(df: DataFrame, num_classes: int, psx: str = "psx", weight: str | None = None) -> DataFrame:
    """P10: counts of psx rows of the wrong length or with values outside [0, 1]; a row of df
    stands for ``weight`` rows, if that is given."""
    p, n = F.col(psx), F.col(weight) if weight else F.lit(1)
    return df.agg(*[F.coalesce(F.sum(F.when(test, n)), F.lit(0)).cast("bigint").alias(name) for name, test in (
        ("n_rows", F.lit(True)), ("n_bad_size", F.size(p) != num_classes),
        ("n_out_of_range", F.exists(p, lambda v: (v < 0) | (v > 1))))])


def assert_valid(df: DataFrame, num_classes: int, psx: str = "psx", weight: str | None = None) -> None:
    r = validate_psx(df, num_classes, psx, weight).first()
    if r["n_bad_size"] or r["n_out_of_range"]:
        raise ValueError(f"invalid psx: {r['n_bad_size']} rows of wrong size, "
                         f"{r['n_out_of_range']} rows outside [0, 1]")
