"""The label-error pipeline on one weak-label frame (the minimum slice of SURVEY §7).

frame -> stratified folds -> out-of-fold psx -> per-class thresholds ->
confident joint (calibrated) -> rank pruning -> ordered errors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import pruning as P
from ..session import cut_lineage
from ..sources.tables import noisy_lineitem


def with_psx(df: DataFrame, cat: str, num_classes: int = 2, k: int = 5, seed: int = 0,
             checkpoint: bool = True) -> DataFrame:
    """Folds plus fold-rate psx; written out because the cut searches re-read it."""
    psx = L.fold_rate_psx(L.stratified_folds(df, k, seed, write=True), cat, num_classes)
    return cut_lineage(psx) if checkpoint else psx


def lineitem_psx(spark: SparkSession, sf_dir: str, checkpoint: bool = True) -> DataFrame:
    return with_psx(noisy_lineitem(spark, sf_dir), "c_3", 2, 5, 0, checkpoint)


@dataclass
class LabelErrors:
    thresholds: list
    joint: DataFrame
    marked: DataFrame
    ordered: DataFrame


def label_errors(psx_df: DataFrame, num_classes: int = 2, method: str = "both",
                 budget: str = "reference", order: str = "normalized_margin") -> LabelErrors:
    thr = L.per_class_thresholds(psx_df, num_classes)
    cj = L.confident_joint(psx_df, thr)
    marked = P.find_label_errors(psx_df, cj=cj, num_classes=num_classes, method=method,
                                 budget=budget)
    return LabelErrors(thr, cj, marked, P.order_label_errors(marked, order))


def p_columns(df: DataFrame, num_classes: int = 2, psx: str = "psx") -> list:
    return [F.round(F.element_at(F.col(psx), k + 1), 6).alias(f"p{k}") for k in range(num_classes)]
