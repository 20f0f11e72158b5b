"""Boosting whose rounds are aggregations (M7, M11): an additive model over categories.

Round r fits the residuals by one category column (the columns take turns): each of its
values moves the prediction by ``stepSize * sum(residual) / (rows + smoothing)``.  The
prediction depends on the categories alone, so that the rows are first put together to
cells (one per combination of categories: rows, sum of the label, sum of its square), and a
round is one aggregation of cells by one column and one join.  The loss on validation rows
(root mean square) is known after each round; fitting stops when ``patience`` rounds brought
no better one, and the rounds up to the best are kept.

A fitted model is one table (round, column, value, delta).  Scoring adds the deltas up per
column and value first, over the first ``treeLimit`` rounds if that is set, and joins one
small table per column.  Unseen values add nothing.  Labels are numbers; for 0 / 1 labels
the prediction, cut to [0, 1], is also given as a probability vector.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .persist import StageReader, StageWriter

ROUNDS = 100
STEP = 0.3
SMOOTHING = 10.0
PATIENCE = 30   # the reference's early stopping


class _StagedParams(HasLabelCol, HasPredictionCol, HasProbabilityCol, HasMaxIter, HasStepSize):
    catCols = Param(Params._dummy(), "catCols", "category columns, in the order of their turns", typeConverter=TypeConverters.toListString)
    smoothing = Param(Params._dummy(), "smoothing", "rows added to each value's count", typeConverter=TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "rounds without a better validation loss", typeConverter=TypeConverters.toInt)
    validationCol = Param(Params._dummy(), "validationCol", "boolean column of validation rows", typeConverter=TypeConverters.toString)
    treeLimit = Param(Params._dummy(), "treeLimit", "rounds used in scoring, 0 for all", typeConverter=TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(maxIter=ROUNDS, stepSize=STEP, smoothing=SMOOTHING, patience=PATIENCE, treeLimit=0)

    def setProbabilityCol(self, value: str):
        return self._set(probabilityCol=value)

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)

    def setTreeLimit(self, value: int):
        return self._set(treeLimit=value)


class StagedBooster(Estimator, _StagedParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, catCols=None, maxIter=ROUNDS, stepSize=STEP, smoothing=SMOOTHING, patience=PATIENCE,
                 validationCol=None, labelCol="label"):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def input_columns(self) -> list:
        valid = [self.getOrDefault("validationCol")] if self.isDefined("validationCol") else []
        return [*self.getOrDefault("catCols"), self.getLabelCol(), *valid]

    def _cells(self, dataset: DataFrame) -> DataFrame:
        """One row per combination of categories and validation flag, with prediction 0."""
        y = F.col(self.getLabelCol()).cast("double")
        valid = F.col(self.getOrDefault("validationCol")) if self.isDefined("validationCol") else F.lit(False)
        return cut_lineage(dataset.select(
            *(F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(self.getOrDefault("catCols"))),
            valid.alias("_valid"), y.alias("_y")).where("_y is not null").groupBy(
            *(f"_c{i}" for i in range(len(self.getOrDefault("catCols")))), "_valid").agg(
            F.count("*").alias("_n"), F.sum("_y").alias("_s"), F.sum(F.col("_y") * F.col("_y")).alias("_q")))

    def _fit(self, dataset: DataFrame) -> "StagedModel":
        cells, columns = self._cells(dataset), len(self.getOrDefault("catCols"))
        train = ~F.col("_valid")
        base = cells.where(train).agg(F.sum("_s") / F.sum("_n")).first()[0]
        if base is None:
            raise ValueError("no labelled row to learn from")
        cells = cells.withColumn("_f", F.lit(float(base))).withColumn("_delta", F.lit(None).cast("double"))
        tables, best, best_loss = [], 0, math.inf
        for r in range(1, self.getMaxIter() + 1):
            i = (r - 1) % columns
            move = F.sum(F.col("_s") - F.col("_n") * F.col("_f")) / (F.sum("_n") + F.lit(self.getOrDefault("smoothing")))
            moves = cells.where(train).groupBy(F.col(f"_c{i}").alias("value")).agg(
                (F.lit(self.getStepSize()) * move).alias("_delta"))
            # one table a round: the cells with their move, from which the moves of a kept round are read
            cells = cut_lineage(cells.drop("_delta").join(moves, cells[f"_c{i}"].eqNullSafe(moves["value"]), "left").withColumn(
                "_f", F.col("_f") + F.coalesce("_delta", F.lit(0.0))).drop("value"))
            tables.append(cells.where("_delta is not null").groupBy(F.col(f"_c{i}").alias("value")).agg(
                F.first("_delta").alias("delta")).select(F.lit(r).alias("round"), F.lit(i).alias("column"), "value", "delta"))
            loss = self._loss(cells) if self.isDefined("validationCol") else None
            if loss is None:        # no validation rows: all rounds
                best = r
            elif loss < best_loss:
                best, best_loss = r, loss
            elif r - best >= self.getOrDefault("patience"):
                break
        kept = tables[0] if tables else cells.sparkSession.createDataFrame([], "round int, column int, value string, delta double")
        for t in tables[1:best]:
            kept = kept.unionByName(t)
        model = StagedModel(cut_lineage(kept), float(base), best, best_loss if best_loss < math.inf else None)
        return self._copyValues(model)

    @staticmethod
    def _loss(cells: DataFrame) -> float | None:
        f = F.col("_f")
        return cells.where("_valid").agg(F.sqrt(F.sum(
            F.col("_q") - 2 * f * F.col("_s") + f * f * F.col("_n")) / F.sum("_n"))).first()[0]


class StagedModel(Model, _StagedParams, MLReadable, MLWritable):
    """``deltas`` (round, column, value, delta), the mean label ``base``, the number of rounds kept
    and the validation loss of the last of them."""

    def __init__(self, deltas: DataFrame, base: float, rounds: int, loss: float | None = None):
        super().__init__()
        self._defaults()
        self.deltas, self.base, self.numRounds, self.loss = deltas, base, rounds, loss

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limit = self.getOrDefault("treeLimit") or self.numRounds
        used = self.deltas.where(F.col("round") <= limit).groupBy("column", "value").agg(F.sum("delta").alias("delta"))
        out, total = dataset, F.lit(self.base)
        for i, c in enumerate(self.getOrDefault("catCols")):
            mine = used.where(F.col("column") == i).select(F.col("value").alias("_value"), F.col("delta").alias(f"_d{i}"))
            out = out.join(mine, out[c].cast("string").eqNullSafe(mine["_value"]), "left").drop("_value")
            total = total + F.coalesce(f"_d{i}", F.lit(0.0))
        p = F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))
        return out.withColumn(self.getPredictionCol(), total).withColumn(
            self.getProbabilityCol(), array_to_vector(F.array(F.lit(1.0) - p, p))).drop(
            *(f"_d{i}" for i in range(len(self.getOrDefault("catCols")))))

    def write(self) -> MLWriter:
        found = dict(base=self.base, rounds=self.numRounds, loss=self.loss)
        return StageWriter(self, found, lambda path: self.deltas.write.parquet(f"{path}/deltas"))

    @classmethod
    def read(cls) -> MLReader:
        return StageReader(lambda path, metadata, session: cls(
            session.read.parquet(f"{path}/deltas"), metadata["base"], metadata["rounds"], metadata["loss"]))
