"""A probabilistic classifier whose fit is one aggregation.

``RateClassifier`` learns, for each value of one category column, the smoothed
share of every class, ``(n_k + 1) / (n + K)``.  It is a ``pyspark.ml`` estimator
like any other: it plugs into the out-of-fold, cleaning and ensemble operators,
costs one shuffle to fit and one join to apply, and its results can be stated in
SQL.  A value unseen in the fit gets 1 / K for every class, and so does a null
that was unseen.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .labels import fold_rate_psx
from .persist import StageReader, StageWriter


class _RateParams(HasLabelCol, HasProbabilityCol, HasPredictionCol):
    catCol = Param(Params._dummy(), "catCol", "category column", typeConverter=TypeConverters.toString)
    numClasses = Param(Params._dummy(), "numClasses", "number of classes", typeConverter=TypeConverters.toInt)

    def setProbabilityCol(self, value: str):
        return self._set(probabilityCol=value)

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)


class RateClassifier(Estimator, _RateParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, catCol: str | None = None, numClasses: int = 2, labelCol: str = "label"):
        super().__init__()
        self._setDefault(numClasses=2)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "RateModel":
        cat, label = self.getOrDefault(self.catCol), F.col(self.getLabelCol())
        counts = dataset.groupBy(F.col(cat).alias("value")).agg(
            F.array(*[F.count_if(label == k) for k in range(self.getOrDefault(self.numClasses))]).alias("n"))
        return self._copyValues(RateModel(cut_lineage(counts)))

    def input_columns(self) -> list:
        return [self.getOrDefault(self.catCol), self.getLabelCol()]

    def out_of_fold(self, folded: DataFrame) -> DataFrame:
        """``psx`` of every row by the other folds' counts: all counts less those of the row's fold."""
        return fold_rate_psx(folded, self.getOrDefault(self.catCol), self.getOrDefault(self.numClasses), self.getLabelCol())


class RateModel(Model, _RateParams, MLReadable, MLWritable):
    def __init__(self, counts: DataFrame):
        super().__init__()
        self._setDefault(numClasses=2)
        self.counts = counts

    def write(self) -> MLWriter:
        return StageWriter(self, {}, lambda path: self.counts.write.parquet(f"{path}/counts"))

    @classmethod
    def read(cls) -> MLReader:
        return StageReader(lambda path, metadata, session: cls(session.read.parquet(f"{path}/counts")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cat, size = self.getOrDefault(self.catCol), self.getOrDefault(self.numClasses)
        rates = self.counts.select(F.col("value").alias("_value"), F.col("n").alias("_n"))
        joined = dataset.join(rates, dataset[cat].eqNullSafe(rates["_value"]), "left")
        n = F.coalesce(F.col("_n"), F.array(*[F.lit(0).cast("bigint")] * size))
        total = sum((F.get(n, F.lit(k)) for k in range(size)), F.lit(0))
        p = F.array(*[((F.get(n, F.lit(k)) + 1) / (total + size)).cast("double") for k in range(size)])
        first = (F.array_position(p, F.array_max(p)) - 1).cast("double")
        return joined.withColumn(self.getProbabilityCol(), array_to_vector(p)).withColumn(
            self.getPredictionCol(), first).drop("_value", "_n")
