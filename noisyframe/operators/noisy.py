"""Learning with noisy labels as a ``pyspark.ml`` estimator.

``NoisyLabelClassifier`` wraps any probabilistic estimator: out-of-fold probabilities,
noise estimation, pruning of likely label errors, and a fit on the rows kept.  The noise
may be given instead, as P(s|y) (``noiseMatrix``) or P(y|s) (``inverseNoiseMatrix``): the
prune budgets then come from the matrix and the class counts, without a confident joint
from the rows.  Matrices are K x K cells on the driver; rows stay in Spark.

Matrices are lists of rows by observed label: ``matrix[s][y]``.  A noise matrix has columns
that sum to 1, an inverse one rows that do; the trace of a given one must exceed 1 (a
matrix whose trace doesn't can't be told from one with its classes swapped).
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import labels as L
from . import latent as LT
from . import pruning as P
from .clean import assert_valid
from .learn import CLEAN_FOLDS, accuracy, assembler, oof_counted, read_columns
from .persist import StageReader, StageWriter

MASKS = ("protect", "reference")


# ------------------------------------------------------------------ matrices of K x K cells

def assert_noise_matrix(matrix: list, inverse: bool = False) -> None:
    """P10: cells in [0, 1], columns (of an inverse matrix rows) that sum to 1, and a trace above 1."""
    m = np.asarray(matrix, float)
    name = "inverse noise matrix" if inverse else "noise matrix"
    if m.ndim != 2 or m.shape[0] != m.shape[1]:
        raise ValueError(f"the {name} is not square")
    if (m < 0).any() or (m > 1).any():
        raise ValueError(f"the {name} has cells outside [0, 1]")
    if not np.allclose(m.sum(axis=1 if inverse else 0), 1, atol=1e-6):
        raise ValueError(f"the {'rows' if inverse else 'columns'} of the {name} do not sum to 1")
    if np.trace(m) <= 1:
        raise ValueError(f"the trace of the {name} is {np.trace(m):.2f}, it must exceed 1")


def prior_of(noise: list, shares: list) -> np.ndarray:
    """P(y) such that P(s|y) P(y) gives the observed shares, clipped to (0, 1] and summing to 1."""
    try:
        py = np.linalg.solve(np.asarray(noise, float), np.asarray(shares, float))
    except np.linalg.LinAlgError as e:
        raise ValueError("the noise matrix is singular: no prior follows from it") from e
    py = np.clip(py, LT.PRIOR_MIN, 1.0)
    return py / py.sum()


def inverse_of(noise: list, shares: list) -> np.ndarray:
    """P(y|s) from P(s|y) and the observed shares, noise rates clipped, rows summing to 1."""
    joint = np.asarray(noise, float) * prior_of(noise, shares)[None, :]
    return np.array(LT._clip_cols((joint / np.maximum(joint.sum(axis=1), 1e-300)[:, None]).tolist(), True))


def noise_of(inverse: list, shares: list) -> np.ndarray:
    """P(s|y) from P(y|s) and the observed shares, noise rates clipped, columns summing to 1."""
    joint = np.asarray(inverse, float) * np.asarray(shares, float)[:, None]
    return np.array(LT._clip_cols((joint / np.maximum(joint.sum(axis=0), 1e-300)[None, :]).tolist(), False))


def joint_from_matrix(df: DataFrame, num_classes: int, noise: list | None = None, inverse: list | None = None,
                      label: str = "label", weight: str | None = None) -> DataFrame:
    """The calibrated joint (k_s, k_y, v) that a given matrix implies for the labels of df.

    An inverse matrix says how each class's rows divide; a noise matrix does so by its
    inverse.  Where both are given, the inverse one counts.  Rows are rounded by W6.
    """
    counts = L.class_count_frame(df, num_classes, label, weight)
    n = {r["k_s"]: r["n"] for r in counts.collect()}        # K rows
    shares = [n[k] / max(1, sum(n.values())) for k in range(num_classes)]
    inv = np.asarray(inverse, float) if inverse is not None else inverse_of(noise, shares)
    cells = [(a, b, float(inv[a][b] * n[a])) for a in range(num_classes) for b in range(num_classes)]
    return L.calibrate_joint(df.sparkSession.createDataFrame(cells, "k_s int, k_y int, v double"), counts)


def _square(flat: list | None, size: int) -> list | None:
    if flat is None:
        return None
    if len(flat) != size * size:
        raise ValueError(f"a matrix of {size} classes has {size * size} cells, not {len(flat)}")
    return [flat[i * size:(i + 1) * size] for i in range(size)]


# ------------------------------------------------------------------ the estimator

class _NoisyParams(HasLabelCol, HasSeed):
    inputCols = Param(Params._dummy(), "inputCols", "numeric feature columns", typeConverter=TypeConverters.toListString)
    idCol = Param(Params._dummy(), "idCol", "row id column", typeConverter=TypeConverters.toString)
    numClasses = Param(Params._dummy(), "numClasses", "number of classes", typeConverter=TypeConverters.toInt)
    numFolds = Param(Params._dummy(), "numFolds", "folds of the out-of-fold probabilities", typeConverter=TypeConverters.toInt)
    pruneMethod = Param(Params._dummy(), "pruneMethod", "prune_by_class, prune_by_noise_rate or both", typeConverter=TypeConverters.toString)
    budget = Param(Params._dummy(), "budget", "reference (two classes) or own", typeConverter=TypeConverters.toString)
    thresholds = Param(Params._dummy(), "thresholds", "probability per class from which a row counts as confident", typeConverter=TypeConverters.toListFloat)
    noiseMatrix = Param(Params._dummy(), "noiseMatrix", "P(s|y), row by row", typeConverter=TypeConverters.toListFloat)
    inverseNoiseMatrix = Param(Params._dummy(), "inverseNoiseMatrix", "P(y|s), row by row", typeConverter=TypeConverters.toListFloat)
    converge = Param(Params._dummy(), "converge", "make prior and matrices agree (L11)", typeConverter=TypeConverters.toBoolean)
    cleanClass = Param(Params._dummy(), "cleanClass", "class without wrong labels", typeConverter=TypeConverters.toInt)
    puMask = Param(Params._dummy(), "puMask", "protect: rows of the clean class are never pruned; reference: only they can be", typeConverter=TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(labelCol="label", idCol="row_id", numClasses=2, numFolds=CLEAN_FOLDS, pruneMethod="both",
                         budget="reference", converge=False, puMask="protect", seed=0)

    def value(self, name: str):
        param = self.getParam(name)
        return self.getOrDefault(param) if self.isDefined(param) else None


class NoisyLabelClassifier(Estimator, _NoisyParams, MLReadable, MLWritable):
    """L20 as an estimator around ``estimator`` (or a function that makes one for each fit)."""

    @keyword_only
    def __init__(self, *, estimator=None, inputCols=None, idCol="row_id", labelCol="label", numClasses=2,
                 numFolds=CLEAN_FOLDS, pruneMethod="both", budget="reference", thresholds=None, noiseMatrix=None,
                 inverseNoiseMatrix=None, converge=False, cleanClass=None, puMask="protect", seed=0):
        super().__init__()
        self._defaults()
        given = dict(self._input_kwargs)
        self.estimator = given.pop("estimator", None)
        for name in ("noiseMatrix", "inverseNoiseMatrix"):
            if given.get(name) is not None:
                given[name] = np.asarray(given[name], float).ravel().tolist()
        self._set(**{k: v for k, v in given.items() if v is not None})

    def copy(self, extra=None) -> "NoisyLabelClassifier":
        that = super().copy(extra)
        if isinstance(self.estimator, Estimator):
            that.estimator = self.estimator.copy(extra)
        return that

    def _make(self) -> Estimator:
        return self.estimator.copy() if isinstance(self.estimator, Estimator) else self.estimator()

    def matrices(self) -> tuple[list | None, list | None]:
        """The given noise and inverse noise matrix, validated."""
        size = self.value("numClasses")
        noise, inverse = _square(self.value("noiseMatrix"), size), _square(self.value("inverseNoiseMatrix"), size)
        for matrix, is_inverse in ((noise, False), (inverse, True)):
            if matrix is not None:
                assert_noise_matrix(matrix, is_inverse)
        return noise, inverse

    def _read(self, rows: DataFrame) -> list:
        """Columns that the out-of-fold fits read; all where the label has another name for the estimator."""
        return rows.columns if self.value("labelCol") != "label" else read_columns(
            rows, [c for c in self.value("inputCols") if c != self.value("idCol")], [self._make()])

    def find_errors(self, df: DataFrame, psx: DataFrame | None = None) -> tuple[DataFrame, list, list, list]:
        """The mask (row id, label, is_error), P(s|y), P(y|s) and P(y); ``psx`` (row id, label, psx) may be given."""
        noise, inverse = self.matrices()
        if self.value("puMask") not in MASKS:
            raise ValueError(f"puMask is one of {MASKS}")
        size, label, row_id = self.value("numClasses"), self.value("labelCol"), self.value("idCol")
        rows = df.withColumnsRenamed({label: "label", row_id: "row_id"})
        if psx is None:
            rows = rows.select(*[F.col(f"`{c}`") for c in self._read(rows)])
            psx, counts = oof_counted(rows, self.value("inputCols"), self._make, self.value("numFolds"),
                                      self.value("seed"), num_classes=size)
        else:
            psx, counts = psx.withColumnsRenamed({label: "label", row_id: "row_id"}), None
        read, weight = (psx, None) if counts is None else (counts, L.ROWS)
        assert_valid(read, size, weight=weight)
        shares = [r["ps"] for r in LT.class_shares(read, size, weight=weight).orderBy("k").collect()]
        if noise is None and inverse is None:
            joint = L.confident_joint(read, self.value("thresholds") or L.per_class_thresholds(
                read, size, weight=weight), weight=weight)
            py, nm, inv = LT.estimate_latent(joint, read, size, weight=weight)
            prior = [r["py"] for r in py.orderBy("k").collect()]
            noise, inverse = LT._mat(nm, size), LT._mat(inv, size)
            if self.value("converge"):
                prior, noise, inverse = LT.converge_latent(shares, prior, noise, inverse)
        else:
            joint = joint_from_matrix(read, size, noise, inverse, weight=weight)
            inverse = inverse if inverse is not None else inverse_of(noise, shares).tolist()
            noise = noise if noise is not None else noise_of(inverse, shares).tolist()
            prior = (np.asarray(inverse).T @ np.asarray(shares)).tolist()
        marked = P.find_label_errors(psx, cj=joint, num_classes=size, method=self.value("pruneMethod"),
                                     budget=self.value("budget"), counts=counts)
        clean = self.value("cleanClass")
        if clean is not None:
            noise = LT._mat(LT.remove_noise_from_class(_cells(df, noise), clean), size)
            can_be_wrong = F.col("label") != clean if self.value("puMask") == "protect" else F.col("label") == clean
            marked = marked.withColumn("is_error", F.col("is_error") & can_be_wrong)
        return marked.select("row_id", "label", "is_error"), noise, inverse, prior

    def _fit(self, dataset: DataFrame) -> "NoisyLabelClassifierModel":
        return self.fit_with(dataset)

    def fit_with(self, dataset: DataFrame, psx: DataFrame | None = None) -> "NoisyLabelClassifierModel":
        """``fit`` with given out-of-fold probabilities (row id, label, psx)."""
        mask, noise, inverse, prior = self.find_errors(dataset, psx)
        mask = cut_lineage(mask)
        row_id = self.value("idCol")
        kept = dataset.join(mask.where("is_error").select(F.col("row_id").alias(row_id)), row_id, "left_anti")
        inner = Pipeline(stages=[assembler(self.value("inputCols")), self._make()]).fit(kept)
        model = NoisyLabelClassifierModel(inner, noise, inverse, prior, mask)
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return StageWriter(self, {}, lambda path: self._make().write().save(f"{path}/estimator"))

    @classmethod
    def read(cls) -> MLReader:
        def load(path, metadata, session):
            return cls(estimator=DefaultParamsReader.loadParamsInstance(f"{path}/estimator", session))
        return StageReader(load)


class NoisyLabelClassifierModel(Model, _NoisyParams, MLReadable, MLWritable):
    """The classifier fitted on the kept rows, with what was found: ``noise`` P(s|y), ``inverse``
    P(y|s), ``prior`` P(y), and ``mask`` (row_id, label, is_error)."""

    def __init__(self, inner: PipelineModel | None = None, noise: list | None = None, inverse: list | None = None,
                 prior: list | None = None, mask: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.inner, self.noise, self.inverse, self.prior, self.mask = inner, noise, inverse, prior, mask

    def copy(self, extra=None) -> "NoisyLabelClassifierModel":
        that = super().copy(extra)
        that.inner = self.inner.copy(extra)
        return that

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.inner.transform(dataset)

    def score(self, df: DataFrame, weight: str | None = None) -> float:
        """A11 on rows with labels."""
        return float(accuracy(self.transform(df), F.col("prediction"), self.value("labelCol"), weight).first()[0])

    def positive_score(self, df: DataFrame) -> DataFrame:
        p1 = F.element_at(vector_to_array(F.col("probability")), 2)
        return self.transform(df).select(self.value("idCol"), p1.alias("score"))

    def write(self) -> MLWriter:
        found = dict(noise=_plain(self.noise), inverse=_plain(self.inverse), prior=_plain(self.prior))

        def save(path: str) -> None:
            self.inner.write().save(f"{path}/inner")
            self.mask.write.parquet(f"{path}/mask")
        return StageWriter(self, found, save)

    @classmethod
    def read(cls) -> MLReader:
        def load(path, metadata, session):
            return cls(PipelineModel.load(f"{path}/inner"), metadata["noise"], metadata["inverse"], metadata["prior"],
                       session.read.parquet(f"{path}/mask"))
        return StageReader(load)


def _plain(matrix) -> list:
    return np.asarray(matrix, float).tolist()


def _cells(df: DataFrame, matrix: list) -> DataFrame:
    size = len(matrix)
    return df.sparkSession.createDataFrame(
        [(a, b, float(matrix[a][b])) for a in range(size) for b in range(size)], "k_s int, k_y int, v double")
