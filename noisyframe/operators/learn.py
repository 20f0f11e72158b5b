"""Learning operators on pyspark.ml.

Models are any probabilistic ``pyspark.ml`` classifier; the default is
``GBTClassifier``.  Out-of-fold fits run as independent Spark jobs from a
small driver thread pool, so the folds train concurrently on the cluster.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import ids_repeat, localize
from ..session import Scratch, cut_lineage, stage_path
from ..sources.tables import Roles
from . import labels as L
from . import latent as LT
from . import pruning as P
from . import sampling as SM
from .boost import BlockGBTClassifier, BlockGBTRegressor
from .clean import assert_valid

# Fixed values of the reference's search space (learning rate log-uniform in
# [0.01, 0.07]; max depth one of -1, 2, 3, 4, 5, 6; feature and bagging
# fractions in [0.5, 1.0] by 0.1; min child weight uniform in [0.5, 10]; half of
# the rows held out for validation), mapped to Spark GBT parameters as
# stepSize, maxDepth (-1 -> 6), featureSubsetStrategy, subsamplingRate and
# minInstancesPerNode.  Leaves, bagging frequency and L1/L2 have no GBT twin.
SEARCH_LEARNING_RATE = (0.01, 0.07)
SEARCH_MAX_DEPTH = (-1, 2, 3, 4, 5, 6)
SEARCH_FRACTION = (0.5, 1.0, 0.1)
SEARCH_MIN_CHILD_WEIGHT = (0.5, 10.0)
SEARCH_VALID_FRACTION = 0.5
UNLIMITED_DEPTH = 6
DEFAULT_ROUNDS = 20
# Fixed values of the reference's cleaning pass: five folds of 50 rounds, a search
# space of its own on at most 30,000 rows, and the rate sum that counts as noisy.
CLEAN_FOLDS = 5
CLEAN_ROUNDS = 50
CLEAN_SEARCH_ROWS = 30000
NOISY_RATE = 0.9
# Fixed values of the reference's gain ranking: rows it is fitted on, and the floor.
GAIN_ROWS = 50000
GAIN_FLOOR = 5.0
# Rows of a partition that a tree ensemble keeps its training points of.
FIT_ROWS = 500_000


class Space:
    """Ranges of a search: learning rate (log-uniform), depths, row and feature fractions."""

    def __init__(self, rate: tuple, depths: tuple, fraction: tuple):
        self.rate, self.depths, self.fraction = rate, depths, fraction


SEARCH_SPACE = Space(SEARCH_LEARNING_RATE, SEARCH_MAX_DEPTH, SEARCH_FRACTION)
CLEAN_SPACE = Space((0.001, 0.07), (4, 5, 6, 7), (0.5, 0.99, 0.01))


def feature_columns(df: DataFrame, roles: Roles | None = None) -> list:
    """Numeric model inputs: numbers, integer-coded categories, generated features."""
    roles = roles or Roles.infer(df)
    types = dict(df.dtypes)
    ok = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [c for c in df.columns if (c.startswith("n_") or c.startswith("c_")) and types[c] in ok]


def assembler(cols: list) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def gbt(max_iter: int = DEFAULT_ROUNDS, max_depth: int = 5, step: float = 0.1,
        subsample: float = 1.0, seed: int = 0, feature_subset: str = "all",
        min_instances: int = 1, validation_col: str | None = None) -> GBTClassifier:
    est = BlockGBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter,
                             maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                             featureSubsetStrategy=feature_subset, seed=seed, maxBins=64,
                             minInstancesPerNode=min_instances)
    if validation_col:
        est = est.setValidationIndicatorCol(validation_col)
    return est


def searched_gbt(params: dict | None, rounds: int, seed: int, depth: int = 5,
                 validation_col: str | None = None) -> GBTClassifier:
    """The classifier of a search result; ``depth`` where nothing was searched."""
    p = params or {}
    return gbt(rounds, p.get("max_depth", depth), p.get("step", 0.1), p.get("subsample", 1.0), seed,
               p.get("feature_subset", "all"), p.get("min_instances", 1), validation_col)


def read_columns(df: DataFrame, features: list, estimators: list) -> list:
    """The columns of df that fits of the estimators read: id, label, features, and those an
    estimator names by ``input_columns()``; all columns where one of another kind doesn't say."""
    wanted = {"row_id", "label", *features}
    for est in estimators:
        if hasattr(est, "input_columns"):
            wanted |= set(est.input_columns())
        elif not isinstance(est, (GBTClassifier, GBTRegressor)):
            return df.columns
    return [c for c in df.columns if c in wanted]


def spread(train: DataFrame, est) -> DataFrame:
    """Training rows of a tree ensemble, which keeps the points of each partition whole: one
    partition per ``FIT_ROWS`` rows where that is more than the cores.  An estimator that names
    its columns fits by aggregation and takes them as they are."""
    if hasattr(est, "input_columns"):
        return train
    parts = train.count() // FIT_ROWS
    return train.repartition(parts, "row_id") if parts > train.sparkSession.sparkContext.defaultParallelism else train


def fit_rows(train: DataFrame, est) -> DataFrame:
    """The rows as a fit takes them: one over blocks needs no spreading."""
    return train if isinstance(est, (BlockGBTClassifier, BlockGBTRegressor)) else spread(train, est)


def without_errors(marked: DataFrame, repeat: bool) -> DataFrame:
    """The rows of which no copy is marked: a filter, or where ids ``repeat`` an anti join on the
    id.  A row without an id stays."""
    if repeat:
        return marked.join(marked.where("is_error").select("row_id"), "row_id", "left_anti")
    return marked.where(~F.coalesce("is_error", F.lit(False)) | F.col("row_id").isNull())


def prob1(col: str = "probability") -> Column:
    return F.element_at(vector_to_array(F.col(col)), 2)


# ------------------------------------------------------------------ L1

def oof_probabilities(df: DataFrame, features: list, estimator_factory=None, k: int = 5,
                      seed: int = 0, threads: int = 4, num_classes: int = 2) -> DataFrame:
    """L1: each of k models is fit on the other folds and scores its own fold;
    the union is ``psx ARRAY<DOUBLE>`` per row.  Fold jobs run concurrently.

    An estimator with a method ``out_of_fold(df)`` does all of that by itself from the
    column ``fold``: one whose fit is a sum needs no fit per fold."""
    est = estimator_factory or (lambda: gbt(seed=seed))
    folded = L.stratified_folds(df, k, seed, write=True)
    whole = getattr(est(), "out_of_fold", None)
    if whole is not None:
        return whole(folded)
    pipe = lambda: Pipeline(stages=[assembler(features), est()])

    def one(f):
        model = pipe().fit(fit_rows(folded.where(F.col("fold") != f), est()))
        return model.transform(folded.where(F.col("fold") == f))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        parts = list(pool.map(one, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    arr = vector_to_array(F.col("probability"))
    return out.withColumn("psx", F.slice(arr, 1, num_classes)).drop(
        "features", "rawPrediction", "probability", "prediction")


def oof_counted(df: DataFrame, features: list, estimator_factory=None, k: int = 5, seed: int = 0,
                num_classes: int = 2) -> tuple[DataFrame, DataFrame | None]:
    """``oof_probabilities`` and, of an estimator that gives them by itself, their rows counted per
    (label, psx): these are few, and the rows need no copy.  Others are written out, without counts."""
    if estimator_factory is not None and hasattr(estimator_factory(), "out_of_fold"):
        psx = oof_probabilities(df, features, estimator_factory, k, seed, num_classes=num_classes)
        return psx, L.psx_counts(psx)
    with Scratch() as s:
        psx = cut_lineage(oof_probabilities(df, features, estimator_factory, k, seed, num_classes=num_classes))
        s.keep(psx)
    return psx, None


# ------------------------------------------------------------------ M2

def random_params(n_trials: int, seed: int, space: Space = SEARCH_SPACE) -> list:
    """Seeded draws from the search space (random search replaces the reference's
    tree-structured Parzen search)."""
    rnd = random.Random(seed)
    lo, hi = space.rate
    flo, fhi, fstep = space.fraction

    def frac():
        return round(round(rnd.uniform(flo, fhi) / fstep) * fstep, 2)

    out = []
    for _ in range(n_trials):
        depth = rnd.choice(space.depths)
        ff = frac()
        out.append(dict(step=math.exp(rnd.uniform(math.log(lo), math.log(hi))),
                        max_depth=UNLIMITED_DEPTH if depth == -1 else depth,
                        feature_subset="all" if ff >= 1.0 else str(ff),
                        subsample=frac(),
                        min_instances=max(1, int(round(rnd.uniform(*SEARCH_MIN_CHILD_WEIGHT))))))
    return out


def auc(scored: DataFrame, score: Column | None = None, label: str = "label") -> float:
    """Area under ROC, exact (no binning)."""
    s = scored.select((score if score is not None else prob1()).alias("_s"),
                      F.col(label).cast("double").alias("_y"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="_s", labelCol="_y",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(s))


def random_search(df: DataFrame, features: list, n_trials: int = 2, seed: int = 0,
                  rounds: int = DEFAULT_ROUNDS, valid_frac: float = SEARCH_VALID_FRACTION,
                  threads: int = 2, space: Space = SEARCH_SPACE) -> tuple[dict, float]:
    """M2: seeded random draws scored by validation AUC on an exact hash split;
    each fit stops early on the validation rows (``validationIndicatorCol``);
    trials run as concurrent Spark jobs."""
    trials = random_params(n_trials, seed, space)
    with Scratch():
        scores = _trial_scores(df, features, trials, seed, rounds, valid_frac, threads)
    best = max(range(len(trials)), key=lambda i: (scores[i], -i))
    return trials[best], scores[best]


def _trial_scores(df: DataFrame, features: list, trials: list, seed: int, rounds: int, valid_frac: float, threads: int) -> list:
    names = read_columns(df, features, [gbt()])
    split = SM.holdout_split(df.select(*[F.col(f"`{c}`") for c in names]), valid_frac, seed).withColumn(
        "_valid", F.col("split") == "test")
    split = cut_lineage(split)
    valid = split.where("_valid")

    def score(p):
        est = gbt(rounds, p["max_depth"], p["step"], p["subsample"], seed, p["feature_subset"],
                  p["min_instances"], validation_col="_valid")
        m = Pipeline(stages=[assembler(features), est]).fit(fit_rows(split, est))
        return auc(m.transform(valid))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(score, trials))


# ------------------------------------------------------------------ L19, L20

@dataclass
class CleanResult:
    kept: DataFrame
    errors: DataFrame
    rou_0: float
    rou_1: float
    passes: int


@dataclass
class NoisePass:
    """Out-of-fold probabilities of all rows, their calibrated joint and the two noise rates."""

    psx: DataFrame
    joint: DataFrame
    rates: tuple[float, float]
    counts: DataFrame | None = None


def converged_rates(cj: DataFrame, df: DataFrame, weight: str | None = None) -> tuple[float, float]:
    """P(s=1|y=0) and P(s=0|y=1) from the joint, after L11 made prior and matrices agree."""
    py, nm, inv = LT.estimate_latent(cj, df, 2, weight=weight)
    prior = {r["k"]: r["py"] for r in py.collect()}
    share = {r["k"]: r["ps"] for r in LT.class_shares(df, 2, weight=weight).collect()}
    if min(share.values()) <= 0:
        return 0.0, 0.0
    _, out, _ = LT.converge_latent([share[0], share[1]], [prior[0], prior[1]], LT._mat(nm, 2), LT._mat(inv, 2))
    return out[1][0], out[0][1]


def clean_labels(df: DataFrame, features: list, rounds: int = 0, early_stop: bool = False,
                 seed: int = 0, k: int = CLEAN_FOLDS, max_iter: int = CLEAN_ROUNDS, method: str = "both",
                 estimator_factory=None, search_trials: int = 0, first: NoisePass | None = None,
                 repeat: bool | None = None) -> CleanResult:
    """``rounds + 1`` passes of OOF psx -> confident joint -> pruning; each pass's rows
    are written out with their folds or probabilities, and its errors are left out of these rows.
    The passes carry the columns that the classifier reads.  ``repeat`` says whether ids may
    repeat, where that is known.  The (converged) noise rates come from
    pass 1, which may be given as ``first``.  With ``early_stop``, stop before pruning when rou_0 + rou_1 <= 0.9.
    ``search_trials`` > 0 chooses the classifier's parameters by M2 in the cleaning
    space, on at most ``CLEAN_SEARCH_ROWS`` labelled rows."""
    params: dict = {}
    if search_trials and estimator_factory is None:
        rows = SM.take_smallest(df, CLEAN_SEARCH_ROWS, seed, purpose="search")
        params, _ = random_search(rows, features, search_trials, seed, max_iter, space=CLEAN_SPACE)
    names = read_columns(df, features, [(estimator_factory or gbt)()])
    cur = df.select(*[F.col(f"`{c}`") for c in names])
    all_err = None
    rou = None
    passes = 0
    for r in range(rounds + 1):
        est = estimator_factory or (lambda: searched_gbt(params, max_iter, seed + r, 4))  # noqa: B023
        if r or first is None:
            psx, counts = oof_counted(cur, features, est, k, seed + r)
            cj = _joint(psx, counts)
        else:
            psx, counts, cj, rou = first.psx, first.counts, first.joint, first.rates
        passes += 1
        if r == 0:
            rou = rou or _rates(cj, psx, counts)
            if early_stop and sum(rou) <= NOISY_RATE:
                break
        marked = P.find_label_errors(psx, cj=cj, num_classes=2, method=method, counts=counts)
        repeat = ids_repeat(cur) if repeat is None else repeat
        err = marked.where("is_error").select("row_id")
        all_err = err if all_err is None else all_err.unionByName(err)
        cur = without_errors(marked, repeat).select(*[F.col(f"`{c}`") for c in names])
        cur = cur if counts is None else cut_lineage(cur)       # else the written rows are filtered
    errors = all_err if all_err is not None else df.select("row_id").limit(0)
    kept = cur if names == df.columns else df.join(errors, "row_id", "left_anti")
    return CleanResult(kept, errors, float(rou[0]), float(rou[1]), passes)


def _joint(psx: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The calibrated confident joint of valid probabilities, read from their counts where there are."""
    rows, weight = (psx, None) if counts is None else (counts, L.ROWS)
    assert_valid(rows, 2, weight=weight)
    return L.confident_joint(rows, L.per_class_thresholds(rows, 2, weight=weight), weight=weight)


def _rates(cj: DataFrame, psx: DataFrame, counts: DataFrame | None) -> tuple[float, float]:
    return converged_rates(cj, psx) if counts is None else converged_rates(cj, counts, L.ROWS)


def estimate_noise(df: DataFrame, features: list, estimator_factory=None, k: int = CLEAN_FOLDS, seed: int = 0,
                   max_iter: int = CLEAN_ROUNDS) -> NoisePass:
    """One out-of-fold pass without pruning: the first pass of ``clean_labels`` under the same seed
    where nothing is searched."""
    est = estimator_factory or (lambda: gbt(max_iter, 4, seed=seed))
    psx, counts = oof_counted(df, features, est, k, seed)
    joint = _joint(psx, counts)
    return NoisePass(psx, joint, _rates(joint, psx, counts), counts)


class NoisyLabelModel:
    """Estimate label noise with out-of-fold probabilities, prune the likely
    errors, train the classifier on the kept rows (D2: it really trains)."""

    def __init__(self, features: list, estimator_factory=None, k: int = CLEAN_FOLDS, seed: int = 0,
                 method: str = "both", pulearning: int | None = None):
        self.features = features
        self.est = estimator_factory or (lambda: gbt(max_iter=CLEAN_ROUNDS, max_depth=4, seed=seed))
        self.k, self.seed, self.method, self.pulearning = k, seed, method, pulearning
        self.model = None
        self.mask = None

    def fit(self, df: DataFrame, psx: DataFrame | None = None, joint: DataFrame | None = None) -> "NoisyLabelModel":
        """``psx`` (row_id, label, psx) and ``joint`` (the calibrated one) may be given."""
        if not isinstance(self.est(), (BlockGBTClassifier, BlockGBTRegressor)):     # its model may read what it wrote
            self._fit(df, psx, joint)
            return self
        with Scratch() as s:
            self._fit(df, psx, joint)
            s.keep(self.mask)
        return self

    def _fit(self, df: DataFrame, psx: DataFrame | None, joint: DataFrame | None) -> None:
        own, counts = psx is None, None
        if own:
            names = read_columns(df, self.features, [self.est()])
            df = df.select(*[F.col(f"`{c}`") for c in names])
            psx, counts = oof_counted(df, self.features, self.est, self.k, self.seed)
        assert_valid(*((psx, 2) if counts is None else (counts, 2, "psx", L.ROWS)))
        marked = P.find_label_errors(psx, cj=joint, num_classes=2, method=self.method, counts=counts)
        if self.pulearning is not None:  # the perfectly labelled class is never pruned (D18)
            marked = marked.withColumn("is_error", F.col("is_error") & (F.col("label") != self.pulearning))
        self.mask = marked.select("row_id", "is_error")
        kept = without_errors(marked, ids_repeat(df)).select(*[F.col(f"`{c}`") for c in names]) if own else df.join(
            self.mask.where("is_error"), "row_id", "left_anti")
        est = self.est()
        self.model = Pipeline(stages=[assembler(self.features), est]).fit(fit_rows(kept, est))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def score(self, df: DataFrame, weight: str | None = None) -> float:
        out = self.transform(df)
        return float(accuracy(out, F.col("prediction"), weight=weight).first()[0])


# ------------------------------------------------------------------ A11-A13

def accuracy(df: DataFrame, pred: Column, label: str = "label", weight: str | None = None) -> DataFrame:
    """(weighted) share of rows whose prediction equals the label."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    hit = F.when(pred.cast("int") == F.col(label).cast("int"), 1.0).otherwise(0.0)
    return df.agg((F.sum(w * hit) / F.sum(w)).alias("accuracy"))


def precision_at_k(df: DataFrame, k: int, num_classes: int, label: str = "label",
                   psx: str = "psx") -> DataFrame:
    """Share of rows whose label is among the k most probable classes (ties
    ranked by class index).  The label's rank is counted without sorting."""
    own = F.element_at(F.col(psx), F.col(label).cast("int") + 1)
    ahead = None
    for j in range(num_classes):
        pj = F.element_at(F.col(psx), j + 1)
        t = F.when((pj > own) | ((pj == own) & (F.lit(j) < F.col(label))), 1).otherwise(0)
        ahead = t if ahead is None else ahead + t
    return df.agg(F.avg(F.when(ahead < k, 1.0).otherwise(0.0)).alias("precision_at_k"))


def ensemble_mean(models: list, df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Mean of the models' positive-class scores, in one plan.

    Every model writes to output columns of its own, one after the other over the
    same rows: the features are computed once and no rows are joined by their id.
    """
    out = models[0].stages[0].transform(df)
    names = []
    for i, m in enumerate(models):
        last = m.stages[-1].copy()
        names.append(f"_p{i}")
        last.setProbabilityCol(names[-1])
        last.setPredictionCol(f"_y{i}")
        if hasattr(last, "setRawPredictionCol"):
            last.setRawPredictionCol(f"_r{i}")
        out = last.transform(out)
    total = sum((prob1(n) for n in names), F.lit(0.0))
    return out.select(row_id, (total / F.lit(float(len(models)))).alias("score"))


# ------------------------------------------------------------------ M1 / T2

def feature_gain(df: DataFrame, features: list, max_iter: int = 20, min_gain: float = 0.0,
                 top: int = 500, seed: int = 0, sample_rows: int = GAIN_ROWS) -> DataFrame:
    """M1 + T2: gain of each feature from a GBT fit on a class-balanced sample of
    labelled rows without time columns; features of at least ``min_gain``, at most
    ``top``.  The gain is the impurity that a feature's splits took off, times the
    rows that they split, summed over all trees (read from the saved nodes)."""
    sample = cut_lineage(SM.class_balanced(df, sample_rows, seed).drop("copy"))
    model = Pipeline(stages=[assembler(features), gbt(max_iter, 6, 0.1, 1.0, seed)]).fit(sample)
    spark = df.sparkSession
    path = stage_path(spark)
    model.stages[-1].write().save(path)
    node = spark.read.parquet(f"{path}/data").where("nodeData.gain > 0").select("nodeData.*")
    gains = node.groupBy(F.col("split.featureIndex").alias("i")).agg(F.sum(F.col("gain") * F.col("rawCount")).alias("g"))
    names = spark.createDataFrame(list(enumerate(features)), "i int, feature string")
    table = names.join(gains, "i", "left").select("feature", F.coalesce("g", F.lit(0.0)).alias("gain"))
    return localize(table.where(F.col("gain") >= min_gain).orderBy(F.col("gain").desc(), "feature").limit(top))
