"""Task pipelines: feature engine, ensembles per task, end-to-end model.

Each ensemble is a driver loop over whole-table Spark jobs: sample (exact,
seeded), optional random search, GBT fit, then the mean of the models' scores.
The loop stops at ``max_models`` or when the remaining time budget is at most
three mean rounds (the reference's budget rule, measured from the call).
"""

from __future__ import annotations

import itertools
import json
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field, fields

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import gain as GN
from ..operators import learn as LN
from ..operators import sampling as SM
from ..operators.boost import BlockGBTRegressor
from ..operators.clean import normalize_labels
from ..session import Scratch, cut_lineage, drop_read
from ..sources.tables import Roles

# Fixed values of the reference's ensemble sizes and caps.
SSL_MODELS = 5
PU_MODELS = 10
NOISY_MODELS = 6
PU_SEARCH_ROWS = 30000
BUDGET_FIT_FACTOR = 3
# Models of aggregations that are fitted at a time, where no time budget rules.
MODEL_THREADS = 3
BUDGET_PREDICT_FACTOR = 2


@dataclass
class Budget:
    max_models: int
    time_budget_s: float | None = None
    start: float = field(default_factory=time.time)
    rounds: list = field(default_factory=list)

    def more(self) -> bool:
        if len(self.rounds) >= self.max_models:
            return False
        if self.time_budget_s is None or not self.rounds:
            return True
        mean = sum(self.rounds) / len(self.rounds)
        return self.time_budget_s - (time.time() - self.start) > BUDGET_FIT_FACTOR * mean

    def tick(self, t0: float) -> None:
        self.rounds.append(time.time() - t0)


def _fit(df: DataFrame, features: list, params: dict | None, rounds: int, seed: int,
         valid_frac: float = 0.2, estimator=None, staged: bool = False) -> PipelineModel:
    """Fit with early stopping on ``valid_frac`` of the rows, whose AUC is kept on the
    model as ``valid_auc``.  ``estimator(params, seed)`` replaces the boosted trees; it
    learns from the rows that are not held out, or (``staged``) reads ``_valid`` itself."""
    if estimator is not None:       # its model may read what it wrote
        return _fitted(df, features, params, rounds, seed, valid_frac, estimator, staged)
    with Scratch():
        return _fitted(df, features, params, rounds, seed, valid_frac, estimator, staged)


def _fitted(df: DataFrame, features: list, params: dict | None, rounds: int, seed: int, valid_frac: float, estimator,
            staged: bool) -> PipelineModel:
    split = cut_lineage(SM.holdout_split(df, valid_frac, seed).withColumn("_valid", F.col("split") == "test")
                        .drop("split"))
    if estimator is None:
        est, train = LN.searched_gbt(params, rounds, seed, validation_col="_valid"), split
    else:
        est, train = estimator(params, seed), split if staged else split.where(~F.col("_valid"))
    model = Pipeline(stages=[LN.assembler(features), est]).fit(LN.fit_rows(train, est))
    valid = split.where("_valid")
    classes = valid.select("label").distinct().limit(3).count()
    model.valid_auc = LN.auc(model.transform(valid)) if classes == 2 else None
    return model


def _pruned(df: DataFrame, features: list, *estimators) -> DataFrame:
    """The columns that fits of these estimators read (None: the boosted trees)."""
    return df.select(*[F.col(f"`{c}`") for c in LN.read_columns(df, features, [e or LN.gbt() for e in estimators])])


def _searched(df: DataFrame, features: list, trials: int, seed: int, rounds: int) -> dict | None:
    return LN.random_search(df, features, trials, seed, rounds)[0] if trials else None


def ssl_ensemble(df: DataFrame, features: list, max_models: int = SSL_MODELS, rounds: int = 100,
                 trials: int = 2, seed: int = 0, time_budget_s: float | None = None, estimator=None) -> list:
    """M3: rounds of T7 sample -> M2 search -> 80/20 fit."""
    b, models = Budget(max_models, time_budget_s), []
    while b.more():
        t0, i = time.time(), len(models)
        s = cut_lineage(SM.ssl_sample(df, seed + i))
        models.append(_fit(s, features, _searched(s, features, trials, seed + i, rounds), rounds, seed + i,
                           estimator=estimator))
        b.tick(t0)
    return models


def pu_ensemble(df: DataFrame, features: list, max_models: int = PU_MODELS, rounds: int = 100,
                trials: int = 2, seed: int = 0, time_budget_s: float | None = None, estimator=None) -> list:
    """M4: rounds of T8 sample -> T3 (30,000 rows) search -> fit."""
    b, models = Budget(max_models, time_budget_s), []
    while b.more():
        t0, i = time.time(), len(models)
        s = cut_lineage(SM.pu_sample(df, seed + i))
        params = _searched(SM.take_smallest(s, PU_SEARCH_ROWS, seed + i, purpose="search") if trials else s,
                           features, trials, seed + i, rounds)
        models.append(_fit(s, features, params, rounds, seed + i, estimator=estimator))
        b.tick(t0)
    return models


def noisy_single(df: DataFrame, features: list, rounds: int = 500, trials: int = 2,
                 seed: int = 0, estimator=None, staged: bool = False) -> list:
    """M5: search on a 30,000-row sample, then one model with early stopping."""
    df = _pruned(df, features, estimator and estimator(None, seed))
    params = _searched(SM.take_smallest(df, PU_SEARCH_ROWS, seed, purpose="search") if trials else df,
                       features, trials, seed, rounds)
    return [_fit(df, features, params, rounds, seed, estimator=estimator, staged=staged)]


def noisy_ensemble(df: DataFrame, features: list, max_models: int = NOISY_MODELS, rounds: int = 500,
                   clean_rounds: int = 1, seed: int = 0, time_budget_s: float | None = None,
                   noise_sum: float | None = None, trials: int = 0, estimator=None, folds: int = LN.CLEAN_FOLDS,
                   clean_iter: int = LN.CLEAN_ROUNDS) -> list:
    """M6: each round re-cleans the labels with a new seed (L19), then fits on the kept
    rows.  Noise rates that sum above 0.9 (``noise_sum``, as the feature engine found
    them, or those of the first pass) mean 3 cleaning passes a round and 3 models."""
    b, models = Budget(max_models, time_budget_s), []
    factory = (lambda: estimator(None, seed)) if estimator else None
    passes = clean_rounds
    df = _pruned(df, features, estimator and estimator(None, seed))
    first = None
    if noise_sum is None:
        first = LN.estimate_noise(df, features, factory, folds, seed, clean_iter)
        noise_sum = sum(first.rates)
    if noise_sum > LN.NOISY_RATE:
        b.max_models, passes = min(b.max_models, 3), 2

    def one(i: int) -> PipelineModel:
        res = LN.clean_labels(df, features, rounds=passes, seed=seed + i, k=folds, max_iter=clean_iter,
                              estimator_factory=factory, search_trials=trials,
                              first=None if trials or i else first)     # the estimate was this round's first pass
        return _fit(res.kept, features, _searched(res.kept, features, trials, seed + i, rounds), rounds, seed + i,
                    estimator=estimator)

    while b.more():
        t0, i = time.time(), len(models)
        with Scratch() if estimator is None else nullcontext():
            models.append(one(i))
        b.tick(t0)
    return models


def noisy_regression(df: DataFrame, features: list, max_models: int = NOISY_MODELS, rounds: int = 500,
                     seed: int = 0, keep_share: float = 0.8, trials: int = 0, folds: int = LN.CLEAN_FOLDS,
                     clean_iter: int = LN.CLEAN_ROUNDS, estimator=None, cleaner=None) -> list:
    """M7: regressors on cleaned 75% samples with validation-based early stopping
    (70/30); keep the models in the better 80% by number of rounds.  The models are independent:
    those whose fit is a sum run as concurrent jobs.

    ``estimator(params, seed)`` replaces the boosted trees; it reads the validation rows from
    ``_valid``.  ``cleaner()`` gives the classifier of the cleaning pass."""
    df = _pruned(df, features, estimator and estimator({}, seed), cleaner and cleaner())
    # ids of a sample repeat only if those of df do
    repeat = LN.ids_repeat(df)

    def one(i: int) -> PipelineModel:
        with Scratch() if estimator is None and cleaner is None else nullcontext():
            return fitted_model(i)

    def fitted_model(i: int) -> PipelineModel:
        s = cut_lineage(SM.frac_sample(df, 0.75, seed + i).drop("copy"))
        res = LN.clean_labels(s, features, rounds=0, seed=seed + i, k=folds, max_iter=clean_iter,
                              estimator_factory=cleaner, search_trials=trials, repeat=repeat)
        p = _searched(res.kept, features, trials, seed + i, rounds) or {}
        split = SM.holdout_split(res.kept, 0.3, seed + i).withColumn("_valid", F.col("split") == "test")
        if estimator is None:
            est = BlockGBTRegressor(featuresCol="features", labelCol="label", maxIter=rounds,
                                    maxDepth=p.get("max_depth", 5), stepSize=p.get("step", 0.1),
                                    subsamplingRate=p.get("subsample", 1.0), seed=seed + i,
                                    validationIndicatorCol="_valid", maxBins=64)
        else:
            est = estimator(p, seed + i)
        # an estimator that names its columns reads the rows once
        return Pipeline(stages=[LN.assembler(features), est]).fit(
            split if hasattr(est, "input_columns") else LN.fit_rows(cut_lineage(split), est))

    threads = MODEL_THREADS if estimator is not None and hasattr(estimator({}, seed), "input_columns") else 1
    with ThreadPoolExecutor(max_workers=threads) as pool:
        fitted = list(pool.map(one, range(max_models)))
    sizes = sorted(_rounds_kept(m) for m in fitted)
    cut = sizes[int(round(len(sizes) * (1 - keep_share), 9))] if sizes else 0
    return [m for m in fitted if _rounds_kept(m) >= cut]


def _rounds_kept(model: PipelineModel) -> int:
    last = model.stages[-1]
    return last.numRounds if hasattr(last, "numRounds") else last.getNumTrees


def mean_prediction(models: list, df: DataFrame) -> DataFrame:
    """Mean of regression models, one after the other over the same rows."""
    out, names = models[0].stages[0].transform(df), []
    for i, m in enumerate(models):
        last = m.stages[-1].copy()
        names.append(f"_y{i}")
        last.setPredictionCol(names[-1])
        if hasattr(last, "setProbabilityCol"):
            last.setProbabilityCol(f"_p{i}")
        out = last.transform(out)
    total = sum((F.col(n) for n in names), F.lit(0.0))
    return out.select("row_id", (total / F.lit(float(len(models)))).alias("score"))


def pu_confident(df: DataFrame, features: list, max_models: int = PU_MODELS, seed: int = 0,
                 rounds: int = 500, folds: int = LN.CLEAN_FOLDS, estimator=None, trials: int = 2,
                 staged: bool = False) -> list:
    """M8: a balanced sample of 4x the positives in all (T6); a search and an early-stopped
    90/10 fit, whose number of rounds the cleaning folds and the last fit use; then the
    noisy-label model with the positive class protected (it runs as intended, D3).

    ``estimator(params, seed)`` replaces the boosted trees.  One that is ``staged`` has
    ``maxIter`` and ``validationCol`` of its own, and goes through the early-stopped fit too;
    others have no rounds to choose."""
    models = []
    df = _pruned(df, features, estimator and estimator(None, seed))
    p, _ = SM.class_counts_binary(df)
    for i in range(max_models):
        s = cut_lineage(SM.class_balanced(df, 4 * p, seed + i).drop("copy"))
        if estimator is None:
            params = _searched(s, features, trials, seed + i, min(rounds, LN.CLEAN_ROUNDS))
            kept = max(1, _rounds_kept(_fit(s, features, params, rounds, seed + i, 0.1)))
            factory = lambda: LN.searched_gbt(params, kept, seed + i, 4)  # noqa: B023, E731
        elif staged:
            kept = max(1, _rounds_kept(_fit(s, features, None, rounds, seed + i, 0.1, estimator, True)))
            factory = lambda: _without_validation(estimator(None, seed + i), kept)  # noqa: B023, E731
        else:
            factory = lambda: estimator(None, seed + i)  # noqa: B023, E731
        models.append(LN.NoisyLabelModel(features, factory, folds, seed + i, pulearning=1).fit(s).model)
    return models


def _without_validation(est, rounds: int):
    """The estimator with a fixed number of rounds, on all rows."""
    est = est.copy()
    est.clear(est.validationCol)
    return est._set(maxIter=rounds)


def pu_bagging(df: DataFrame, features: list, max_models: int = PU_MODELS, rounds: int = 100,
               trials: int = 2, seed: int = 0, estimator=None) -> list:
    """M9: class-balanced bags of 4x the positives, search, 90/10 fit."""
    models = []
    p, _ = SM.class_counts_binary(df)
    for i in range(max_models):
        s = cut_lineage(SM.class_balanced(df, 4 * p, seed + i).drop("copy"))
        models.append(_fit(s, features, _searched(s, features, trials, seed + i, rounds), rounds, seed + i, 0.1,
                           estimator))
    return models


def ssl_as_pu(df: DataFrame, features: list, max_models: int = PU_MODELS, rounds: int = 100,
              trials: int = 0, seed: int = 0, estimator=None) -> list:
    """Rounds of T9 (draws with replacement, relabelled 0) plus all positives, 90/10 fit."""
    models = []
    for i in range(max_models):
        s = SM.ssl_pu_sample(df, seed + i)
        rows = cut_lineage(df.drop("label").join(s.select("row_id", "label"), "row_id"))
        models.append(_fit(rows, features, _searched(rows, features, trials, seed + i, rounds), rounds, seed + i,
                           0.1, estimator))
    return models


def predict(models: list, df: DataFrame, time_budget_s: float | None = None, by_auc: bool = False,
            tree_limit: int | None = None) -> DataFrame:
    """M11 + A13: the mean score of all models, in one plan over the rows.

    ``by_auc`` puts the models of the best validation AUC first, which matters under a
    budget: with ``time_budget_s`` each model's scores are written out in turn, until the
    remaining time is at most two mean rounds; the mean is over the models that got their
    turn (one at least).  ``tree_limit``: the first so many rounds of each model only, for
    estimators that can be asked for them.
    """
    if by_auc:
        models = sorted(models, key=lambda m: -(getattr(m, "valid_auc", None) or 0.0))
    if tree_limit is not None:
        models = [_limited(m, tree_limit) for m in models]
    if time_budget_s is None:
        return LN.ensemble_mean(models, df)
    start, total = time.time(), None
    for i, m in enumerate(models):
        own = LN.ensemble_mean([m], df).withColumnRenamed("score", "_own")
        total = own.withColumnRenamed("_own", "_sum") if total is None else total.join(own, "row_id").select(
            "row_id", (F.col("_sum") + F.col("_own")).alias("_sum"))
        total = cut_lineage(total)
        spent = time.time() - start
        if time_budget_s - spent <= BUDGET_PREDICT_FACTOR * spent / (i + 1):
            break
    return total.select("row_id", (F.col("_sum") / F.lit(float(i + 1))).alias("score"))


def _limited(model: PipelineModel, tree_limit: int) -> PipelineModel:
    last = model.stages[-1].copy()
    if not hasattr(last, "setTreeLimit"):
        raise ValueError(f"{type(last).__name__} cannot score by its first rounds")
    return PipelineModel([*model.stages[:-1], last.setTreeLimit(tree_limit)])


# ------------------------------------------------------------------ M13 feature engine

@dataclass
class FeatureEngine:
    """Blocks + shared dictionaries -> (noisy: one early-stopping cleaning
    pass, L19) -> counts -> running counts -> date parts -> selection 1 -> pair
    counts -> means -> time gaps -> selection 2.

    From selection 1 on, everything is gated: a noisy task whose rates sum to at most
    2, or another task with a time column.  Selection (T2/M1) ranks all features, raw
    categories and date parts included, by gain on a class-balanced sample (``gain``: of
    boosted ``trees``, or of class ``histogram``s in a few passes); those of
    at least ``min_gain`` are kept, and in that order the kept categories and numbers
    become ``combine_cats`` / ``combine_nums``, of which the pair counts and means
    take the first ``combine`` each.  The others are dropped after selection 1 for
    ssl/pu and for noisy with rates above 0.9, after selection 2 for ssl/pu only.

    ``refit=True``: counts, running counts, pair counts and means are recomputed on
    the rows transformed.  ``refit=False``: counts, pair counts and means are those of
    the fit (saved lookups), so that one row's features don't depend on its batch.
    Dictionaries, date parts, selected and dropped columns always carry over.
    """

    task: str = "noisy"
    time_col: str | None = "t_1"
    combine_cats: list = field(default_factory=list)
    combine_nums: list = field(default_factory=list)
    encoder: FE.BlockEncoder | None = None
    parts: list = field(default_factory=list)
    cats: list = field(default_factory=list)
    select: bool = True
    clean: bool = True
    rounds: int = 10
    seed: int = 0
    drop1: list = field(default_factory=list)
    drop2: list = field(default_factory=list)
    noise_sum: float = 0.0

    min_gain: float = LN.GAIN_FLOOR
    gain: str = "trees"
    combine: int = 5
    refit: bool = True
    folds: int = LN.CLEAN_FOLDS
    deep: bool = True
    lookups: dict = field(default_factory=dict)     # step name -> DataFrame, for refit=False

    def _kept(self, df: DataFrame, top: int) -> tuple[list, list]:
        """Names of the features at or above the floor, by gain, and of the others."""
        feats = LN.feature_columns(df)
        train = df.select("row_id", "label", *[F.col(f"`{c}`") for c in feats]).na.fill(-1)
        gains = GN.balanced_gain(train, feats, self.min_gain, top, seed=self.seed) if self.gain == "histogram" else (
            LN.feature_gain(train, feats, self.rounds, self.min_gain, top, self.seed))
        kept = [r["feature"] for r in gains.collect()]      # at most `top` names
        return kept, [f for f in feats if f not in set(kept)]

    def fit_transform(self, df: DataFrame) -> DataFrame:
        df = self._raw(df)
        roles = Roles.infer(df)
        self.cats = list(roles.cat)
        has_time = self.time_col is not None and self.time_col in df.columns
        if has_time:
            self.parts = FE.date_parts_fit(df, self.time_col)
        with Scratch() as s:
            base = self._base(df, roles)
            s.keep(base, self.encoder.dictionary)
        self.deep = self.noise_sum <= 2 if self.task == "noisy" else has_time
        out = self._first(base, has_time)
        if self.deep:
            if self.select:
                kept, others = self._kept(out, 10 ** 6)
                self.combine_cats = [f for f in kept if f.startswith("c_")]
                self.combine_nums = [f for f in kept if f.startswith("n_")]
                drops = self.task != "noisy" or self.noise_sum > LN.NOISY_RATE
                self.drop1 = others if drops else []
            out = self._second(out.drop(*self.drop1), has_time)
            if self.select and self.task != "noisy":
                self.drop2 = self._kept(out, 500)[1]
        return out.drop(*self.drop2)

    def _base(self, df: DataFrame, roles: Roles) -> DataFrame:
        """The rows with codes, and in a noisy task without likely label errors."""
        self.encoder, coded = FE.encode_blocks(df, self.cats)
        base = cut_lineage(coded)
        if self.task == "noisy" and self.clean:
            raw = [c for c in LN.feature_columns(base) if c in roles.raw]
            res = LN.clean_labels(base.na.fill(-1, subset=raw), raw, rounds=0, early_stop=True, k=self.folds,
                                  seed=self.seed, max_iter=self.rounds)
            self.noise_sum = res.rou_0 + res.rou_1
            base = cut_lineage(base.join(res.errors, "row_id", "left_anti"))     # each count reads it
        return base

    def _raw(self, df: DataFrame) -> DataFrame:
        """Rows with a non-negative index (P7), raw columns only (P8); time columns but the one used are dropped."""
        return FE.select_raw(FE.nonneg_rows(df), keep=("row_id", "label", self.time_col))

    def _lookup(self, step: str, rows: DataFrame, keys: list, aggs: list) -> tuple[DataFrame, list]:
        """The aggregates per key, of these rows or of those of the fit, and the keys."""
        if self.refit or step not in self.lookups:
            found = rows.where(FE.all_known(keys)).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)
            if self.refit:
                return found, keys
            self.lookups[step] = cut_lineage(found)
        return self.lookups[step], keys

    def _first(self, base: DataFrame, has_time: bool) -> DataFrame:
        """Counts, running counts and date parts of ``base``, whose stage is deleted."""
        with Scratch() as s:
            out = self._counted(base, has_time)
            s.keep(out, *self.lookups.values())
        drop_read(base)
        return FE.date_parts(out, self.time_col, self.parts) if has_time else out

    def _counted(self, out: DataFrame, has_time: bool) -> DataFrame:
        counts = [self._lookup(f"count {c}", out, [c], [F.count(F.lit(1)).alias(FE.feat_name("n_", "CatCnt", c))])
                  for c in self.cats]
        # running counts first, while the rows are narrow; their columns come last
        out = FE.attach(FE.cat_running_count(out, self.cats, self.time_col if has_time else None), counts)
        last = [FE.feat_name("n_", "CatCumCnt", c) for c in self.cats]
        return cut_lineage(out.select("row_id", *[F.col(f"`{c}`") for c in out.columns if c not in ("row_id", *last)],
                                      *[F.col(f"`{c}`") for c in last]))

    def _second(self, first: DataFrame, has_time: bool) -> DataFrame:
        """Pair counts, means and time gaps of ``first``, whose stage is deleted."""
        cats = self.combine_cats[:self.combine]
        with Scratch() as s:
            out = self._combined(first, cats)
            s.keep(out, *self.lookups.values())
        drop_read(first)
        if has_time:
            own = [c for c in cats if c in out.columns]
            with Scratch() as s:
                out = FE.cat_time_gap(out, own, self.time_col, drop_time_col=True) if own else out.drop(self.time_col)
                s.keep(out)
        return out

    def _combined(self, out: DataFrame, cats: list) -> DataFrame:
        nums = self.combine_nums[:self.combine]
        pairs = [(a, b, FE.feat_name("n_", "CatCnt2LEVEL", f"{a}_{b}_cnt")) for a, b in itertools.combinations(cats, 2)]
        means = [self._lookup(f"mean {c}", out, [c], [F.avg(F.col(f"`{n}`")).alias(
            FE.feat_name("n_", "NumMean2LEVEL", f"{c}_{n}_mean")) for n in nums]) for c in cats if nums]
        out = FE.pair_counts(out, pairs) if self.refit else FE.attach(out, [
            self._lookup(f"pair {a} {b}", out, [a, b], [F.count(F.lit(1)).alias(name)]) for a, b, name in pairs])
        return cut_lineage(FE.attach(out, means))

    def transform(self, df: DataFrame) -> DataFrame:
        # lineage is cut between stages: each stage re-reads its input several times
        has_time = self.time_col is not None and self.time_col in df.columns
        with Scratch() as s:
            base = cut_lineage(self.encoder.transform(self._raw(df)))
            s.keep(base, self.encoder.dictionary)
        out = self._first(base, has_time)
        return self._second(out.drop(*self.drop1), has_time).drop(*self.drop2) if self.deep else out


# ------------------------------------------------------------------ M14 end to end

TASKS = ("ssl", "pu", "noisy")


@dataclass
class WeakLabelModel:
    """Task dispatch, train, predict; save / load (S3)."""

    task: str
    max_models: int = 2
    rounds: int = 10
    trials: int = 0
    seed: int = 0
    clean_rounds: int = 0
    folds: int = LN.CLEAN_FOLDS
    refit: bool = True
    engine: FeatureEngine | None = None
    features: list = field(default_factory=list)
    models: list = field(default_factory=list)

    def train(self, df: DataFrame) -> "WeakLabelModel":
        if self.task not in TASKS:
            raise ValueError(f"unknown task {self.task!r}")
        self.engine = FeatureEngine(self.task, rounds=self.rounds, seed=self.seed, refit=self.refit,
                                    folds=self.folds)
        with Scratch() as s:
            # the engine's cleaning and selection read labels: 0 / 1 first
            feats = self.engine.fit_transform(normalize_labels(df, "noisy") if self.task == "noisy" else df)
            self.features = LN.feature_columns(feats)
            feats = cut_lineage(feats.na.fill(-1, subset=self.features))  # P1 rule for model input
            s.keep(feats, self.engine.encoder.dictionary, *self.engine.lookups.values())
        if self.task == "ssl":
            self.models = ssl_ensemble(feats, self.features, self.max_models, self.rounds, self.trials, self.seed)
        elif self.task == "pu":
            self.models = pu_ensemble(feats, self.features, self.max_models, self.rounds, self.trials, self.seed)
        else:
            self.models = noisy_ensemble(feats, self.features, self.max_models, self.rounds, self.clean_rounds,
                                         self.seed, noise_sum=self.engine.noise_sum, trials=self.trials,
                                         folds=self.folds, clean_iter=self.rounds)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        feats = self.engine.transform(df).na.fill(-1, subset=self.features)
        return predict(self.models, feats)

    def save(self, path: str) -> None:
        """Models with the ML writer, dictionaries as Parquet, settings as JSON."""
        for i, m in enumerate(self.models):
            m.write().overwrite().save(f"{path}/model_{i}")
        e = self.engine
        e.encoder.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        for i, found in enumerate(e.lookups.values()):
            found.write.mode("overwrite").parquet(f"{path}/lookup_{i}")
        spark = e.encoder.dictionary.sparkSession
        own = {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("engine", "models")}
        engine = {f.name: getattr(e, f.name) for f in fields(e) if f.name not in ("encoder", "lookups")}
        meta = dict(model=own, engine=engine, n_models=len(self.models), blocks=e.encoder.blocks,
                    lookups=list(e.lookups))
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "WeakLabelModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        enc = FE.BlockEncoder(blocks=meta["blocks"], dictionary=spark.read.parquet(f"{path}/dictionary"))
        lookups = {step: spark.read.parquet(f"{path}/lookup_{i}") for i, step in enumerate(meta["lookups"])}
        models = [PipelineModel.load(f"{path}/model_{i}") for i in range(meta["n_models"])]
        return cls(**meta["model"], engine=FeatureEngine(**meta["engine"], encoder=enc, lookups=lookups),
                   models=models)
