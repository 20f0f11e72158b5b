"""Boosted trees of ``pyspark.ml`` whose training rows are blocks of binned bytes.

Spark's own fit keeps every training point, its prediction and its error as an object, several
copies of each, which large tables push to the executors' disks and read back for every level.
Here a row is a few bytes: its features are binned once at Spark's thresholds, and features
share a 16-bit code while the product of their bins is at most ``GROUP_CODES``.  Blocks of
``BLOCK_ROWS`` rows are written to the shared folder.  A level of a tree is one pass over the
blocks: rows walk down the tree by table lookups, histograms of counts, sums and sums of squares
are added up per code in numpy, and each task returns those of the single features, which the
driver adds in the order of the tasks.  The sums of a row's finished trees are written with the
blocks every ``PENDING`` trees, and computed by the pass in between.

The trees are Spark's: the same sampled thresholds (drawn by Spark from the same rows), variance
gain, order of ties, stopping rules, losses, and early stopping on validation rows.  The result is
the ``pyspark.ml`` model itself.  Only the draws of row and feature fractions differ; they depend
on the block, not on the task.  Up to ``SMALL_ROWS`` training rows, and with settings that are not
covered (weights, absolute loss), the fit is Spark's.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_stage, import_path, stage_path

SMALL_ROWS = 500_000
BLOCK_ROWS = 16_384
GROUP_CODES = 1024
PENDING = 3
# Histogram cells that a task returns at a time, tasks of a pass per core, blocks of an Arrow batch.
CELLS = 150_000
TASKS_PER_CORE = 4
BATCH_BLOCKS = 8
# Spark's: rows of which thresholds are found, and what counts as a pure node.
SPLIT_ROWS = 10_000
EPSILON = 2.0 ** -52

_BLOCK = "part int, at int, n int, codes binary, label binary, score binary"
_PASS = "part int, hist binary, error double, rows long"


def thresholds(values: np.ndarray, max_splits: int, expected: float) -> np.ndarray:
    """Spark's thresholds of one feature from a sample that should have ``expected`` rows: what
    is missing counts as zeros, as Spark drops these."""
    values = values[values != 0.0]
    if not len(values):
        return np.zeros(0)
    found, counts = np.unique(values, return_counts=True)
    counts = counts.astype(float)
    if expected - len(values) > EPSILON * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, expected - len(values))
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= max_splits:
        return middle
    stride = expected / (max_splits + 1)
    out, current, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


class Layout:
    """Which code a feature is in: code = sum of bin * stride over the features of a group."""

    def __init__(self, splits: list):
        self.splits = splits
        self.bins = [len(s) + 1 for s in splits]
        self.place: dict = {}           # feature -> (group, stride)
        self.sizes: list = []
        for f in sorted((f for f, n in enumerate(self.bins) if n > 1), key=lambda f: -self.bins[f]):
            g = next((g for g, n in enumerate(self.sizes) if n * self.bins[f] <= GROUP_CODES), None)
            if g is None:
                g = len(self.sizes)
                self.sizes.append(1)
            self.place[f] = g, self.sizes[g]
            self.sizes[g] *= self.bins[f]
        self.used = sorted(self.place)
        self.first = dict(zip(self.used, np.cumsum([0, *(self.bins[f] for f in self.used)]).tolist(), strict=False))
        self.cells = sum(self.bins[f] for f in self.used)

    def codes(self, values: list) -> np.ndarray:
        out = np.zeros((len(self.sizes), len(values[0]) if values else 0), np.uint16)
        for f, (g, stride) in self.place.items():
            out[g] += (np.searchsorted(self.splits[f], values[f], side="left") * stride).astype(np.uint16)
        return out

    def bin_of_code(self, f: int) -> np.ndarray:
        g, stride = self.place[f]
        return np.arange(self.sizes[g]) // stride % self.bins[f]

    def single(self, groups: list, nodes: int) -> np.ndarray:
        """Histograms (node, cell) of the single features from those of the groups."""
        out = np.zeros((nodes, self.cells))
        for f in self.used:
            g, stride = self.place[f]
            at = self.first[f]
            out[:, at:at + self.bins[f]] = groups[g].reshape(nodes, -1, self.bins[f], stride).sum(axis=(1, 3))
        return out


class Node:
    """A node of a tree that grows; stats: rows, sum and sum of squares of the residuals."""

    def __init__(self, level: int, stats: tuple | None = None):
        self.level, self.stats = level, stats
        self.feature = self.split = self.left = self.right = None
        self.gain, self.valid = 0.0, True

    @property
    def impurity(self) -> float:
        n, s, q = self.stats
        return (q - s * s / n) / n if n else 0.0

    @property
    def value(self) -> float:
        return self.stats[1] / self.stats[0] if self.stats and self.stats[0] else 0.0


class Flat:
    """A tree as arrays: a row at node i goes on to ``left[i] + table[off[i] + code]``."""

    def __init__(self, root: Node, layout: Layout, open_: list = ()):
        nodes, at = [root], 0
        while at < len(nodes):
            if nodes[at].left is not None:
                nodes += [nodes[at].left, nodes[at].right]
            at += 1
        place = {id(n): i for i, n in enumerate(nodes)}
        tables, size = [np.zeros(max(layout.sizes, default=1), np.int64)], max(layout.sizes, default=1)
        self.left = np.arange(len(nodes))
        self.group, self.off = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        for i, n in enumerate(nodes):
            if n.left is not None:
                self.left[i], self.group[i], self.off[i] = place[id(n.left)], layout.place[n.feature][0], size
                tables.append((layout.bin_of_code(n.feature) > n.split).astype(np.int64))
                size += len(tables[-1])
        self.table = np.concatenate(tables)
        self.value = np.array([n.value for n in nodes])
        self.depth = max(n.level for n in nodes) - root.level
        self.slot = np.full(len(nodes), len(open_))
        for k, n in enumerate(open_):
            self.slot[place[id(n)]] = k

    def walk(self, codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        at, rows, flat, group = np.zeros(n, np.int64), np.arange(n), codes.ravel(), self.group * n
        for _ in range(self.depth):
            code = flat.take(group.take(at) + rows)
            at = self.left.take(at) + self.table.take(self.off.take(at) + code)
        return at


class Loss:
    """Spark's log loss over labels of -1 and 1, or squared error."""

    def __init__(self, classify: bool):
        self.classify, self.kind = classify, np.int8 if classify else np.float64

    def residual(self, y: np.ndarray, score: np.ndarray | None) -> np.ndarray:
        if score is None:       # the first tree is fitted on the labels
            return y
        with np.errstate(over="ignore"):
            return 4.0 * y / (1.0 + np.exp(2.0 * y * score)) if self.classify else 2.0 * (y - score)

    def error(self, y: np.ndarray, score: np.ndarray) -> float:
        return float((2.0 * np.logaddexp(0.0, -2.0 * y * score) if self.classify else (y - score) ** 2).sum())


class Work:
    """What a pass does with a block: the trees that its scores lack, and the tree that grows."""

    def __init__(self, layout: Layout, loss: Loss, pending: list, scored: bool, tree: Flat | None = None, nodes: int = 0,
                 rate: float = 1.0, seed: int = 0):
        self.layout, self.loss, self.pending, self.scored = layout, loss, pending, scored
        self.tree, self.nodes, self.rate, self.seed = tree, nodes, rate, seed

    def read(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        codes = np.frombuffer(row["codes"], np.uint16).reshape(len(self.layout.sizes), row["n"])
        y = np.frombuffer(row["label"], self.loss.kind).astype(float)
        if not self.scored and not self.pending:
            return codes, y, None
        score = np.frombuffer(row["score"], np.float64) if self.scored else np.zeros(row["n"])
        for tree, weight in self.pending:
            score = score + tree.value.take(tree.walk(codes)) * weight
        return codes, y, score

    def histograms(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, k = self.layout.sizes, self.nodes
        sums = [[np.zeros(k * n) for n in sizes] for _ in range(3)]
        for batch in batches:
            for row in batch.to_pylist():
                codes, y, score = self.read(row)
                r, slot = self.loss.residual(y, score), self.tree.slot.take(self.tree.walk(codes))
                keep = slot < k
                if self.rate < 1.0:
                    keep &= np.random.default_rng([self.seed, row["part"], row["at"]]).random(row["n"]) < self.rate
                if not keep.all():
                    codes, r, slot = codes[:, keep], r[keep], slot[keep]
                square = r * r
                for g, n in enumerate(sizes):
                    cell = slot * n + codes[g]
                    sums[0][g] += np.bincount(cell, minlength=k * n)
                    sums[1][g] += np.bincount(cell, r, k * n)
                    sums[2][g] += np.bincount(cell, square, k * n)
        hist = np.stack([self.layout.single(s, k) for s in sums])
        yield _answer(hist.tobytes(), 0.0, 0)

    def errors(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = 0.0, 0
        for batch in batches:
            for row in batch.to_pylist():
                _, y, score = self.read(row)
                total, rows = total + self.loss.error(y, score), rows + row["n"]
        yield _answer(None, total, rows)

    def totals(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows, sum and sum of squares of the residuals alone, where no feature has a threshold."""
        out = np.zeros(3)
        for batch in batches:
            for row in batch.to_pylist():
                _, y, score = self.read(row)
                r = self.loss.residual(y, score)
                out += len(r), r.sum(), (r * r).sum()
        yield _answer(out.tobytes(), 0.0, 0)

    def update(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [self.read(row)[2].tobytes() for row in batch.to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(scores, pa.binary()))


def _answer(hist: bytes | None, error: float, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([hist], pa.binary()),
        pa.array([error], pa.float64()), pa.array([rows], pa.int64())], ["part", "hist", "error", "rows"])


class Blocks:
    """Written blocks of coded rows, read by a session of their own, whose Arrow batches are a few blocks."""

    def __init__(self, rows: DataFrame, names: list, layout: Layout, loss: Loss):
        spark = rows.sparkSession
        import_path(spark)
        self.spark = spark.newSession()
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_BLOCKS))
        self.scored = False

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for at, table in enumerate(_tables(batches)):
                codes = layout.codes([table.column(i).to_numpy() for i in range(len(names))])
                y = table.column(len(names)).to_numpy()
                y = y * 2 - 1 if loss.classify else y
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([len(y)], pa.int32()),
                     *(pa.array([x], pa.binary()) for x in (codes.tobytes(), y.astype(loss.kind).tobytes(), b""))],
                    ["part", "at", "n", "codes", "label", "score"])

        self._write(rows.mapInArrow(coded, _BLOCK))

    def _write(self, blocks: DataFrame) -> None:
        path = stage_path(self.spark)
        blocks.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").option(
            "parquet.block.size", str(8 << 20)).parquet(path)
        self.path, self.frame = path, self.spark.read.schema(_BLOCK).parquet(path)

    def update(self, work: Work) -> None:
        old = self.path
        self._write(self.frame.mapInArrow(work.update, _BLOCK))
        drop_stage(self.spark, old)
        self.scored = True

    def run(self, method) -> list:
        tasks = TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism
        return sorted(self.frame.coalesce(tasks).mapInArrow(method, _PASS).collect(), key=lambda r: r["part"])

    def drop(self) -> None:
        drop_stage(self.spark, self.path)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of ``BLOCK_ROWS`` rows, the last one of those that are left."""
    held, rows = [], 0
    for batch in batches:
        while rows + batch.num_rows >= BLOCK_ROWS:
            take = BLOCK_ROWS - rows
            yield pa.Table.from_batches([*held, batch.slice(0, take)])
            held, rows, batch = [], 0, batch.slice(take)
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _best(node: Node, hist: np.ndarray, layout: Layout, features: list, min_rows: int, min_gain: float) -> tuple | None:
    """Gain, feature, split and both sides' statistics of the best split; the first one of equals."""
    best = None
    for f in features:
        if f not in layout.place:
            continue
        at = layout.first[f]
        upto = np.cumsum(hist[:, at:at + layout.bins[f]], axis=1)
        total, left = upto[:, -1:], upto[:, :-1]
        right = total - left
        if node.stats is None:      # the root, whose statistics no parent gave it
            node.stats = tuple((left[:, 0] + right[:, 0]).tolist())
        rows = left[0] + right[0]
        gain = node.impurity - left[0] / rows * _variance(left) - right[0] / rows * _variance(right)
        gain[(left[0] < min_rows) | (right[0] < min_rows) | ~(gain >= min_gain)] = -np.inf
        i = int(np.argmax(gain))
        if gain[i] > -np.inf and (best is None or gain[i] > best[0]):
            best = float(gain[i]), f, i, tuple(left[:, i].tolist()), tuple(right[:, i].tolist())
    return best


def _variance(stats: np.ndarray) -> np.ndarray:
    n, s, q = stats
    some = np.maximum(n, 1.0)
    return np.where(n > 0, (q - s * s / some) / some, 0.0)


def grow(blocks: Blocks, layout: Layout, loss: Loss, pending: list, depth: int, min_rows: int, min_gain: float,
         rate: float, subset: int, seed: int) -> Node:
    """One tree on the residuals, level by level."""
    root, draws = Node(0), random.Random(seed)
    open_ = [root]
    if not layout.used:
        work = Work(layout, loss, pending, blocks.scored)
        root.stats = tuple(sum(np.frombuffer(r["hist"]) for r in blocks.run(work.totals)).tolist())
        root.valid = False
        return root
    while open_:
        deeper: list = []
        width = max(1, CELLS // layout.cells)
        for some in (open_[i:i + width] for i in range(0, len(open_), width)):
            work = Work(layout, loss, pending, blocks.scored, Flat(root, layout, some), len(some), rate, seed)
            hist = sum(np.frombuffer(r["hist"]) for r in blocks.run(work.histograms)).reshape(3, len(some), -1)
            for k, node in enumerate(some):
                chosen = sorted(draws.sample(range(len(layout.bins)), subset)) if subset < len(layout.bins) else range(len(layout.bins))
                best = _best(node, hist[:, k], layout, chosen, min_rows, min_gain)
                if node.stats is None:      # none of the features drawn has a threshold
                    f = layout.used[0]
                    node.stats = tuple(hist[:, k, layout.first[f]:layout.first[f] + layout.bins[f]].sum(axis=1).tolist())
                node.valid = best is not None
                if best is None or best[0] <= 0 or node.level == depth:
                    continue
                deeper.append((node, best))
        open_ = []
        for node, (gain, f, i, left, right) in deeper:
            node.gain, node.feature, node.split = gain, f, i
            node.left, node.right = Node(node.level + 1, left), Node(node.level + 1, right)
            open_ += [n for n in (node.left, node.right) if n.level < depth and abs(n.impurity) >= EPSILON]
    return root


def boost(train: Blocks, valid: Blocks | None, layout: Layout, loss: Loss, rounds: int, step: float, tol: float,
          seed: int, **grown) -> tuple[list, list]:
    """Trees and their weights, up to those with the best validation error."""
    trees: list = []
    pending: list = []
    best, kept, m = math.nan, 1, 0
    while m < rounds:
        if len(pending) >= PENDING:
            for blocks in filter(None, (train, valid)):
                blocks.update(Work(layout, loss, pending, blocks.scored))
            pending = []
        root = grow(train, layout, loss, pending, seed=seed + m, **grown)
        trees.append(root)
        pending = [*pending, (Flat(root, layout), step if m else 1.0)]
        m += 1
        if valid is None:
            continue
        found = valid.run(Work(layout, loss, pending, valid.scored).errors)
        rows = sum(r["rows"] for r in found)
        error = sum(r["error"] for r in found) / rows if rows else math.nan
        if m == 1:
            best = error
        elif best - error < tol * max(error, 0.01):
            break
        elif error < best:
            best, kept = error, m
    trees = trees if valid is None else trees[:kept]
    return trees, [step if i else 1.0 for i in range(len(trees))]


def _java_tree(spark: SparkSession, root: Node, layout: Layout, uid: str):
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    tree, impurity = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity

    def of(node: Node):
        stats = gateway.new_array(jvm.double, 3)
        for i, x in enumerate(node.stats):
            stats[i] = float(x)
        figures = impurity.VarianceCalculator(stats, int(node.stats[0]))
        if node.left is None:
            return tree.LeafNode(float(node.value), float(node.impurity) if node.valid else -1.0, figures), node.value
        (left, x), (right, y) = of(node.left), of(node.right)
        if x is not None and x == y:        # two leaves that predict the same are one
            return tree.LeafNode(float(x), float(node.impurity), figures), x
        split = tree.ContinuousSplit(node.feature, float(layout.splits[node.feature][node.split]))
        return tree.InternalNode(float(node.value), float(node.impurity), float(node.gain), left, right, split, figures), None

    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, of(root)[0], len(layout.bins))


class _BlockFit:
    """``_fit`` over blocks, for large training sets."""

    classify = True

    def _names(self, dataset: DataFrame) -> list | None:
        """The columns that the vector of features was assembled from."""
        info = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        attrs = sorted((a["idx"], a.get("name")) for kind in info.get("attrs", {}).values() for a in kind)
        names = [name for _, name in attrs]
        numeric = set(info.get("attrs", {})) <= {"numeric"}
        return names if names and numeric and len(names) == info.get("num_attrs") and set(names) <= set(dataset.columns) else None

    def _subset(self, n: int) -> int | None:
        """Features that a node looks at, or None where the strategy is not covered."""
        given = self.getFeatureSubsetStrategy()
        if given in ("all", "auto"):
            return n
        try:
            share = float(given)
        except ValueError:
            return None
        return math.ceil(share * n) if "." in given and 0 < share <= 1 else None

    def _fit(self, dataset: DataFrame):
        names = self._names(dataset)
        loss_type = "logistic" if self.classify else "squared"
        covered = (names is not None and not (self.isDefined("weightCol") and self.getWeightCol()) and self.getLossType() == loss_type
                   and self.getMinWeightFractionPerNode() == 0.0 and self._subset(len(names)) is not None)
        if not covered:
            return super()._fit(dataset)
        flag = self.getValidationIndicatorCol() if self.isDefined("validationIndicatorCol") and self.getValidationIndicatorCol() else None
        held = [] if flag is None else [flag]
        label = F.col(f"`{self.getLabelCol()}`").cast("double")
        rows = dataset.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(names)], label.alias("_y"), *held)
        train = rows.where(~F.col(flag)).drop(flag) if flag else rows
        n = train.count()
        if n <= SMALL_ROWS:
            return super()._fit(dataset)
        self._check(rows, len(names))
        layout = Layout(self._splits(train, len(names), n))
        loss = Loss(self.classify)
        kept: list = []
        try:
            for part in [train] + ([rows.where(F.col(flag)).drop(flag)] if flag else []):
                kept.append(Blocks(part, [f"_{i}" for i in range(len(names))], layout, loss))
            trees, weights = boost(
                kept[0], kept[1] if flag else None, layout, loss, self.getMaxIter(), self.getStepSize(), self.getValidationTol(),
                self.getSeed(), depth=self.getMaxDepth(), min_rows=self.getMinInstancesPerNode(), min_gain=self.getMinInfoGain(),
                rate=self.getSubsamplingRate(), subset=self._subset(len(names)))
        finally:
            for blocks in kept:
                blocks.drop()
        return self._copyValues(self._model(dataset.sparkSession, trees, weights, layout))

    def _check(self, rows: DataFrame, features: int) -> None:
        """Values that Spark's fit raises on."""
        bad = F.lit(False)
        for i in range(features):
            x = F.col(f"_{i}")
            bad = bad | x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
        y = F.col("_y")
        wrong = y.isNull() | F.isnan(y) | (~y.isin(0.0, 1.0) if self.classify else F.abs(y) == F.lit(math.inf))
        found = rows.agg(F.count_if(bad).alias("bad"), F.count_if(wrong).alias("wrong")).first()
        if found["bad"]:
            raise ValueError(f"Vector values MUST NOT be NaN or Infinity: {found['bad']} rows")
        if found["wrong"]:
            raise ValueError(f"Labels MUST be {'in {0, 1}' if self.classify else 'finite'}: {found['wrong']} rows")

    def _splits(self, train: DataFrame, features: int, n: int) -> list:
        bins = min(self.getMaxBins(), n)
        wanted = max(bins * bins, SPLIT_ROWS)
        share = wanted / n if wanted < n else 1.0
        spark, sample = train.sparkSession, train
        if share < 1:       # by the sampler that Spark's fit uses, over the same partitions
            draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.getSeed()).nextInt()
            drawn = train._jdf.queryExecution().toRdd().sample(False, share, draw)
            sample = DataFrame(spark._jsparkSession.internalCreateDataFrame(drawn, train._jdf.schema(), False), spark)
        found = sample.toArrow()
        return [thresholds(found.column(i).to_numpy(), bins - 1, share * n) for i in range(features)]

    def _model(self, spark: SparkSession, trees: list, weights: list, layout: Layout):
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        models, steps = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
        for i, (root, weight) in enumerate(zip(trees, weights, strict=True)):
            models[i], steps[i] = _java_tree(spark, root, layout, f"{self.uid}_{i}"), float(weight)
        if self.classify:
            return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
                self.uid, models, steps, len(layout.bins), 2))
        return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(self.uid, models, steps, len(layout.bins)))


class BlockGBTClassifier(_BlockFit, GBTClassifier):
    """``GBTClassifier`` for training sets of any size."""


class BlockGBTRegressor(_BlockFit, GBTRegressor):
    """``GBTRegressor`` for training sets of any size."""

    classify = False
