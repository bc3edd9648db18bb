"""Boosted regression trees learned from counted cells: rows that no split can part are one row.

Trees see a number only by its bin. With every row in every tree, the gain of a split and the mean of a leaf follow
from the number of rows of each cell (categories and bins) and their mean label, and boosting takes the same amount
off all labels of a cell. So cells are counted once, with map-side combine, and rounds cost what the cells cost.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from math import isfinite
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import Bucketizer, StringIndexerModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import ColumnRoles
from tabprep.operators.quantiles import exact_quantiles
from tabprep.session import shared_path
from tabprep.sources.tables import rows_frame

# Tasks get the functions of this module with their work, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One task learns from so many cells at most (reckoned, 600 MB of seven features), of trees no deeper than this; beyond, Spark's trees do.
CELLS_MOST, DEEPEST = 1 << 21, 14
#: Sums that a task adds to at once, at most, so that they stay in its cache.
_NEAR = 1 << 16
#: Spark takes nodes of less impurity for leaves.
_EPSILON = 2.220446049250313e-16
_SPLIT = "struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
_TREES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    f"rawCount: bigint, gain: double, leftChild: int, rightChild: int, split: {_SPLIT}>"
)


def learns_from_cells(roles: ColumnRoles, estimator: Estimator) -> bool:
    """Whether a fit follows from counted cells: boosting of squared errors that uses every row and feature in each tree."""
    if not roles.numeric or not isinstance(estimator, GBTRegressor):
        return False
    wanted = {"subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0,
              "lossType": "squared", "impurity": "variance"}
    same = all(estimator.getOrDefault(n) == v for n, v in wanted.items())
    named = ("weightCol", "validationIndicatorCol")
    whole = estimator.getOrDefault("featureSubsetStrategy") in ("all", "auto") and estimator.getOrDefault("maxDepth") <= DEEPEST
    return same and whole and not any(estimator.isDefined(n) for n in named)


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """The bounds between at most ``bins`` bins of each column, learned from all rows; a bin ends with its bound.

    Columns of no more values have a bin for each, with bounds halfway, those of up to twice as many bins of about equal
    numbers of values, and others bins of about equal numbers of rows.
    """
    if not columns:
        return {}
    about = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    near = [i for i in range(len(columns)) if about[f"n{i}"] <= 2 * bins]
    sets = df.agg(*[F.collect_set(columns[i]).alias(f"s{i}") for i in near]).first() if near else {}
    far = [c for i, c in enumerate(columns) if i not in near]
    edges = exact_quantiles(df, far, [k / bins for k in range(1, bins)]) if far else {}
    for i in near:
        values = sorted({float(v) for v in sets[f"s{i}"] if v == v})
        if len(values) <= bins:
            middle = [(a, a / 2 + b / 2, b) for a, b in zip(values, values[1:])]
            edges[columns[i]] = [m if a <= m < b else a for a, m, b in middle]
        else:  # more values than bins, by a few: as many to each bin
            edges[columns[i]] = [values[k * len(values) // bins - 1] for k in range(1, bins)]
    return {c: sorted({e for e in edges[c] if e is not None and isfinite(e)}) for c in columns}


def add_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], names: Sequence[str]) -> DataFrame:
    """``df`` with the number of bounds below each value; a missing number is an error, as it is in vectors."""
    parted = [(c, n) for c, n in zip(edges, names) if edges[c]]
    for c, n in zip(edges, names):
        missing = F.raise_error(F.lit(f"missing number in {c}")).cast("double")
        value = F.col(c).cast("double")
        # A bucket holds its lower bound and a bin its upper one, so buckets are those of the negative values.
        df = df.withColumn(n, F.when(value.isNull() | F.isnan(value), missing).otherwise(-value if edges[c] else F.lit(0.0)))
    if not parted:
        return df
    splits = [[-np.inf, *[-e for e in reversed(edges[c])], np.inf] for c, _ in parted]
    binner = Bucketizer(inputCols=[n for _, n in parted], outputCols=[f"{n}_" for _, n in parted], splitsArray=splits)
    placed = binner.transform(df)
    return placed.withColumns({n: F.lit(len(edges[c])) - F.col(f"{n}_").cast("int") for c, n in parted}).drop(*binner.getOutputCols())


class Feature(NamedTuple):
    """How trees part a feature: after some of ``edges``, or its ``labels`` by their mean."""

    edges: Sequence[float]
    labels: int = 0

    @property
    def bins(self) -> int:
        return self.labels or len(self.edges) + 1


@dataclass(frozen=True)
class Cells:
    """Counted cells in one partition: a number for each feature, rows and mean label."""

    frame: DataFrame
    features: tuple[Feature, ...]

    def fit(self, estimator: Estimator) -> Model:
        """The boosted trees of ``estimator``, as Spark's model."""
        if estimator.getOrDefault("maxDepth") > DEEPEST:
            raise ValueError(f"trees over cells have at most {DEEPEST} levels")
        rounds, step, depth = (estimator.getOrDefault(n) for n in ("maxIter", "stepSize", "maxDepth"))
        features = self.features

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*[[x.to_numpy(zero_copy_only=False) for x in b.columns] for b in batches if b.num_rows])]
            if not columns:
                return
            codes = Codes(np.stack([c.astype(np.int64) for c in columns[: len(features)]]), features)
            for i, tree in enumerate(boost(codes, columns[-1], columns[-2], rounds, step, depth)):
                yield _tree_batch(i, tree, features)

        return as_model(self.frame.mapInArrow(learn, _TREES), estimator, len(features))


@contextmanager
def counted_cells(rows: DataFrame, encoder: PipelineModel, roles: ColumnRoles, estimator: Estimator) -> Iterator[Cells | None]:
    """The cells of ``rows`` in the order of the features that ``encoder`` makes; none if they are too many for a task.

    Rows without a category are in no cell, as the encoder skips them. A missing label is an error.
    """
    label, bins = estimator.getLabelCol(), estimator.getOrDefault("maxBins")
    for c in roles.categorical:
        rows = rows.filter(F.col(c).isNotNull())
    edges = bin_edges(rows, roles.numeric, bins)
    names = [f"_bin{i}" for i in range(len(roles.numeric))]
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(F.col(label).cast("double")))
    # Few large partitions, as each counts the cells that it holds before any of them moves.
    few = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    binned = add_bins(few, {c: edges[c] for c in roles.numeric}, names)
    grouped = binned.groupBy(*roles.categorical, *names).agg(mean.alias("_mean"), F.count(F.lit(1)).cast("double").alias("_rows"))
    indexers = [stage for stage in encoder.stages if isinstance(stage, StringIndexerModel)]
    indexed = PipelineModel(indexers).transform(grouped)
    codes = [F.col(f"{c}_index").cast("int").alias(f"{c}_index") for c in roles.categorical]
    missing = F.raise_error(F.lit(f"missing label in {label}")).cast("double")
    known = F.when(F.col("_mean").isNull() | F.isnan("_mean"), missing).otherwise(F.col("_mean"))
    held = indexed.select(*codes, *names, known.alias("_mean"), "_rows").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = held.count()
        if not 0 < n <= CELLS_MOST:
            yield None
            return
        order = held.columns[:-2]
        one = held.repartition(1).sortWithinPartitions(*order).persist(StorageLevel.MEMORY_AND_DISK)
        labels = [Feature((), max(1, len(x))) for stage in indexers for x in stage.labelsArray]
        try:
            yield Cells(one, (*labels, *[Feature(edges[c]) for c in roles.numeric]))
        finally:
            one.unpersist()
    finally:
        held.unpersist()


@dataclass
class Tree:
    """Nodes by number, the root first. ``split`` is -1 in leaves; ``left`` holds the bins or labels that go left."""

    stats: np.ndarray
    split: np.ndarray
    gain: np.ndarray
    children: np.ndarray
    left: dict[int, np.ndarray]
    leaf: np.ndarray

    @property
    def means(self) -> np.ndarray:
        return self.stats[:, 1] / self.stats[:, 0]

    @property
    def impurity(self) -> np.ndarray:
        return np.maximum(self.stats[:, 2] / self.stats[:, 0] - self.means**2, 0)


class Codes:
    """The bins and labels of all rows, one row of ``codes`` a feature."""

    def __init__(self, codes: np.ndarray, features: Sequence[Feature]):
        self.codes, self.features, self.n = codes, features, codes.shape[1]
        self.widest = max(f.bins for f in features)
        self.across, self.begin = codes.T.ravel(), np.arange(self.n) * len(features)
        self.key, self.joint, self.room = np.empty(self.n, np.int64), {}, np.empty(self.n, np.int64)

    def groups(self, slots: int) -> list[tuple[int, ...]]:
        """Features that are counted together, as few cells of them for all slots stay near the core."""
        out, cells = [], _NEAR
        for f in sorted((f for f, x in enumerate(self.features) if x.bins > 1), key=lambda f: self.features[f].bins):
            cells *= self.features[f].bins
            if cells * slots > _NEAR:
                out.append(())
                cells = self.features[f].bins
            out[-1] += (f,)
        return out

    def histograms(self, slot: np.ndarray, count: int, values: Sequence[np.ndarray]) -> dict[int, list[np.ndarray]]:
        """For each feature the sums of ``values`` by slot, of which the last is left out, and bin."""
        out = {}
        for group in self.groups(count + 1):
            bins = [self.features[f].bins for f in group]
            if group not in self.joint:
                self.joint[group] = np.ravel_multi_index(tuple(self.codes[list(group)]), bins)
            np.multiply(slot, np.prod(bins), out=self.key)
            self.key += self.joint[group]
            sums = [np.bincount(self.key, x, (count + 1) * np.prod(bins)).reshape(-1, *bins)[:count] for x in values]
            for i, f in enumerate(group, 1):
                others = tuple(k for k in range(1, len(group) + 1) if k != i)
                out[f] = [x.sum(axis=others) for x in sums]
        return out

    def turns(self, slot: np.ndarray, tested: np.ndarray, goes_right: np.ndarray) -> np.ndarray:
        """Whether each row goes right, by the feature that its slot tests."""
        place = np.take(tested, slot, out=self.room, mode="clip")
        place += self.begin
        np.multiply(slot, self.widest, out=self.key)
        self.key += np.take(self.across, place)
        return np.take(goes_right, self.key, out=self.room, mode="clip")


def boost(codes: Codes, weight: np.ndarray, label: np.ndarray, rounds: int, step: float, depth: int) -> Iterator[Tree]:
    """Trees of Spark's boosting of squared errors: the first of the labels, each other of twice what is left."""
    guess = np.zeros(len(label))
    for i in range(rounds):
        tree = grow(codes, weight, 2 * (label - guess) if i else label, depth)
        guess += (step if i else 1.0) * tree.means[tree.leaf]
        yield tree


def grow(codes: Codes, weight: np.ndarray, target: np.ndarray, depth: int) -> Tree:
    """A regression tree, level by level; of equal gains the first feature's and the lowest bound's wins."""
    sums = weight * target
    squares = sums * target
    stats = [np.array([[weight.sum(), sums.sum(), squares.sum()]])]
    split, gains, children = [np.full(1, -1)], [np.full(1, -1.0)], [np.full((1, 2), -1)]
    leaf, slot, left = np.zeros(codes.n, np.int64), np.zeros(codes.n, np.int64), {}
    base, count = 0, 1  # nodes of this level: their first number, how many
    for _ in range(depth):
        best, where, order = np.zeros(count), np.full((count, 2), -1), {}
        for f, (w, s) in sorted(codes.histograms(slot, count, (weight, sums)).items()):
            if codes.features[f].labels:
                with np.errstate(invalid="ignore", divide="ignore"):
                    order[f] = np.argsort(np.where(w > 0, s / w, np.inf), axis=1, kind="stable")
                w, s = (np.take_along_axis(x, order[f], 1) for x in (w, s))
            w, s = np.cumsum(w, axis=1), np.cumsum(s, axis=1)
            rest, more, w, s = w[:, -1:] - w[:, :-1], s[:, -1:] - s[:, :-1], w[:, :-1], s[:, :-1]
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = np.where((w > 0) & (rest > 0), w * rest / (w + rest) ** 2 * (s / w - more / rest) ** 2, -1.0)
            place = gain.argmax(axis=1)
            gain = gain[np.arange(count), place]
            better = gain > best
            best[better], where[better, 0], where[better, 1] = gain[better], f, place[better]
        here = stats[-1]
        impure = here[:, 2] / here[:, 0] - (here[:, 1] / here[:, 0]) ** 2 >= _EPSILON
        parted = np.flatnonzero((where[:, 0] >= 0) & impure)
        if not len(parted):
            break
        split[-1][parted], gains[-1][parted] = where[parted, 0], best[parted]
        children[-1][parted] = base + count + np.arange(2 * len(parted)).reshape(-1, 2)
        goes_right = np.ones((count + 1, codes.widest), dtype=np.int64)
        for node in parted:
            f, place = where[node]
            inside = order[f][node, : place + 1] if f in order else np.arange(place + 1)
            left[base + node] = inside
            goes_right[node, inside] = 0
        next_slot = np.full((count + 1, 2), 2 * len(parted))
        next_slot[parted] = np.arange(2 * len(parted)).reshape(-1, 2)
        tested = np.zeros(count + 1, np.int64)
        tested[parted] = where[parted, 0]
        turned = codes.turns(slot, tested, goes_right)
        slot *= 2
        slot += turned
        slot = np.take(next_slot, slot, out=slot, mode="clip")
        base, count = base + count, 2 * len(parted)
        np.copyto(leaf, base + slot, where=slot < count)
        stats.append(np.stack([np.bincount(slot, x, count + 1)[:count] for x in (weight, sums, squares)], axis=1))
        split.append(np.full(count, -1)), gains.append(np.full(count, -1.0)), children.append(np.full((count, 2), -1))
    return Tree(np.concatenate(stats), np.concatenate(split), np.concatenate(gains), np.concatenate(children), left, leaf)


def _tree_batch(number: int, tree: Tree, features: Sequence[Feature]) -> pa.RecordBatch:
    """The nodes of a tree as Spark saves them: by depth first, the left child before the right one."""
    order, open_ = [], [0]
    while open_:
        node = open_.pop()
        order.append(node)
        if tree.split[node] >= 0:
            open_ += tree.children[node, ::-1].tolist()
    place = np.full(len(tree.split) + 1, -1)
    place[order] = np.arange(len(order))
    means, impurity, nodes = tree.means, tree.impurity, []
    for i, node in enumerate(order):
        f = int(tree.split[node])
        feature, inside = features[f], tree.left.get(node, ())
        values = [] if f < 0 else sorted(map(float, inside)) if feature.labels else [feature.edges[len(inside) - 1]]
        one, two = place[tree.children[node]].tolist()
        nodes.append({
            "id": i, "prediction": means[node], "impurity": impurity[node], "impurityStats": tree.stats[node].tolist(),
            "rawCount": int(tree.stats[node, 0]), "gain": tree.gain[node], "leftChild": one, "rightChild": two,
            "split": {"featureIndex": f, "leftCategoriesOrThreshold": values, "numCategories": feature.labels or -1 if f >= 0 else -1},
        })
    return pa.RecordBatch.from_arrays([pa.array([number] * len(nodes), pa.int32()), pa.array(nodes, _NODES)], ["treeID", "nodeData"])


_NODES = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
])


def as_model(trees: DataFrame, estimator: Estimator, features: int) -> GBTRegressionModel:
    """Spark's model of the trees, read from the form in which Spark saves one."""
    spark, path = trees.sparkSession, shared_path(trees.sparkSession, "boosted")
    estimator.save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    rounds, step = estimator.getOrDefault("maxIter"), estimator.getOrDefault("stepSize")
    whole = {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "numFeatures": features, "numTrees": rounds}
    own = ("maxIter", "stepSize", "subsamplingRate", "lossType", "featureSubsetStrategy", "validationTol", "validationIndicatorCol", "impurity")
    kept = {k: {n: v for n, v in about[k].items() if n not in own} for k in ("paramMap", "defaultParamMap")}
    tree = {**about, **kept, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"}
    each = [(i, json.dumps({**tree, "uid": f"{about['uid']}_{i}"}), float(step if i else 1.0)) for i in range(rounds)]
    trees.write.parquet(f"{path}/model/data")
    columns = [T.StructField(f"_{i}", kind) for i, kind in enumerate((T.IntegerType(), T.StringType(), T.DoubleType()), 1)]
    rows_frame(spark, each, T.StructType(columns)).coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    line = T.StructType([T.StructField("value", T.StringType())])
    rows_frame(spark, [(json.dumps({**about, **whole}),)], line).coalesce(1).write.text(f"{path}/model/metadata")
    return GBTRegressionModel.load(f"{path}/model")
