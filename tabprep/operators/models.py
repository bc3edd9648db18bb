"""Fitting, scoring, inspecting, saving and loading pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import ColumnRoles
from tabprep.operators.boosting import counted_cells, learns_from_cells
from tabprep.operators.features import encoding_stages, feature_names, formula_stage
from tabprep.operators.profile import top_k
from tabprep.session import set_checkpoints
from tabprep.sources.tables import kept, rows_frame, stored

# Parameters of the boosted-tree model, bins of trees.
BOOSTING = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 4, "seed": 42}
TREE_BINS = 250
BOOSTING_BINS = 64
SEED = 42


def linear_regression(label: str, prediction: str = "prediction", **params) -> LinearRegression:
    return LinearRegression(labelCol=label, predictionCol=prediction, **params)


def decision_tree(label: str, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, **{"maxBins": TREE_BINS, **params})


def forest_regressor(label: str, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, **{"maxBins": TREE_BINS, "seed": SEED, **params})


def forest_classifier(label: str, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, **{"maxBins": TREE_BINS, "seed": SEED, **params})


def boosted_trees(label: str, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, **{**BOOSTING, "maxBins": BOOSTING_BINS, **params})


@dataclass(frozen=True)
class Encoded:
    """A fitted encoding and the frame it produced."""

    encoder: PipelineModel
    frame: DataFrame
    ranked: tuple[str, ...] = ()

    def with_model(self, model: Model) -> PipelineModel:
        """Encoding and model as one pipeline that scores raw rows."""
        return PipelineModel([*self.encoder.stages, model])


def max_bins(estimator: Estimator) -> int:
    return estimator.getOrDefault("maxBins")


def wide_columns(df: DataFrame, columns: Sequence[str], max_labels: int) -> list[str]:
    """The columns with more than ``max_labels`` labels, told in one pass.

    A sketch settles all but the columns near the bound; only those are counted exactly.
    """
    if not columns:
        return []
    about = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    near = [c for c in columns if 0.8 * max_labels <= about[c] <= 1.25 * max_labels]
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in near]).first() if near else {}
    return [c for c in columns if (exact[c] if c in near else about[c]) > max_labels]


def encode(
    df: DataFrame,
    roles: ColumnRoles,
    one_hot: bool = False,
    handle_invalid: str = "skip",
    max_labels: int | None = None,
    label: str | None = None,
) -> Encoded:
    """Fit the encoding once; several models can then be fitted to the lazy frame.

    With ``max_labels``, columns of more labels become ranks by their mean ``label``
    (``LabelRanker``) instead of indexes, and count as numbers from there on.
    """
    ranked = wide_columns(df, roles.categorical, max_labels) if max_labels else []
    encoder = Pipeline(stages=encoding_stages(roles, one_hot, handle_invalid, ranked=ranked, label=label)).fit(df)
    return Encoded(encoder, encoder.transform(df), tuple(ranked))


def fit_linear(df: DataFrame, roles: ColumnRoles, label: str, **params) -> PipelineModel:
    """Least squares on one-hot categories and numbers."""
    with kept(df.select(*roles.categorical, *roles.numeric, label)) as rows:
        encoded = encode(rows, roles, one_hot=True)
        return encoded.with_model(linear_regression(label, **params).fit(encoded.frame))


def fit_formula(df: DataFrame, formula: str, label: str, prediction: str = "prediction") -> PipelineModel:
    """Least squares on the features of a formula; rows with labels that are missing in the fit are left out.

    The formula reads ``df`` itself; its vectors are made once and kept for the fit and for Spark's summary of it.
    Sums do not follow the layout, so no row is moved.
    """
    encoder = formula_stage(formula, label=label, handle_invalid="skip").fit(df)
    with stored(encoder.transform(df).select("features", label), df) as prepared:
        return PipelineModel([encoder, linear_regression(label, prediction).fit(prepared)])


def fit_trees(df: DataFrame, roles: ColumnRoles, estimator: Estimator) -> PipelineModel:
    """Any tree model on categories and numbers.

    ``maxBins`` stays as set: columns with more labels than bins are ordered by their mean label.
    """
    with fitting(df, roles, estimator) as (encoded, fit):
        return encoded.with_model(fit(estimator))


@contextmanager
def fitting(df: DataFrame, roles: ColumnRoles, estimator: Estimator) -> Iterator[tuple[Encoded, Callable[[Estimator], Model]]]:
    """The encoding, fitted once, and a function that fits ``estimator``, or the same with other numbers of rounds, levels
    and the like, to what it learns from: counted cells (``learns_from_cells``), ``learned_rows``, or all rows.
    """
    label = estimator.getLabelCol()
    by_cells = learns_from_cells(roles, estimator)
    keep = stored if by_cells or learns_from_means(roles, estimator) else kept
    with keep(df.select(*roles.categorical, *roles.numeric, label)) as rows:
        encoded = encode(rows, roles, max_labels=max_bins(estimator), label=label)
        set_checkpoints(df.sparkSession)  # rounds cut their lineage as checkpointInterval says
        if by_cells and not encoded.ranked and isinstance(rows.schema[label].dataType, T.NumericType):
            with counted_cells(rows, encoded.encoder, roles, estimator) as cells:
                if cells is not None:
                    yield encoded, cells.fit
                    return
        if not encoded.ranked and not by_cells:
            with learned_rows(encoded, roles, estimator) as prepared:
                yield encoded, lambda wanted: fit_rows(wanted, prepared)
            return
        # A join of ranks moves rows, so these are laid out anew, and not joined once more a pass.
        with kept(encoded.frame.select("features", label)) as prepared:
            yield encoded, lambda wanted: wanted.fit(prepared)


#: The column that tells how many rows stand behind one of ``learned_rows``.
WEIGHT = "_weight"


def learns_from_means(roles: ColumnRoles, estimator: Estimator) -> bool:
    """Whether a fit follows from the number of rows of equal features and their mean label.

    So it does for regression trees, forests and boosting of squared errors on categories alone that use every
    row once in each tree: a split's gain does not hold the spread of labels within equal features, and boosting
    takes the same amount off all of these labels.
    """
    if roles.numeric or not isinstance(estimator, DecisionTreeRegressor | RandomForestRegressor | GBTRegressor):
        return False
    wanted = {"bootstrap": False, "subsamplingRate": 1.0, "minInstancesPerNode": 1, "lossType": "squared"}
    same = all(estimator.getOrDefault(n) == v for n, v in wanted.items() if estimator.hasParam(n))
    named = ("weightCol", "validationIndicatorCol")
    return same and not any(estimator.hasParam(n) and estimator.isDefined(n) for n in named)


@contextmanager
def learned_rows(encoded: Encoded, roles: ColumnRoles, estimator: Estimator, keep: bool = False) -> Iterator[DataFrame]:
    """What ``fit_rows`` learns from: the encoded rows (``keep``: kept), or where that is enough (``learns_from_means``)
    a row of each features with its number of rows and mean label, counted with map-side combine.

    A missing label makes the mean missing, so it is an error as it is among all rows. Trees take no more bins
    than rows: where features are fewer than a column's labels, rows are not put together.
    """
    label, frame = estimator.getLabelCol(), encoded.frame
    whole = kept(frame.select("features", label)) if keep else nullcontext(frame)
    numeric = label in frame.columns and isinstance(frame.schema[label].dataType, T.NumericType)
    if encoded.ranked or not numeric or not learns_from_means(roles, estimator):
        with whole as rows:
            yield rows
        return
    n, mean = F.count(F.lit(1)), F.avg(F.col(label).cast("double"))
    grouped = frame.groupBy("features").agg(F.when(F.count(label) == n, mean).alias(label), n.cast("double").alias(WEIGHT))
    labels = [len(x) for stage in encoded.encoder.stages if isinstance(stage, StringIndexerModel) for x in stage.labelsArray]
    held = grouped.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        enough = held.count() >= max(labels, default=0)
        with kept(held) if enough else whole as rows:  # few rows in few partitions, as every level of a tree is a pass
            yield rows
    finally:
        held.unpersist()


def fit_rows(estimator: Estimator, rows: DataFrame) -> Model:
    """The model of ``learned_rows``; weights leave no trace in it."""
    if WEIGHT not in rows.columns:
        return estimator.fit(rows)
    model = estimator.copy({estimator.weightCol: WEIGHT}).fit(rows)
    model.clear(model.weightCol)
    return model


def fit_stages(df: DataFrame, *stages) -> PipelineModel:
    """Any stages as a pipeline; wrap a frame in ``kept`` first when several of them learn from it."""
    return Pipeline(stages=list(stages)).fit(df)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Append predictions; lazy, no shuffle."""
    return model.transform(df)


_FEATURE_SCHEMA = [T.StructField("position", T.IntegerType()), T.StructField("feature", T.StringType())]


def _per_feature(df: DataFrame, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    schema = T.StructType([*_FEATURE_SCHEMA, T.StructField(column, T.DoubleType())])
    rows = [(i, name, float(value)) for i, (name, value) in enumerate(zip(names, values))]
    return rows_frame(df.sparkSession, rows, schema)


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(position, feature, coefficient) of a linear pipeline, the intercept last."""
    linear = model.stages[-1]
    names = feature_names(PipelineModel(model.stages[:-1]).transform(df), linear.getFeaturesCol())
    values = [*linear.coefficients.toArray(), linear.intercept]
    return _per_feature(df, [*names, "(intercept)"], values, "coefficient")


def feature_importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(position, feature, importance) of a tree pipeline."""
    trees = model.stages[-1]
    names = feature_names(PipelineModel(model.stages[:-1]).transform(df), trees.getFeaturesCol())
    return _per_feature(df, names, trees.featureImportances.toArray(), "importance")


def top_features(importances: DataFrame, k: int = 5) -> DataFrame:
    return top_k(importances, k, [F.desc("importance"), F.asc("position")])


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def estimator_params(model: PipelineModel) -> dict[str, str]:
    """Set and default parameters of every stage, as ``position.stage.parameter`` and text."""
    return {
        f"{i}.{type(stage).__name__}.{param.name}": str(value)
        for i, stage in enumerate(model.stages)
        for param, value in stage.extractParamMap().items()
        if stage.uid not in str(value)  # default column names hold a random identifier
    }


# What fitted stages know besides their parameters.
_LEARNED = {
    "StringIndexerModel": {"labels": lambda m: [list(x) for x in m.labelsArray]},
    "OneHotEncoderModel": {"categorySizes": lambda m: list(m.categorySizes)},
    "LinearRegressionModel": {
        "numFeatures": lambda m: m.numFeatures,
        "coefficients": lambda m: [*m.coefficients.toArray().tolist(), m.intercept],
    },
    "DecisionTreeRegressionModel": {"numNodes": lambda m: m.numNodes, "depth": lambda m: m.depth},
    "RandomForestRegressionModel": {"numTrees": lambda m: m.getNumTrees, "totalNumNodes": lambda m: m.totalNumNodes},
    "RandomForestClassificationModel": {"numTrees": lambda m: m.getNumTrees, "totalNumNodes": lambda m: m.totalNumNodes},
    "GBTRegressionModel": {"numTrees": lambda m: m.getNumTrees, "treeWeights": lambda m: list(m.treeWeights)},
}


def learned(model: PipelineModel) -> dict[str, str]:
    """What each stage of a fitted pipeline learned, as ``position.stage.name`` and text; labels of a
    ``LabelRanker`` are a table and not among them."""
    return {
        f"{i}.{type(stage).__name__}.{name}": str(read(stage))
        for i, stage in enumerate(model.stages)
        for name, read in _LEARNED.get(type(stage).__name__, {}).items()
    }
