"""Baselines and quality measures, each from one aggregate over the scored rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import present
from tabprep.operators.quantiles import median


def add_baselines(
    train: DataFrame, test: DataFrame, label: str, mean_column: str = "mean_prediction", median_column: str = "median_prediction"
) -> DataFrame:
    """Predict the train mean and the exact train median for every test row.

    Both are found right away, so ``train`` may be a frame that is only kept for a while.
    """
    mean = train.agg(F.avg(present(train, label))).first()[0]
    values = {mean_column: mean, median_column: median(train, label)}
    return test.withColumns({name: F.lit(value).cast("double") for name, value in values.items()})


def _measures(label: Column, prediction: Column) -> tuple[Column, Column, Column]:
    """Rows, root mean squared error and R2. The spread is Spark's one-pass variance, which stays stable.

    Null and NaN are both missing.
    """
    none = F.lit(None).cast("double")
    label, prediction = (F.nanvl(c.cast("double"), none) for c in (label, prediction))
    both = label.isNotNull() & prediction.isNotNull()
    y = F.when(both, label)
    mse = F.avg(F.when(both, (label - prediction) * (label - prediction)))
    spread = F.var_pop(y)
    return F.count(y), F.sqrt(mse), F.when(spread > 0, 1.0 - mse / spread)


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(n_rows, rmse, r2) over the rows that have both label and prediction."""
    n, rmse, r2 = _measures(F.col(label), F.col(prediction))
    return df.agg(n.alias("n_rows"), rmse.alias("rmse"), r2.alias("r2"))


def regression_metrics_by(df: DataFrame, group: str, label: str, prediction: str = "prediction") -> DataFrame:
    """The same measures per group, such as per part of a split."""
    n, rmse, r2 = _measures(F.col(label), F.col(prediction))
    return df.groupBy(group).agg(n.alias("n_rows"), rmse.alias("rmse"), r2.alias("r2"))


def compare_predictions(df: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """(model, n_rows, rmse, r2) for several prediction columns of one frame, in one pass."""
    parts: list[Column] = []
    for i, column in enumerate(predictions.values()):
        n, rmse, r2 = _measures(F.col(label), F.col(column))
        parts += [n.alias(f"n{i}"), rmse.alias(f"rmse{i}"), r2.alias(f"r2{i}")]
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"n{i}").alias("n_rows"),
            F.col(f"rmse{i}").alias("rmse"),
            F.col(f"r2{i}").alias("r2"),
        )
        for i, name in enumerate(predictions)
    ]
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def log_scale_metrics(df: DataFrame, label: str, log_prediction: str) -> DataFrame:
    """Measures on the original scale for a model of the logarithm."""
    return regression_metrics(df.withColumn("_prediction", F.exp(F.col(log_prediction))), label, "_prediction")


def _counted(df: DataFrame, label: str, score: str) -> DataFrame:
    """(label, score, _weight): equal pairs once, with their number; of a vector the score is that of the second class.

    Pairs are counted before they move, so rows are scored once and those of one score meet as a few.
    """
    value = F.col(score)
    value = vector_to_array(value)[1] if isinstance(df.schema[score].dataType, VectorUDT) else value.cast("double")
    pairs = df.select(F.col(label), value.alias(score)).groupBy(label, score)
    return pairs.agg(F.count(F.lit(1)).cast("double").alias("_weight"))


def _area(counted: DataFrame, label: str, score: str) -> float:
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, weightCol="_weight", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(counted)


def area_under_roc(df: DataFrame, label: str, score: str = "rawPrediction") -> float:
    """Exact area under the curve: every distinct score is a threshold, counted and sorted by Spark."""
    return _area(_counted(df, label, score), label, score)


def roc_frame(df: DataFrame, label: str, score: str = "rawPrediction") -> DataFrame:
    """(n_rows, n_positive, area_under_roc). Equal pairs are counted and kept, so rows are scored once."""
    counted = _counted(df, label, score).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known, high = F.col(label).isNotNull(), F.col(label) == 1
        sums = [F.coalesce(F.sum(F.when(c, F.col("_weight"))), F.lit(0)).cast("long") for c in (known, high)]
        counts = counted.agg(*sums).first()
        area = _area(counted, label, score)
    finally:
        counted.unpersist()
    values = zip(("n_rows", "n_positive", "area_under_roc"), (*counts, float(area)))
    return df.sparkSession.range(1).select(*[F.lit(v).alias(n) for n, v in values])
