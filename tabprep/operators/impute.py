"""Replace missing values (null and NaN) by a statistic of the column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import present
from tabprep.operators.clean import fill_constants
from tabprep.operators.quantiles import exact_quantiles


def _fill(df: DataFrame, values: Mapping[str, Column], outputs: Mapping[str, str] | None) -> DataFrame:
    names = outputs or {}
    return df.withColumns({names.get(n, n): F.coalesce(present(df, n), v) for n, v in values.items()})


def impute_mean(df: DataFrame, columns: Sequence[str], outputs: Mapping[str, str] | None = None) -> DataFrame:
    """Fill with the mean. All means come from one aggregate, used as a scalar subquery."""
    means = df.agg(F.struct(*[F.avg(present(df, n)).alias(n) for n in columns])).scalar()
    return _fill(df, {n: means.getField(n) for n in columns}, outputs)


def impute_median(df: DataFrame, columns: Sequence[str], outputs: Mapping[str, str] | None = None) -> DataFrame:
    """Fill with the middle element (the lower one of two). Finding it runs jobs; the filling is lazy."""
    medians = exact_quantiles(df, columns, [0.5])
    return _fill(df, {n: F.lit(medians[n][0]).cast("double") for n in columns}, outputs)


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, one column each: the most frequent value, the smallest one on ties.

    Counts are combined per value before the shuffle and the best value of each
    task after it, so no task holds a column.
    """
    pairs = F.array(
        *[F.struct(F.lit(i).alias("position"), present(df, n).cast("double").alias("value")) for i, n in enumerate(columns)]
    )
    counted = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("position", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("candidate", F.struct(F.col("n"), (-F.col("value")).alias("negated")))
    )
    best = [F.max(F.when(F.col("position") == i, F.col("candidate"))) for i in range(len(columns))]
    return counted.agg(*[(-b.getField("negated")).alias(n) for b, n in zip(best, columns)])


def impute_mode(df: DataFrame, columns: Sequence[str], outputs: Mapping[str, str] | None = None) -> DataFrame:
    """Fill with the most frequent value."""
    modes = column_modes(df, columns).select(F.struct(*columns)).scalar()
    return _fill(df, {n: modes.getField(n) for n in columns}, outputs)


def text_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, one column each: the most frequent text, the first in order on ties, null without any."""
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.col(n).alias("value")) for i, n in enumerate(columns)])
    counted = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("position", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.struct((-F.col("n")).alias("n"), "value")
    best = [F.min(F.when(F.col("position") == i, rank)).getField("value").alias(n) for i, n in enumerate(columns)]
    return counted.agg(*best)


def impute_text_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing text with the most frequent text of its column."""
    modes = text_modes(df, columns).select(F.struct(*columns)).scalar()
    return df.withColumns({n: F.coalesce(F.col(n), modes.getField(n)) for n in columns})


def impute_category(df: DataFrame, columns: Sequence[str], category: str = "absent") -> DataFrame:
    """Give missing categories a category of their own."""
    return fill_constants(df, {n: category for n in columns})


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_constants(df, {n: 0.0 for n in columns})


def imputer_stage(columns: Sequence[str], strategy: str = "mean", outputs: Sequence[str] | None = None) -> Imputer:
    """The same as a pipeline stage; its median is approximate (relative error 0.001)."""
    return Imputer(strategy=strategy, inputCols=list(columns), outputCols=list(outputs or columns))
