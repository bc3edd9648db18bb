"""Categorical indexing, one-hot encoding, vectors and formulas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    RFormula,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles, present
from tabprep.operators.label_ranks import LabelRanker
from tabprep.operators.ranking import global_row_number
from tabprep.session import shared_path


def indexer_stage(columns: Sequence[str], handle_invalid: str = "error") -> StringIndexer:
    """Label to index by falling frequency, then label. ``skip`` drops unseen and null labels."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def fit_indexer(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error") -> StringIndexerModel:
    """A fitted indexer. It holds its labels on the driver and in every task; ``WideIndex`` does not."""
    return indexer_stage(columns, handle_invalid).fit(df)


@dataclass(frozen=True)
class WideIndex:
    """A fitted index of one column with any number of labels, kept as a table of (label, index).

    The index is that of ``indexer_stage``: by falling frequency, then label. Labels are counted
    with map-side combine and ranked by a distributed sort, once. To transform is to join; each
    label is there once, so adaptive execution can split the partition of a hot one.
    """

    path: str
    column: str
    output: str

    @classmethod
    def fit(cls, df: DataFrame, column: str, path: str, output: str | None = None) -> WideIndex:
        """Count and rank the labels of ``df`` and write them to ``path``, a shared folder."""
        counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        ranked = global_row_number(counted, [F.desc("n"), F.asc("label")], "index")
        ranked.select("label", "n", "index").write.mode("overwrite").parquet(path)
        return cls(path, column, output or f"{column}_index")

    def labels(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def transform(self, df: DataFrame, handle_invalid: str = "error") -> DataFrame:
        """``df`` with the index of its labels.

        Unseen and null labels are left out with ``skip``, get the number of labels with ``keep``,
        and fail the query with ``error``.
        """
        if handle_invalid not in ("error", "skip", "keep"):
            raise ValueError(f"handle_invalid is {handle_invalid!r}")
        labels = self.labels(df.sparkSession)
        known = labels.select(F.col("label").alias(self.column), F.col("index").cast("double").alias(self.output))
        if handle_invalid == "skip":
            return df.join(known, self.column)
        found = df.join(known, self.column, "left")
        if handle_invalid == "keep":
            last = labels.agg(F.count(F.lit(1)).cast("double")).scalar()
            other = last
        else:
            other = F.raise_error(F.concat(F.lit(f"unseen label in {self.column}: "), F.coalesce(self.column, F.lit("null")))).cast("double")
        return found.withColumn(self.output, F.coalesce(self.output, other))


def index_wide(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Fit a ``WideIndex`` in the shared folder and apply it; rows without a label are left out."""
    path = shared_path(df.sparkSession, "labels")
    return WideIndex.fit(df, column, path, output).transform(df, "skip")


def one_hot_stage(columns: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """Index columns to 0/1 vectors; the last category is all zeros unless kept."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_onehot" for c in columns],
        dropLast=drop_last,
    )


def assembler_stage(columns: Sequence[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """Concatenate columns into one vector; missing numbers are an error unless told otherwise."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def formula_stage(formula: str, label: str = "label", output: str = "features", handle_invalid: str = "error") -> RFormula:
    """An R formula: strings are indexed and one-hot encoded, numbers pass through."""
    return RFormula(formula=formula, featuresCol=output, labelCol=label, handleInvalid=handle_invalid)


def encoding_stages(
    roles: ColumnRoles,
    one_hot: bool = False,
    handle_invalid: str = "skip",
    output: str = "features",
    ranked: Sequence[str] = (),
    label: str | None = None,
) -> list[Estimator | Transformer]:
    """Stages from raw columns to a feature vector. Trees take bare indexes, linear models one-hot.

    Columns in ``ranked`` become ranks by the mean of ``label`` and need no index.
    """
    narrow = [c for c in roles.categorical if c not in ranked]
    stages: list[Estimator | Transformer] = [
        LabelRanker(inputCol=c, outputCol=f"{c}_rank", labelCol=label) for c in roles.categorical if c in ranked
    ]
    if narrow:
        stages.append(indexer_stage(narrow, handle_invalid))
    if one_hot and narrow:
        stages.append(one_hot_stage(narrow))
    kind = "onehot" if one_hot else "index"
    inputs = [f"{c}_rank" if c in ranked else f"{c}_{kind}" for c in roles.categorical] + roles.numeric
    return [*stages, assembler_stage(inputs, output)]


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names of a vector column, from its metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = [slot for group in groups.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]


def vectors_to_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vector columns as arrays of doubles."""
    return df.withColumns({c: vector_to_array(c) for c in columns})


def add_log(df: DataFrame, source: str, output: str) -> DataFrame:
    """Natural logarithm; null where the value is missing or not positive."""
    value = present(df, source)
    return df.withColumn(output, F.when(value > 0, F.log(value)))


def undo_log(df: DataFrame, source: str, output: str = "prediction") -> DataFrame:
    return df.withColumn(output, F.exp(F.col(source)))
