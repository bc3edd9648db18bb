"""Formulas over columns with any number of labels: label tables are joined, and features are sparse."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators.features import WideIndex

_TERM = re.compile(r"\s*([+-]?)\s*([^\s+~-]+)")


def formula_columns(formula: str, columns: Sequence[str]) -> tuple[str, list[str]]:
    """(label, features) of ``label ~ a + b`` or ``label ~ . - c``; a dot is all columns but the label."""
    label, found, right = (part.strip() for part in formula.partition("~"))
    if not found or not label or not right or re.search(r"[:*^()]", right):
        raise ValueError(f"only sums of columns are formulas here: {formula!r}")
    chosen: list[str] = []
    for sign, name in _TERM.findall(right):
        named = [c for c in columns if c != label] if name == "." else [name]
        if missing := [c for c in named if c not in columns]:
            raise ValueError(f"no column {missing[0]!r}")
        chosen = [c for c in chosen if c not in named] + (named if sign != "-" else [])
    return label, chosen


@dataclass(frozen=True)
class WideFormula:
    """A fitted formula. Labels are kept as tables of (label, index), not on the driver nor in tasks.

    Features are those of ``formula_stage``: strings as 0/1 slots by falling frequency, the last
    label all zeros, and numbers as they are; in the order of the formula.
    """

    label: str
    features: tuple[str, ...]
    indexes: dict[str, WideIndex]
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, formula: str, path: str) -> WideFormula:
        """Count and rank the labels of each string column and write them below ``path``, a shared folder.

        Rows without a label are left out from one column to the next, as ``skip`` does in a formula.
        """
        label, names = formula_columns(formula, df.columns)
        text = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
        indexes, rows = {}, df
        for i, c in enumerate(text):
            indexes[c] = WideIndex.fit(rows, c, f"{path}/{i}")
            rows = rows.where(F.col(c).isNotNull())
        sizes = {c: index.labels(df.sparkSession).count() for c, index in indexes.items()}
        return cls(label, tuple(names), indexes, sizes)

    def transform(self, df: DataFrame, output: str = "features", label: str = "label") -> DataFrame:
        """``df`` with ``output`` and, if it has the label, ``label``; rows with null or unseen labels are left out.

        One join a string column, each of whose sides has a label once. Slots carry numbers and
        no label names, so the schema stays small whatever the labels are.
        """
        kept = df.columns
        if output in self.features:
            raise ValueError(f"{output!r} is a feature")
        df = df.drop(output)
        for name, index in self.indexes.items():
            df = index.transform(df, "skip")
            count = {"ml_attr": {"type": "nominal", "num_vals": self.sizes[name]}}
            df = df.withColumn(index.output, F.col(index.output).alias(index.output, metadata=count))
        if self.indexes:
            inputs = [i.output for i in self.indexes.values()]
            slots = {c: f"{i.output}_slots" for c, i in self.indexes.items()}
            df = OneHotEncoder(inputCols=inputs, outputCols=list(slots.values())).fit(df).transform(df)
        else:
            slots = {}
        df = VectorAssembler(inputCols=[slots.get(c, c) for c in self.features], outputCol=output, handleInvalid="skip").transform(df)
        columns = [F.col(f"`{c}`") for c in kept if c not in (output, label)] + [F.col(output)]
        if self.label in kept:
            columns.append(F.col(f"`{self.label}`").cast("double").alias(label))
        return df.select(*columns)
