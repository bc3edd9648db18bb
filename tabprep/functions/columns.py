"""Choosing columns by type, and null or NaN handling that fits the type."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns feed a model, and how."""

    categorical: list[str]
    numeric: list[str]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Every column of any numeric type, in schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Every string column, in schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def column_roles(df: DataFrame, labels: Sequence[str] = (), exclude: Sequence[str] = ()) -> ColumnRoles:
    """String columns are categories, numeric ones are features; labels are left out."""
    skip = {*labels, *exclude}
    return ColumnRoles(string_columns(df, skip), numeric_columns(df, skip))


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN where the type has it."""
    column = F.col(name)
    return (column.isNull() | F.isnan(column)) if _is_floating(df, name) else column.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value with NaN turned into null."""
    column = F.col(name)
    return F.nanvl(column, F.lit(None).cast("double")) if _is_floating(df, name) else column
