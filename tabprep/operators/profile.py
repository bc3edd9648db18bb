"""Typed profiles of a table: one aggregate per profile, results as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import missing, numeric_columns, present, string_columns
from tabprep.operators.quantiles import median, quantiles_beside
from tabprep.sources.tables import rows_frame


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, most frequent first, then by key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), F.asc(key))


def _unpivot(one_row: DataFrame, columns: Sequence[str], parts: dict[str, str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"{prefix}{i}").alias(out) for out, prefix in parts.items()],
        )
        for i, name in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n, mean, stddev, min_value, max_value) as numbers; null and NaN do not count."""
    names = list(columns) if columns else numeric_columns(df)
    parts: list[Column] = []
    for i, n in enumerate(names):
        v = present(df, n).cast("double")
        parts += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"sd{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
    layout = {"n": "n", "mean": "mean", "stddev": "sd", "min_value": "lo", "max_value": "hi"}
    return _unpivot(df.agg(*parts), names, layout)


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n, min_text, max_text) of string columns."""
    names = list(columns) if columns else string_columns(df)
    parts: list[Column] = []
    for i, n in enumerate(names):
        c = F.col(n)
        parts += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    return _unpivot(df.agg(*parts), names, {"n": "n", "min_text": "lo", "max_text": "hi"})


_SUMMARY = T.StructType(
    [T.StructField("column_name", T.StringType()), T.StructField("n", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("mean", "stddev", "min_value", "max_value", "q25", "q50", "q75")]
)


def _moments(values: Column) -> Column:
    """(n, mean, squares) of a value: rows, mean and squared distance from it, of a group of partitions."""
    n = F.count(values)
    return F.struct(n.alias("n"), F.coalesce(F.avg(values), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(values) * n, F.lit(0.0)).alias("squares"))


def _merge_moments(parts: Column) -> Column:
    """The moments of all groups from those of each; nothing large cancels."""

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart, part = b["mean"] - a["mean"], F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
        squares = a["squares"] + b["squares"] + apart * apart * a["n"] * part
        return F.struct(n.alias("n"), (a["mean"] + apart * part).alias("mean"), squares.alias("squares"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    return F.aggregate(parts, none, add)


def summarize(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``describe_numeric`` with exact quartiles (elements of the column) added.

    Everything but the quartiles comes from the pass that first looks for those.
    """
    names = list(columns) if columns else numeric_columns(df)
    values = [present(df, n).cast("double") for n in names]
    partial = {k: c for i, v in enumerate(values) for k, c in ((f"m{i}", _moments(v)), (f"lo{i}", F.min(v)), (f"hi{i}", F.max(v)))}
    merged = {
        k: c
        for i in range(len(names))
        for k, c in ((f"m{i}", _merge_moments(F.collect_list(f"m{i}"))), (f"lo{i}", F.min(f"lo{i}")), (f"hi{i}", F.max(f"hi{i}")))
    }
    quartiles, found = quantiles_beside(df, names, [0.25, 0.5, 0.75], partial, merged)
    rows = []
    for i, name in enumerate(names):
        n, mean, squares = found[f"m{i}"]
        spread = (squares / (n - 1)) ** 0.5 if n > 1 else None
        rows.append((name, n, mean if n else None, spread, found[f"lo{i}"], found[f"hi{i}"], *quartiles[name]))
    return rows_frame(df.sparkSession, rows, _SUMMARY)


def median_frame(df: DataFrame, column: str) -> DataFrame:
    """The exact median as a one-row frame."""
    schema = T.StructType([T.StructField("median", T.DoubleType())])
    return rows_frame(df.sparkSession, [(median(df, column),)], schema)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_complete, n_missing): missing values per column, and the rows that lack none."""
    names = list(columns) if columns else df.columns
    any_missing = missing(df, names[0])
    for n in names[1:]:
        any_missing |= missing(df, n)
    counts = [F.count_if(missing(df, n)).alias(f"n{i}") for i, n in enumerate(names)]
    one_row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~any_missing).alias("n_complete"), *counts)
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("n_missing")) for i, n in enumerate(names)]
    return one_row.select("n_rows", "n_complete", F.inline(F.array(*rows)))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """(bin, low, n_rows) of all equal-width bins between minimum and maximum, empty ones with zero.

    A column of one value fills the first bin; one without values has no bins.
    """
    v = present(df, column).cast("double")
    rows = df.select(v.alias("value")).filter(F.col("value").isNotNull())
    edges = rows.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    lo, hi = F.col("edges.lo"), F.col("edges.hi")
    width = (hi - lo) / F.lit(float(bins))
    index = F.when(hi == lo, F.lit(0)).otherwise(F.floor((F.col("value") - lo) / width))
    counted = (
        rows.withColumn("edges", edges)
        .select(F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counted, "bin", "left")
        .withColumn("edges", edges)
        .filter(lo.isNotNull())
        .select("bin", (lo + F.col("bin") * width).alias("low"), F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))
    )


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows in the given order; only k rows per task are kept."""
    return df.orderBy(*order).limit(k)


def example_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """A few rows as a model input example, the same ones on every run."""
    return top_k(df, n, [F.asc(c) for c in order])
