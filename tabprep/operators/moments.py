"""Linear models from sufficient statistics: one scan serves every fold, every penalty and the final fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import present
from tabprep.operators.tune import grid_points
from tabprep.sources.tables import rows_frame

#: Columns whose products one aggregate holds; more would make it too wide to compile.
MOST_COLUMNS = 60


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred cross-products of some columns, the label last. They add up."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        """Moments of both row sets: the between-means part is added, so nothing large cancels."""
        if not self.n or not other.n:
            return other if not self.n else self
        n, apart = self.n + other.n, other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        return Moments(n, mean, self.scatter + other.scatter + np.outer(apart, apart) * (self.n * other.n / n))

    @property
    def covariance(self) -> np.ndarray:
        return self.scatter / self.n


@dataclass(frozen=True)
class LinearFit:
    """A fitted line over named columns."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        """The prediction as an expression of the features."""
        terms = [F.col(f"`{name}`") * F.lit(float(c)) for name, c in zip(self.features, self.coefficients)]
        return sum(terms, F.lit(float(self.intercept)))

    def measures(self, held: Moments) -> dict[str, float]:
        """Measures on rows of which only the moments are known."""
        w, cov = np.append(-self.coefficients, 1.0), held.covariance
        bias = held.mean @ w - self.intercept
        mse = max(0.0, float(w @ cov @ w + bias * bias))
        spread = float(cov[-1, -1])
        return {"mse": mse, "rmse": mse**0.5, "r2": 1 - mse / spread if spread else float("nan")}


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, Moments]:
    """Moments of features and label by fold, in one scan and one combined aggregate.

    Rows with a missing feature, label or fold are left out. The driver gets one row per fold.
    """
    columns = [*features, label]
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"{len(columns)} columns; moments are for {MOST_COLUMNS} at most")
    names = [f"x{i}" for i in range(len(columns))]
    rows = df.select(F.col(fold).alias("fold"), *[present(df, c).cast("double").alias(n) for c, n in zip(columns, names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    found = rows.na.drop().groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(n) for n in names]).alias("mean"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).alias("covariance"),
    )
    out = {}
    for row in found.collect():
        cov = np.zeros((len(names), len(names)))
        for (i, j), value in zip(pairs, row["covariance"]):
            cov[i, j] = cov[j, i] = value
        out[row["fold"]] = Moments(row["n"], np.array(row["mean"]), cov * row["n"])
    return out


def solve(moments: Moments, features: Sequence[str], penalty: float = 0.0, standardize: bool = True) -> LinearFit:
    """Ridge regression from moments, with the penalty's meaning in ``LinearRegression``.

    There it acts on a label of unit spread, and with ``standardize`` on features of unit spread.
    Columns that depend on each other share their weight; a constant one gets none.
    """
    cov = moments.covariance
    c, xy, spread = cov[:-1, :-1], cov[:-1, -1], float(np.sqrt(cov[-1, -1]))
    own = np.diag(c) if standardize else np.where(np.diag(c) > 0, 1.0, 0.0)
    scale = np.where(np.diag(c) > 0, np.sqrt(np.diag(c)), 1.0)
    system = c + np.diag(own) * (penalty / spread if spread else 0.0)
    w = np.linalg.lstsq(system / np.outer(scale, scale), xy / scale, rcond=1e-12)[0] / scale
    return LinearFit(tuple(features), w, float(moments.mean[-1] - w @ moments.mean[:-1]))


@dataclass(frozen=True)
class LinearFolds:
    """Measures of every point of a grid, and the fit of the best one on all rows."""

    results: DataFrame
    best: dict
    fit: LinearFit


def cross_validate_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    values: Mapping[str, Sequence],
    fold: str = "fold",
    metric: str = "rmse",
) -> LinearFolds:
    """Cross-validate ridge regressions over a grid of ``regParam`` and ``standardization``.

    Each fold is held out once; the train side of it is the sum of the other folds' moments.
    All fits and all measures come from these, so the data is read once, whatever the grid.
    ``results`` has the columns of ``tune.cv_results``; of equal points the first is the best.
    """
    unknown = set(values) - {"regParam", "standardization"}
    if unknown or metric not in ("rmse", "mse", "r2"):
        raise ValueError(f"no closed form for {sorted(unknown) or metric}")
    by_fold = fold_moments(df, features, label, fold)
    if len(by_fold) < 2:
        raise ValueError("at least two folds with complete rows are needed")
    trains = {k: reduce(Moments.__add__, [m for j, m in sorted(by_fold.items()) if j != k]) for k in sorted(by_fold)}

    def fitted(moments: Moments, point: Mapping) -> LinearFit:
        return solve(moments, features, point.get("regParam", 0.0), bool(point.get("standardization", True)))

    points = grid_points(values)
    measured = [[fitted(trains[k], p).measures(by_fold[k])[metric] for k in trains] for p in points]
    schema = T.StructType(
        [T.StructField("combination", T.IntegerType())]
        + [T.StructField(n, T.DoubleType()) for n in [*values, "avg_metric", "std_metric"]]
    )
    rows = [(i, *[float(v) for v in p.values()], float(np.mean(m)), float(np.std(m))) for i, (p, m) in enumerate(zip(points, measured))]
    order = [(-r[-2] if metric == "r2" else r[-2], r[0]) for r in rows]
    best = points[min(range(len(rows)), key=order.__getitem__)]
    whole = reduce(Moments.__add__, [by_fold[k] for k in sorted(by_fold)])
    return LinearFolds(rows_frame(df.sparkSession, rows, schema), best, fitted(whole, best))
