"""Train, validation and test parts, and folds."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import digest_below, key_digest

SEED = 42


def _label(keys: Sequence[str], seed: int | str, labels: Sequence, bounds: Sequence[float]) -> Column:
    """The first label whose cumulative bound lies above the row's hash share."""
    digest = key_digest([F.col(k) for k in keys], seed)
    label = F.lit(labels[-1])
    for name, bound in reversed(list(zip(labels[:-1], bounds[:-1]))):
        label = F.when(digest_below(digest, bound), F.lit(name)).otherwise(label)
    return label


def assign_parts(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    seed: int = SEED,
    column: str = "part",
) -> DataFrame:
    """Name the part of every row by hashing its keys: no shuffle, and the same answer in every run.

    Rows that share all keys land in one part, so choose keys that tell rows
    apart unless copies should stay together.
    """
    if len(weights) != len(names):
        raise ValueError("one weight per part name")
    total = sum(weights)
    bounds = [edge / total for edge in accumulate(weights)]
    return df.withColumn(column, _label(keys, seed, names, bounds))


def split_parts(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    seed: int = SEED,
) -> list[DataFrame]:
    """The parts as separate frames."""
    marked = assign_parts(df, keys, weights, names, seed, "_part")
    return [marked.filter(F.col("_part") == name).drop("_part") for name in names]


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = SEED) -> list[DataFrame]:
    """Spark's own split. It depends on how the input is partitioned; prefer ``split_parts``."""
    return df.randomSplit(list(weights), seed)


def assign_folds(
    df: DataFrame, keys: Sequence[str], folds: int = 3, seed: int = SEED, column: str = "fold"
) -> DataFrame:
    """A fold number from 0 per row.

    The seed is told apart from that of ``assign_parts``: folds of a train part
    would otherwise be unequal, because the part fixed the same hash already.
    """
    bounds = [(i + 1) / folds for i in range(folds)]
    return df.withColumn(column, _label(keys, f"{seed}-fold", list(range(folds)), bounds))
