"""Small pieces shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted`` with as many underscores as it takes not to clash (names are caseless)."""
    names = {t.lower() for t in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def free_names(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [free_name(df.columns, w) for w in wanted]
