"""Whitened ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.common import table
from tabprep.llm.whitening import whiten


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_whitening": op11_whitening}
ORACLES: dict[str, str] = {}
