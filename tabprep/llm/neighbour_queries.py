"""Nearest neighbours in ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.neighbours import nearest_neighbours


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op2_neighbours": op2_neighbours}
ORACLES: dict[str, str] = {}
