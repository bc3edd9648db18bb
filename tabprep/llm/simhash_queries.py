"""SimHash groups of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.common import table
from tabprep.llm.simhash import group_near_duplicates


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLES: dict[str, str] = {}
