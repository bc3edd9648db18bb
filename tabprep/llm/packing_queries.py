"""Packing of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.packing import pack_documents

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(*COLUMNS)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack_documents(table(spark, sf_dir, "documents")))


QUERIES = {"op6_packing": op6_packing}
ORACLES: dict[str, str] = {}
