"""From raw documents to packed sequences, by five of the operators in ``tabprep.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.mixing import Level, default_levels, mix_sources
from tabprep.llm.packing import pack_documents
from tabprep.llm.packing_queries import digest
from tabprep.llm.pii import find_personal_data
from tabprep.llm.quality import judge_quality
from tabprep.llm.simhash import drop_near_duplicates
from tabprep.session import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return judge_quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind in brackets in place of each span of personal data."""
    found = find_personal_data(docs.select(*COLUMNS))
    return found.withColumns({"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix; those of a leaf that is to be repeated come once an epoch."""
    levels = [Level(f"mix_{x.name}", x.value, x.weights, x.other) for x in default_levels()]
    return mix_sources(docs.select(*COLUMNS), levels).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return digest(pack_documents(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", packing),
]

#: Fingerprints and subword ids have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
