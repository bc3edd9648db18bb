"""Main text of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.html_main import extract_main_text


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_main_text(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op3_html_main_text": op3_html_main_text}
ORACLES: dict[str, str] = {}
