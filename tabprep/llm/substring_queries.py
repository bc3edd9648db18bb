"""Substring deduplication of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.substrings import remove_repeated


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
    SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs)
), repeated AS (
    SELECT r, i FROM starts WHERE g IN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1)
), gone AS (
    SELECT r, list(DISTINCT i + j) AS places, count(DISTINCT i + j) AS n
    FROM repeated, (SELECT unnest(range(0, 35)) AS j) GROUP BY r
), words AS (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM docs
), lost AS (
    SELECT r, unnest(places) AS k FROM gone
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN lost USING (r, k) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLES = {"op5_substring_dedup": _SQL}
