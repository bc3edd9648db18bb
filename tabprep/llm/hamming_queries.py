"""Near-duplicate classes of ``documents`` by shingles of two words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.common import UPPER, table
from tabprep.llm.hamming import near_duplicate_classes


def op12_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


_SQL = f"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT r, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
    FROM (SELECT r, w, unnest(range(1, greatest(2, len(w)))) AS i FROM docs WHERE len(w) > 0)
), sizes AS MATERIALIZED (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.r AS a, y.r AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r
    ) JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * common >= 80 * (p.n + q.n - common)
), reached AS (
    SELECT r AS a, r AS b FROM docs UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
    SELECT reached.a AS r, min(docs.doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.b GROUP BY reached.a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

QUERIES = {"op12_hamming_join": op12_hamming_join}
ORACLES = {"op12_hamming_join": _SQL}
