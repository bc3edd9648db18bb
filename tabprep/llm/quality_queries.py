"""Quality rules over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.common import table
from tabprep.llm.quality import STOP_WORDS, judge_quality

COLUMNS = (
    "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
).split()


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*COLUMNS)


_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), base AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM docs
), starts AS (
    SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM base)
), doubled AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM starts) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + j) AS n FROM doubled, (SELECT unnest(range(0, 5)) AS j) GROUP BY r
), counts AS (
    SELECT b.r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            IN ({", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))}))) AS n_stop, len(lines) AS n_lines
    FROM base b LEFT JOIN covered c ON c.r = b.r
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR word_chars / n_words < 1.5 OR word_chars / n_words > 20 OR n_symbols / n_words > 0.25
        OR (n_words >= 50 AND n_stop / n_words < 0.02) OR n_dup_lines / n_lines > 0.5) AS kept
FROM judged
"""

QUERIES = {"op9_quality": op9_quality}
ORACLES = {"op9_quality": _SQL}
