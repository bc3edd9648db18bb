"""Mixing of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.mixing import mix_sources


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "domain", "lang", "source", F.col("epoch").cast("long").alias("epoch"), "n_tokens")


def _level(name: str, parents: str, nodes: str, budgets: str, weight: str) -> str:
    """Water-filling of one level, as in the operator, for a table of nodes and one of parents' budgets."""
    return f"""
{name}_nodes AS (
    SELECT {parents}, {name} AS node, sum(capacity) AS capacity, any_value({weight}) AS weight FROM leaves GROUP BY ALL
), {name}_full AS (
    SELECT n.*, budget, capacity * sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= (budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled
    FROM {name}_nodes n JOIN {budgets} USING ({parents})
    WINDOW w AS (PARTITION BY {parents} ORDER BY capacity / weight, node)
), {name}_budget AS (
    SELECT {parents}, node AS {name}, CASE WHEN filled THEN capacity ELSE
        ((budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER (PARTITION BY {parents})) * weight)
        // sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {parents}) END AS budget
    FROM {name}_full
)"""


_SQL = f"""
WITH docs AS (
    SELECT doc_id, CASE WHEN TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) < 10 THEN 'web' ELSE 'library' END AS domain,
        coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
    FROM documents
), leaves AS (
    SELECT 0 AS tree, domain, lang, source, sum(n_tokens) AS tokens, 2 * sum(n_tokens) AS capacity FROM docs GROUP BY ALL
), top_budget AS (
    SELECT 0 AS tree, least(sum(tokens) * 4 // 5, sum(capacity)) AS budget FROM leaves
), {_level("domain", "tree", "leaves", "top_budget", "CASE domain WHEN 'web' THEN 60 ELSE 40 END")},
{_level("lang", "tree, domain", "leaves", "domain_budget",
        "CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 5 END")},
{_level("source", "tree, domain, lang", "leaves", "lang_budget", "1")}, plan AS (
    SELECT domain, lang, source, coalesce(budget // nullif(tokens, 0), 2) AS whole,
        coalesce(budget % nullif(tokens, 0), 0) AS rest
    FROM leaves JOIN source_budget USING (domain, lang, source)
), keyed AS (
    SELECT d.*, whole, rest, md5('7:' || CAST(whole AS BIGINT) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM docs d JOIN plan USING (domain, lang, source)
), upto AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed
)
SELECT doc_id, domain, lang, source, CAST(e AS BIGINT) AS epoch, n_tokens
FROM upto, (SELECT unnest(range(0, 2)) AS e) WHERE e < whole OR (e = whole AND upto <= rest)
"""

QUERIES = {"op10_mixing": op10_mixing}
ORACLES = {"op10_mixing": _SQL}
