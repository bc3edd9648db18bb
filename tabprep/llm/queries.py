"""The registered queries of this subpackage, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm import (
    hamming_queries,
    html_queries,
    lm_queries,
    mixing_queries,
    neighbour_queries,
    packing_queries,
    pii_queries,
    quality_queries,
    run_queries,
    simhash_queries,
    substring_queries,
    url_queries,
    whitening_queries,
)

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (url_queries, neighbour_queries, html_queries, lm_queries, substring_queries, packing_queries, pii_queries, simhash_queries, quality_queries, mixing_queries, run_queries, whitening_queries, hamming_queries)

QUERIES: dict[str, Query] = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
