"""Registered queries against SQL, and a lean contract of their columns."""

import pytest

import __spark_entry__ as contract
from tabprep.llm.queries import ORACLES, QUERIES
from tests import oracle

COLUMNS = {
    "op1": "page_id host path rule verdict",
    "op2": "query_id rank vec_id score",
    "op3": "page_id url text n_chars",
    "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8": "doc_id fingerprint component_id",
    "op9": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op11": "vec_id component n deviation whitened explained identity_error",
    "op12": "doc_id n_shingles component_id kept",
    "op10": "doc_id domain lang source epoch n_tokens",
}


def test_every_operator_is_registered_once():
    found = sorted(name.split("_")[0] for name in QUERIES)
    assert found == sorted(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.columns == COLUMNS[name.split("_")[0]].split()
    assert oracle.differences(df, oracle.connect(folder), ORACLES[name]) == []


@pytest.mark.parametrize("name", ["op2_neighbours", "op3_html_main_text", "op6_packing", "op7_pii"])
def test_columns_of_the_others(spark, folder, name):
    assert QUERIES[name](spark, folder).columns == COLUMNS[name.split("_")[0]].split()
