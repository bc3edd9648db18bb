"""What the physical plans of the queries may and must hold."""

import re

import pytest

import __spark_entry__ as contract
from tabprep.plans import (
    cleaning_queries,
    feature_queries,
    model_queries,
    profile_queries,
    registry_queries,
    scan_queries,
    search_queries,
    tracking_queries,
    tuning_queries,
)

QUERIES = contract.queries()
MODULES = (
    cleaning_queries,
    feature_queries,
    model_queries,
    profile_queries,
    registry_queries,
    scan_queries,
    search_queries,
    tracking_queries,
    tuning_queries,
)
#: Fits of minutes; what they return are a few rows made on the driver or read from a log.
SLOW = {"search_trials", "search_boosting", "cv_estimator", "gbt_regression", "cv_pipeline", "rf_classification"}
NAMES = sorted(n for n, q in QUERIES.items() if q.__module__ in {m.__name__ for m in MODULES} and n not in SLOW)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert [f for f in FORBIDDEN if f in plan] == []
    # The only windows run over one row per sort partition, and over the lines of one split of a file.
    assert name in ("string_index_wide", "string_index_wide_split", "csv_quoted_splits") or "Window" not in plan


NARROW = [
    "select_columns",
    "clean_currency",
    "filter_price_range",
    "missing_flags",
    "label_binarize",
    "repair_ssn",
    "anonymize",
    "drop_nulls",
    "split_train_val_test",
    "kfold_assign",
    "impute_median",
    "one_hot",
]


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, folder, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", ["dedup_rows", "employee_pipeline"])
def test_deduplication_shuffles_once(spark, folder, name):
    assert plan_of(QUERIES[name](spark, folder)).count("Exchange hashpartitioning") == 1


def test_scans_read_only_what_is_used(spark, folder):
    plan = plan_of(QUERIES["select_columns"](spark, folder))
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert [c.split(":")[0] for c in read.split(",")] == [
        "l_orderkey",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
    ]


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["filter_sql_string"](spark, folder))
    pushed = plan[plan.index("PushedFilters: ") :]
    assert "LessThan(o_totalprice,250000.0)" in pushed and "Not(EqualTo(" in pushed


@pytest.mark.parametrize("name", ["topk_generic", "limit_example"])
def test_top_rows_are_not_fully_sorted(spark, folder, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, folder))
