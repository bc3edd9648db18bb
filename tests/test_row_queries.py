"""Properties of models and searches that SQL cannot express."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tabprep.functions.columns import ColumnRoles
from tabprep.operators import evaluate, impute, models, tune

QUERIES = contract.queries()


def learnable(spark):
    x = F.col("id") % 97
    return spark.range(4000).select(
        F.concat(F.lit("k"), (F.col("id") % 5).cast("string")).alias("k"), x.cast("double").alias("x"), (x * x + F.col("id") % 5).alias("y")
    )


def test_forest_does_not_depend_on_the_layout(spark):
    df = learnable(spark)
    forest = models.forest_regressor("y", numTrees=5)
    found = {
        models.fit_trees(rows, ColumnRoles(["k"], ["x"]), forest).stages[-1].toDebugString.split("\n", 1)[1]
        for rows in (df.coalesce(1), df.repartition(13, "x"), df.orderBy(F.desc("x")))
    }
    assert len(found) == 1


def test_parameters_are_listed_once(spark, folder):
    keys = [r["key"] for r in QUERIES["estimator_params"](spark, folder).collect()]
    assert len(keys) == len(set(keys))
    assert "3.LinearRegressionModel.regParam" in keys


def test_a_loss_that_is_no_number_never_wins(spark):
    space = {"a": tune.Uniform(0, 1)}
    losses = iter([math.nan, 3.0, 2.0, math.inf, 4.0])
    found = tune.search(spark, space, lambda point: next(losses), 5, parallelism=1)
    rows = {r["trial"]: r for r in found.trials.collect()}
    assert len(rows) == 5 and found.best == {"a": rows[2]["a"]}
    assert tune.search(spark, space, lambda point: math.nan, 2).best == {}
    assert tune.search(spark, space, lambda point: 1.0, 0).trials.count() == 0
    results = spark.createDataFrame([(0, math.nan), (1, 0.5), (2, None)], "combination int, m double")
    assert tune.best_row(results, "m", True, "combination").first()["combination"] == 1


def test_parameters_keep_their_type(spark):
    boosted = tune.with_params(models.boosted_trees("y"), {"maxIter": 3.0, "stepSize": 1.0})
    assert boosted.getMaxIter() == 3 and isinstance(boosted.getStepSize(), float)


def test_missing_labels_are_not_measured(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (math.nan, 1.0), (None, 1.0), (2.0, math.nan)], "y double, p double")
    (row,) = evaluate.regression_metrics(df, "y", "p").collect()
    assert row["n_rows"] == 2 and row["rmse"] == pytest.approx(math.sqrt(0.5))
    (first, *_) = evaluate.add_baselines(df, df, "y").collect()
    assert (first["mean_prediction"], first["median_prediction"]) == (2.0, 2.0)


def test_mode_of_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "k string")
    assert sorted(r["k"] for r in impute.impute_text_mode(df, ["k"]).collect()) == ["a", "a", "a", "b", "b"]
