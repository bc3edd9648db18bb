"""Boosting over counted cells against Spark's over all rows."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import boosting, evaluate, features, models

ROLES = ColumnRoles(["k"], ["x", "z"])


@pytest.fixture(scope="module")
def data(spark):
    """40 categories, some missing, 60 and 17 values in bins of their own, noise."""
    i = F.col("id")
    noise = (F.xxhash64(i) % 1000) / 1000.0
    df = spark.range(3000).select(
        "id",
        F.when(i % 13 > 0, F.concat(F.lit("k"), (i % 40).cast("string"))).alias("k"),
        F.when(i % 13 > 0, ((i * 37) % 60).cast("double")).alias("x"),
        ((i * 11) % 17).cast("double").alias("z"),
        ((i % 40) * 2 + F.when((i * 37) % 60 > 30, 30.0).otherwise(0.0) + noise).alias("y"),
    )
    return df.cache()


def _scores(model, df):
    return {r["id"]: r["prediction"] for r in models.score(model, df).collect()}


def test_boosting_over_cells_scores_like_boosting_over_rows(data, root):
    boosted = models.boosted_trees("y", maxIter=6, maxDepth=5)
    found = models.fit_trees(data, ROLES, boosted)
    encoded = models.encode(data, ROLES)
    every = encoded.with_model(boosted.fit(encoded.frame))
    want = _scores(every, data)
    assert _scores(found, data) == pytest.approx(want, rel=1e-9) and len(want) < 2800
    assert isinstance(found.stages[-1], GBTRegressionModel) and models.learned(found) == models.learned(every)
    assert models.estimator_params(found) == models.estimator_params(every)
    again = models.load_model(models.save_model(found, f"{root}/model"))
    assert _scores(again, data) == pytest.approx(want, rel=1e-9)
    assert models.feature_importances(found, data).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_rounds_run_no_jobs_of_their_own(spark, data):
    """Spark's boosting has a job and more for every level of every round."""
    context, jobs = spark.sparkContext, []
    for rounds in (3, 30):
        context.setJobGroup(f"rounds-{rounds}", "boosting")
        models.fit_trees(data, ROLES, models.boosted_trees("y", maxIter=rounds))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] < 60


def test_many_values_are_put_in_bins_of_all_rows_on_any_layout(spark):
    i = F.col("id")
    x = F.pmod(F.xxhash64(i), F.lit(100_000)).cast("double")
    df = spark.range(20_000).select("id", x.alias("x"), F.lit(1.0).alias("one"), (i % 90).alias("w"))
    df = df.withColumn("y", F.sqrt("x") + F.when(F.col("w") > 50, 40.0).otherwise(0.0))
    roles = ColumnRoles([], ["x", "one", "w"])
    edges = boosting.bin_edges(df, roles.numeric, 64)
    assert len(edges["x"]) == 63 and edges["one"] == [] and 60 <= len(edges["w"]) <= 63
    rank = df.agg(*[F.avg((F.col("x") <= e).cast("double")) for e in edges["x"]]).first()
    assert list(rank) == pytest.approx([k / 64 for k in range(1, 64)], abs=1e-3)
    boosted = models.boosted_trees("y", maxIter=20)
    first, second = (_scores(models.fit_trees(d, roles, boosted), df) for d in (df, df.repartition(5, "w")))
    assert first == pytest.approx(second, rel=1e-9)
    plain = features.assembler_stage(roles.numeric).transform(df)
    r2 = [evaluate.regression_metrics(d, "y").first()["r2"] for d in (
        models.score(models.fit_trees(df, roles, boosted), df), boosted.fit(plain).transform(plain))]
    assert r2[0] > 0.95 and r2[0] == pytest.approx(r2[1], abs=5e-3)


def test_bins_end_with_their_bound(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 1.5, float("inf"), float("-inf"))], "x double")
    got = {r["x"]: r["b"] for r in boosting.add_bins(df, {"x": [0.0, 1.0]}, ["b"]).collect()}
    assert got == {-1.0: 0, 0.0: 0, 0.5: 1, 1.0: 1, 1.5: 2, float("inf"): 2, float("-inf"): 0}


@pytest.mark.parametrize("column", ["z", "y"])
@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_numbers_and_labels_are_errors(data, column, bad):
    broken = data.withColumn(column, F.when(F.col("id") == 8, F.lit(bad).cast("double")).otherwise(F.col(column)))
    with pytest.raises(Exception, match="(?i)missing"):
        models.fit_trees(broken, ROLES, models.boosted_trees("y", maxIter=2))


def test_cells_only_where_they_are_enough_and_fit_a_task(data, monkeypatch):
    for params in ({"subsamplingRate": 0.5}, {"lossType": "absolute"}, {"featureSubsetStrategy": "sqrt"}, {"minInstancesPerNode": 2}, {"weightCol": "x"}):
        assert not boosting.learns_from_cells(ROLES, models.boosted_trees("y", **params))
    boosted = models.boosted_trees("y", maxIter=3)
    assert boosting.learns_from_cells(ROLES, boosted) and not boosting.learns_from_cells(ROLES, models.forest_regressor("y"))
    want = _scores(models.fit_trees(data, ROLES, boosted), data)
    monkeypatch.setattr(boosting, "CELLS_MOST", 10)
    assert _scores(models.fit_trees(data, ROLES, boosted), data) == pytest.approx(want, rel=1e-9)


def test_features_counted_together_have_the_sums_of_each():
    rng = np.random.default_rng(1)
    kinds = [boosting.Feature((), 3), boosting.Feature(list(range(10))), boosting.Feature(()), boosting.Feature((), 50)]
    codes = boosting.Codes(np.stack([rng.integers(0, f.bins, 500) for f in kinds]), kinds)
    slot, value = rng.integers(0, 4, 500), rng.random(500)
    found = codes.histograms(slot, 3, [value])
    assert sorted(found) == [0, 1, 3] and codes.groups(4) == [(0, 1, 3)] and len(codes.groups(200)) == 2
    for f, (sums,) in found.items():
        want = np.zeros((4, kinds[f].bins))
        np.add.at(want, (slot, codes.codes[f]), value)
        assert sums == pytest.approx(want[:3])
