import time
from threading import Lock

import numpy as np
import pytest
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import evaluate, features, models, tune
from tabprep.operators.label_ranks import LabelRanker, LabelRankerModel, rank_labels
from tabprep.operators.split import assign_folds
from tabprep.sources.tables import kept

ROLES = ColumnRoles(["k"], ["x", "z"])


def test_areas_score_every_row_once(spark):
    """Equal scores are counted where they are, so a model scores each row once; ties count by half."""
    calls = spark.sparkContext.accumulator(0)

    def scored(x: float) -> float:
        calls.add(1)
        return x

    rows = [(float(y), float(s)) for y, s in ((0, 1), (1, 1), (0, 2), (1, 3), (1, 2), (0, 0))] * 50
    score = F.udf(scored, "double")
    df = spark.createDataFrame(rows, "y double, s double").repartition(4).select("y", score("s").alias("s"))
    found = evaluate.roc_frame(df, "y", "s").first()
    assert tuple(found) == (300, 150, pytest.approx(7 / 9)) and calls.value == 300
    vectors = spark.createDataFrame([(y, Vectors.dense(-s, s)) for y, s in rows], ["y", "v"])
    assert evaluate.area_under_roc(vectors, "y", "v") == pytest.approx(7 / 9)


@pytest.fixture(scope="module")
def data(spark):
    """40 categories, a step in x and noise."""
    i = F.col("id")
    noise = (F.xxhash64(i) % 1000) / 1000.0
    df = spark.range(2000).select(
        "id",
        F.concat(F.lit("k"), (i % 40).cast("string")).alias("k"),
        ((i * 37) % 101).cast("double").alias("x"),
        ((i * 11) % 17).cast("double").alias("z"),
        ((i % 40) * 2 + F.when((i * 37) % 101 > 50, 30.0).otherwise(0.0) + noise).alias("y"),
    )
    return df.cache()


def test_line_follows_least_squares(data):
    model = models.fit_stages(data, features.assembler_stage(["x", "z"]), models.linear_regression("y"))
    pdf = data.toPandas()
    a = np.column_stack([pdf.x, pdf.z, np.ones(len(pdf))])
    want = np.linalg.lstsq(a, pdf.y, rcond=None)[0]
    rows = models.coefficients(model, data).orderBy("position").collect()
    assert [r["feature"] for r in rows] == ["x", "z", "(intercept)"]
    assert [r["coefficient"] for r in rows] == pytest.approx(list(want))
    residual = models.score(model, data).select((F.col("y") - F.col("prediction")).alias("e"), "x", "z").toPandas()
    assert abs((residual.e * residual.x).sum()) < 1e-5 and abs(residual.e.sum()) < 1e-6


def test_one_hot_line_names_its_slots(data):
    model = models.fit_linear(data, ROLES, "y")
    rows = models.coefficients(model, data).collect()
    assert len(rows) == 39 + 2 + 1 and rows[0]["feature"].startswith("k_onehot_k")
    train = evaluate.regression_metrics(models.score(model, data), "y").first()
    assert train["n_rows"] == 2000 and 0 <= train["r2"] <= 1


def test_more_categories_than_bins(data):
    """A tree with 32 bins refuses 40 categories; they are ordered by their mean label and the bins stay."""
    plain = models.decision_tree("y", maxBins=32)
    encoded = models.encode(data, ROLES)
    with pytest.raises(Exception, match="maxBins"):
        plain.fit(encoded.frame)
    model = models.fit_trees(data, ROLES, plain)
    assert model.stages[-1].getOrDefault("maxBins") == 32 and isinstance(model.stages[0], LabelRankerModel)
    indexed = models.fit_trees(data, ROLES, models.decision_tree("y", maxBins=40))
    assert not isinstance(indexed.stages[0], LabelRankerModel)
    loss = [evaluate.regression_metrics(models.score(m, data), "y").first()["rmse"] for m in (model, indexed)]
    assert loss[0] < 1.2 * loss[1]


def test_wide_columns_are_told_exactly_near_the_bound(spark):
    i = F.col("id")
    df = spark.range(3000).select((i % 40).cast("string").alias("a"), (i % 41).cast("string").alias("b"), i.cast("string").alias("c"))
    assert models.wide_columns(df, ["a", "b", "c"], 40) == ["b", "c"]
    assert models.wide_columns(df, ["a", "b", "c"], 3000) == [] and models.wide_columns(df, [], 5) == []


def test_ranks_follow_smoothed_means_and_have_a_place_for_unseen_labels(spark):
    nan = float("nan")
    rows = [("a", 10.0)] * 5 + [("b", 0.0)] * 5 + [("c", 5.0), ("d", nan), ("d", None), (None, 90.0), ("e", 5.0)]
    df = spark.createDataFrame(rows, "k string, y double").withColumn("label", F.lit("clash"))
    got = {r["label"]: (r["n"], r["rank"]) for r in rank_labels(df, "k", "y").collect()}
    assert got == {"b": (5, 0), "c": (1, 1), "d": (0, 2), "e": (1, 3), "a": (5, 4)}
    model = LabelRanker(inputCol="k", outputCol="k_rank", labelCol="y").fit(df)
    more = spark.createDataFrame([("a",), ("zz",), (None,)], "k string").withColumn("rank", F.lit(-1))
    assert {(r["k"], r["k_rank"], r["rank"]) for r in model.transform(more).collect()} == {("a", 4.0, -1), ("zz", 1.0, -1), (None, 1.0, -1)}
    empty = LabelRanker(inputCol="k", outputCol="r", labelCol="y").fit(df.limit(0))
    assert {r["r"] for r in empty.transform(more).collect()} == {0.0}


def test_ranks_are_saved_with_a_pipeline_and_fitted_inside_folds(spark, data, root):
    tree = models.decision_tree("y", maxBins=32)
    model = models.fit_trees(data, ROLES, tree)
    models.save_model(model, f"{root}/model")
    want = sorted(r["prediction"] for r in models.score(model, data).collect())
    assert sorted(r["prediction"] for r in models.score(models.load_model(f"{root}/model"), data).collect()) == want
    pipeline = Pipeline(stages=[*features.encoding_stages(ROLES, ranked=["k"], label="y"), tree])
    # A label that only one fold has: ranks learned inside the folds do not know it.
    leak = data.select("k", "x", "z", "y").withColumn("fold", (F.xxhash64("x", "z", "k") % 3 + 3) % 3).withColumn("fold", F.col("fold").cast("int"))
    folded = leak.withColumn("k", F.when(F.col("fold") == 0, F.concat(F.lit("f"), F.col("y").cast("string"))).otherwise(F.col("k")))
    found = tune.cross_validate(folded, pipeline, tune.param_maps(tree, {"maxDepth": [3]}), RegressionEvaluator(labelCol="y"))
    held = folded.where("fold = 0")
    fitted = pipeline.fit(folded.where("fold <> 0"))
    own = evaluate.regression_metrics(models.score(fitted, held), "y").first()["rmse"]
    assert found.avgMetrics[0] > own / 3 * 0.99 and own > 5


class _CountedIndexer(Estimator):
    """An indexer that counts how often it is fitted."""

    fits = 0

    def _fit(self, df):
        type(self).fits += 1
        return features.indexer_stage(["k"], "skip").fit(df)


def test_folds_fit_the_encoding_once_each_and_give_the_same_metrics(spark):
    i = F.col("id")
    df = spark.range(300).select(
        F.concat(F.lit("k"), (i % 7).cast("string")).alias("k"), (i % 11).cast("double").alias("x"),
        (i % 7 * 3 + i % 11).cast("double").alias("y"), (i % 3).cast("int").alias("fold"),
    )
    forest = models.forest_regressor("y")
    pipeline = Pipeline(stages=[_CountedIndexer(), features.assembler_stage(["k_index", "x"]), forest])
    maps = tune.param_maps(forest, {"maxDepth": [1, 4], "numTrees": [2, 3]})
    evaluator = RegressionEvaluator(labelCol="y")
    rows = df.repartition(3, "k").persist()
    found = tune.cross_validate(rows, pipeline, maps, evaluator)
    assert _CountedIndexer.fits == 3 + 1
    plain = CrossValidator(
        estimator=pipeline, estimatorParamMaps=maps, evaluator=evaluator, numFolds=3, foldCol="fold", seed=tune.SEED
    ).fit(rows)
    rows.unpersist()
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, rel=1e-12)
    assert found.stdMetrics == pytest.approx(plain.stdMetrics, rel=1e-9)
    assert found.getEstimatorParamMaps() == maps and found.bestModel.stages[-1].getNumTrees == plain.bestModel.stages[-1].getNumTrees
    with pytest.raises(Exception, match="Fold number must be in range"):
        tune.cross_validate(df.withColumn("fold", F.lit(3)), pipeline, maps, evaluator)
    with pytest.raises(ValueError, match="validation data at fold 2"):
        tune.cross_validate(df.where("fold <> 2"), pipeline, maps, evaluator)


class _Together(LinearRegression):
    lock, running, most = Lock(), 0, 0

    def _fit(self, df):
        kind = type(self)
        with kind.lock:
            kind.running += 1
            kind.most = max(kind.most, kind.running)
        time.sleep(0.3)
        try:
            return super()._fit(df)
        finally:
            with kind.lock:
                kind.running -= 1


def test_fits_that_fill_the_cores_do_not_crowd_each_other_out_of_memory(spark):
    i = F.col("id")
    df = spark.range(300).select((i % 11).cast("double").alias("x"), (i % 7).cast("double").alias("y"), (i % 3).cast("int").alias("fold"))
    vectors = features.assembler_stage(["x"]).transform(df).select("features", "y", "fold")
    linear = _Together(labelCol="y")
    maps = tune.param_maps(linear, {"regParam": [0.0, 1.0, 2.0]})
    evaluator = RegressionEvaluator(labelCol="y")
    many = 8 * spark.sparkContext.defaultParallelism + 1
    metrics = {}
    for partitions, together in ((2, 3), (many, 1)):
        _Together.most = 0
        with kept(vectors, partitions) as rows:
            metrics[partitions] = tune.cross_validate(rows, linear, maps, evaluator).avgMetrics
        assert _Together.most == together
    assert metrics[2] == pytest.approx(metrics[many], rel=1e-12)


def test_very_many_labels_fit_about_as_fast_as_none(spark):
    i = F.col("id")
    df = spark.range(0, 300_000, 1, 8).select(
        F.concat(F.lit("k"), F.pmod(F.xxhash64(i), F.lit(150_000)).cast("string")).alias("k"),
        (i % 977).cast("double").alias("x"), ((i * 7) % 31 + i % 977).cast("double").alias("y"),
        F.pmod(F.xxhash64(i), F.lit(150_000)).cast("double").alias("z"),
    )
    forest = models.forest_regressor("y", numTrees=20, maxDepth=8)
    models.fit_trees(df, ColumnRoles(["k"], ["x"]), models.forest_regressor("y", numTrees=1))  # warms up
    seconds = {}
    for name, roles in (("narrow", ColumnRoles([], ["x", "z"])), ("wide", ColumnRoles(["k"], ["x"]))):
        start = time.perf_counter()
        model = models.fit_trees(df, roles, forest)
        seconds[name] = time.perf_counter() - start
    assert model.stages[-1].getOrDefault("maxBins") == models.TREE_BINS
    assert model.stages[0].ranks(spark).count() > 120_000
    print(seconds)
    assert seconds["wide"] < 2 * seconds["narrow"]


@pytest.mark.parametrize(
    "estimator",
    [lambda: models.decision_tree("y"), lambda: models.forest_regressor("y", numTrees=5)],
    ids=["tree", "forest"],
)
def test_trees_stay_in_the_label_range(spark, data, estimator):
    model = models.fit_trees(data, ROLES, estimator())
    low, high = data.agg(F.min("y"), F.max("y")).first()
    far = spark.createDataFrame([("k39", 1e9, 1e9), ("k0", -1e9, -1e9)], "k string, x double, z double")
    assert all(low <= r["prediction"] <= high for r in models.score(model, far).collect())
    importances = [r["importance"] for r in models.feature_importances(model, data).collect()]
    assert sum(importances) == pytest.approx(1.0) and min(importances) >= 0


def test_boosting_beats_the_mean_and_repeats(data):
    boosted = models.boosted_trees("y", maxIter=5)
    first, second = (models.score(models.fit_trees(data, ROLES, boosted), data) for _ in range(2))
    assert first.select("id", "prediction").exceptAll(second.select("id", "prediction")).count() == 0
    assert evaluate.regression_metrics(first, "y").first()["r2"] > 0.5


_CELLS = ColumnRoles(["k", "z"], [])


@pytest.mark.parametrize(
    "estimator",
    [
        lambda: models.decision_tree("y", maxDepth=4),
        lambda: models.forest_regressor("y", numTrees=3, bootstrap=False, maxDepth=4, featureSubsetStrategy="onethird"),
        lambda: models.boosted_trees("y", maxIter=4, maxDepth=3),
    ],
    ids=["tree", "forest", "boosting"],
)
def test_trees_on_categories_learn_the_same_from_means(spark, data, estimator):
    """Equal features are one row with its weight; scores and importances are those of a fit to all rows."""
    rows = data.withColumn("z", (F.col("z") % 5).cast("string")).withColumn("k", F.when(F.col("id") % 9 > 0, F.col("k")))
    encoded = models.encode(rows, _CELLS)
    every = encoded.with_model(estimator().fit(encoded.frame))
    with models.learned_rows(encoded, _CELLS, estimator()) as few:
        assert few.count() == encoded.frame.select("k", "z").distinct().count() < 201 and few.rdd.getNumPartitions() == 1
        assert few.agg(F.sum(models.WEIGHT)).first()[0] == encoded.frame.count()
    found = models.fit_trees(rows, _CELLS, estimator())
    assert not found.stages[-1].isDefined("weightCol") and "_weight" not in str(models.estimator_params(found))
    scores = [{r["id"]: r["prediction"] for r in models.score(m, rows).collect()} for m in (found, every)]
    assert scores[0] == pytest.approx(scores[1], rel=1e-9) and len(scores[0]) > 1700
    shares = [[r["importance"] for r in models.feature_importances(m, rows).collect()] for m in (found, every)]
    assert shares[0] == pytest.approx(shares[1], rel=1e-9)


def test_rows_are_put_together_only_where_means_are_enough(spark, data):
    rows = data.withColumn("z", F.col("z").cast("string"))
    for estimator in (
        models.forest_regressor("y"),
        models.decision_tree("y", minInstancesPerNode=2),
        models.boosted_trees("y", subsamplingRate=0.5),
        models.boosted_trees("y", lossType="absolute"),
        models.decision_tree("y", weightCol="x"),
        models.forest_classifier("y", bootstrap=False),
    ):
        assert not models.learns_from_means(_CELLS, estimator)
    tree = models.decision_tree("y")
    assert models.learns_from_means(_CELLS, tree) and not models.learns_from_means(ROLES, tree)
    for bad in (F.lit(None).cast("double"), F.lit(float("nan"))):
        broken = rows.withColumn("y", F.when(F.col("id") == 7, bad).otherwise(F.col("y")))
        with pytest.raises(Exception, match="(?i)label"):
            models.fit_trees(broken, _CELLS, tree)
    # Both labels of k are indexed, but one row has features: there are no bins for two.
    lone = spark.createDataFrame([("a", "u", 1.0), ("a", "u", 2.0), ("b", None, 3.0)], "k string, z string, y double")
    assert {r["prediction"] for r in models.score(models.fit_trees(lone, _CELLS, tree), lone).collect()} == {1.5}


def test_boosting_defaults(spark):
    boosted = models.boosted_trees("y")
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth(), boosted.getSeed()) == (100, 0.1, 4, 42)


def test_model_survives_storage(data, root):
    model = models.fit_linear(data, ROLES, "y")
    again = models.load_model(models.save_model(model, f"{root}/model"))
    pairs = models.score(again, models.score(model, data).select("id", "k", "x", "z", F.col("prediction").alias("p")))
    assert pairs.filter("p <> prediction").count() == 0


def test_measures_equal_the_evaluator(data):
    scored = models.score(models.fit_trees(data, ROLES, models.decision_tree("y")), data)
    row = evaluate.regression_metrics(scored, "y").first()
    for name in ("rmse", "r2"):
        want = RegressionEvaluator(labelCol="y", metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(want, rel=1e-9)


def test_measures_skip_rows_without_both(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (None, 5.0), (4.0, None)], "y double, prediction double")
    row = evaluate.regression_metrics(df, "y").first()
    assert (row["n_rows"], row["rmse"]) == (2, pytest.approx(0.5**0.5)) and row["r2"] == pytest.approx(0.5)


def test_mean_baseline_explains_nothing(data):
    scored = evaluate.add_baselines(data, data, "y")
    rows = {
        r["model"]: r
        for r in evaluate.compare_predictions(scored, "y", {"mean": "mean_prediction", "median": "median_prediction"}).collect()
    }
    assert rows["mean"]["r2"] == pytest.approx(0.0, abs=1e-12) and rows["median"]["r2"] <= 1e-12


def test_area_counts_ties_as_half(spark):
    df = spark.createDataFrame([(0.0, 0.1), (1.0, 0.1), (1.0, 0.9), (0.0, 0.2)], "y double, s double")
    # Pairs (positive, negative): 0.1 ties 0.1, loses to 0.2; 0.9 wins twice.
    assert evaluate.area_under_roc(df, "y", "s") == pytest.approx(2.5 / 4)


def test_folds_around_pipeline_and_around_estimator(spark, data):
    folded = assign_folds(data, ["id"])
    lr = models.linear_regression("y")
    evaluator = RegressionEvaluator(labelCol="y", metricName="rmse")
    maps = tune.param_maps(lr, {"regParam": [0.0, 5.0]})
    frame = features.assembler_stage(["x", "z"]).transform(folded)
    model = tune.cross_validate(frame, lr, maps, evaluator)
    by_hand = [
        np.mean(
            [
                evaluator.evaluate(lr.fit(frame.filter(f"fold <> {f}"), m).transform(frame.filter(f"fold = {f}")))
                for f in range(3)
            ]
        )
        for m in maps
    ]
    rows = tune.cv_results(spark, model).orderBy("combination").collect()
    assert [r["avg_metric"] for r in rows] == pytest.approx(by_hand)
    assert tune.best_row(tune.cv_results(spark, model), "avg_metric", False, "combination").first()["regParam"] == 0.0
    assert model.bestModel.getOrDefault("regParam") == 0.0


def test_grid_is_a_product(spark):
    assert len(tune.grid_points(tune.CLASSIFIER_GRID)) == 9
    rows = tune.grid_frame(spark, tune.FOREST_GRID).collect()
    assert {(r["maxDepth"], r["numTrees"]) for r in rows} == {(2, 5), (2, 10), (5, 5), (5, 10)}


def test_space_is_replayable_and_bounded(spark):
    points = tune.sample_space(spark, tune.BOOSTING_SPACE, 200).collect()
    assert points == tune.sample_space(spark, tune.BOOSTING_SPACE, 200).collect()
    assert all(10 <= p["maxIter"] <= 200 and p["maxIter"].is_integer() for p in points)
    assert all(0.01 <= p["stepSize"] < 0.3 for p in points)
    assert len({p["maxDepth"] for p in points}) == 9


def test_search_finds_the_smallest_loss(spark):
    found = tune.search(spark, {"a": tune.Uniform(-1, 1)}, lambda p: p["a"] ** 2, evaluations=20)
    rows = found.trials.collect()
    best = min(rows, key=lambda r: r["loss"])
    assert len(rows) == 20 and found.best == {"a": best["a"]}


def test_failed_trials_are_not_hidden(spark):
    def fail(point):
        raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        tune.search(spark, {"a": tune.Uniform(0, 1)}, fail, evaluations=2)


def test_whole_numbers_become_integers(spark):
    forest = tune.with_params(models.forest_regressor("y"), {"maxDepth": 5.0, "numTrees": 12.0})
    assert forest.getMaxDepth() == 5 and forest.getNumTrees() == 12
    boosted = tune.with_params(models.boosted_trees("y"), {"stepSize": 0.05, "maxIter": 7.0})
    assert boosted.getStepSize() == 0.05 and boosted.getMaxIter() == 7
