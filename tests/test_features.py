import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import features, models, ranking
from tabprep.operators.wide_formula import WideFormula


# Rows of the worked examples for index, one-hot, assembler and formula.
def test_index_example(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "a"), (5, "c")], "id int, category string")
    for out in (
        features.fit_indexer(df, ["category"]).transform(df),
        features.index_wide(df, "category"),
    ):
        assert {r["category"]: r["category_index"] for r in out.collect()} == {"a": 0.0, "c": 1.0, "b": 2.0}
        assert out.count() == 6


def test_one_hot_example(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0), (1.0, 0.0), (2.0, 1.0), (0.0, 2.0), (0.0, 1.0), (2.0, 0.0)], "a_index double, b_index double"
    )
    out = features.one_hot_stage(["a", "b"]).fit(df).transform(df)
    rows = [tuple(r) for r in features.vectors_to_arrays(out, ["a_onehot", "b_onehot"]).collect()]
    assert rows[2][2:] == ([0.0, 0.0], [0.0, 1.0])
    assert rows[3][2:] == ([1.0, 0.0], [0.0, 0.0])
    full = features.one_hot_stage(["a"], drop_last=False).fit(df).transform(df)
    assert features.vectors_to_arrays(full, ["a_onehot"]).collect()[2]["a_onehot"] == [0.0, 0.0, 1.0]


def test_assemble_example(spark):
    df = spark.createDataFrame([(0, 18, 1.0, 1.0), (1, 22, 3.0, 5.0)], "id int, hour int, mobile double, clicked double")
    out = features.assembler_stage(["hour", "mobile"]).transform(df)
    assert [r["features"] for r in features.vectors_to_arrays(out, ["features"]).collect()] == [[18, 1], [22, 3]]
    with pytest.raises(Exception):
        features.assembler_stage(["x"]).transform(spark.sql("SELECT CAST(null AS DOUBLE) AS x")).collect()


def test_formula_example(spark):
    df = spark.createDataFrame(
        [(7, "US", 18, 1.0), (8, "CA", 12, 0.0), (9, "NZ", 15, 0.0)], "id int, country string, hour int, clicked double"
    )
    out = features.formula_stage("clicked ~ country + hour").fit(df).transform(df)
    rows = {r["id"]: (r["features"], r["label"]) for r in features.vectors_to_arrays(out, ["features"]).collect()}
    # Equally frequent countries are ordered by name, and the last one has no slot.
    assert rows == {7: ([0, 0, 18], 1.0), 8: ([1, 0, 12], 0.0), 9: ([0, 1, 15], 0.0)}


def test_formula_scores_rows_without_a_label(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 3.0)], "k string, x double, price double")
    model = features.formula_stage("price ~ .", handle_invalid="skip").fit(df)
    assert model.transform(df.drop("price")).count() == 2


def test_unseen_and_missing_labels(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    skip = features.fit_indexer(train, ["k"], "skip").transform(test)
    assert [r["k_index"] for r in skip.collect()] == [0.0]
    keep = features.fit_indexer(train, ["k"], "keep").transform(test)
    assert sorted(r["k_index"] for r in keep.collect()) == [0.0, 2.0, 2.0]
    with pytest.raises(Exception):
        features.fit_indexer(train, ["k"]).transform(test).collect()


def test_fitted_wide_index_on_new_rows(spark, root):
    """150,000 labels; unseen and null ones are left out, kept apart or refused."""
    train = spark.range(150_000).select(F.col("id").cast("string").alias("k"))
    index = features.WideIndex.fit(train, "k", f"{root}/labels")
    test = spark.createDataFrame([("7",), ("x",), (None,), ("149999",)], "k string")
    want = {k: float(i) for i, k in enumerate(sorted(map(str, range(150_000)))) if k in ("7", "149999")}
    found = {r["k"]: r["k_index"] for r in index.transform(test, "skip").collect()}
    assert found == want
    kept = {r["k"]: r["k_index"] for r in index.transform(test, "keep").collect()}
    assert kept == want | {"x": 150_000.0, None: 150_000.0}
    with pytest.raises(Exception, match="unseen label in k"):
        index.transform(test).collect()
    again = features.WideIndex(index.path, "k", "again")
    assert again.transform(test, "skip").count() == 2


def test_wide_index_with_a_hot_label(spark):
    """One label holds a third of the rows; ties among the rest are broken by name."""
    df = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string"))).alias("k")
    )
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    want = {k: float(i) for i, (k, _) in enumerate(sorted(counts.items(), key=lambda kv: (-kv[1], kv[0])))}
    out = features.index_wide(df, "k")
    assert {r["k"]: r["k_index"] for r in out.select("k", "k_index").distinct().collect()} == want
    assert out.count() == 9000
    small = features.fit_indexer(df, ["k"]).transform(df)
    assert small.select("id", "k_index").exceptAll(out.select("id", "k_index")).count() == 0


def test_global_row_number(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("x")).repartition(11)
    rows = ranking.global_row_number(df, [F.desc("x")]).collect()
    ordered = sorted(rows, key=lambda r: r["row_number"])
    assert [r["row_number"] for r in ordered] == list(range(5000))
    assert [r["x"] for r in ordered] == sorted((r["x"] for r in rows), reverse=True)


def test_slot_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "k string, x double")
    roles = ColumnRoles(["k"], ["x"])
    for one_hot, want in ((True, ["k_onehot_a", "x"]), (False, ["k_index", "x"])):
        out = Pipeline(stages=features.encoding_stages(roles, one_hot)).fit(df).transform(df)
        assert features.feature_names(out) == want


def test_log_is_null_where_it_has_no_value(spark):
    df = spark.createDataFrame([(math.e,), (0.0,), (-1.0,), (None,), (math.nan,)], "price double")
    logged = features.undo_log(features.add_log(df, "price", "log_price"), "log_price", "again")
    assert [r["log_price"] for r in logged.collect()] == [1.0, None, None, None, None]
    assert logged.first()["again"] == pytest.approx(math.e)


def test_wide_formula_equals_the_narrow_one(spark, root):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(9), rng.choice("xyz"), float(k), k) for k in range(200)]
    df = spark.createDataFrame(rows, "s string, n int, t string, y double, id int")
    for k, text in enumerate(["y ~ .", "y ~ . - id", "y ~ t + n", "y ~ n + s + t - t", "y ~ n"]):
        wide = WideFormula.fit(df, text, f"{root}/{k}").transform(df)
        narrow = features.formula_stage(text, handle_invalid="skip").fit(df).transform(df)
        read = lambda d: sorted((r["id"], tuple(r["features"].toArray()), r["label"]) for r in d.collect())
        assert read(wide) == read(narrow), text
    fitted = WideFormula.fit(df, "y ~ s", f"{root}/s")
    new = spark.createDataFrame([("a", 1), ("new", 2), (None, 3)], "s string, features int")
    out = fitted.transform(new)
    assert out.columns == ["s", "features"] and [r["s"] for r in out.collect()] == ["a"]
    for bad in ("y", "y ~ a:b", "~ s", "y ~ nothing"):
        with pytest.raises(ValueError):
            WideFormula.fit(df, bad, f"{root}/bad")


def test_wide_formula_of_very_many_labels(spark, root):
    i = F.col("id")
    df = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("label-"), F.pmod(F.xxhash64(i), F.lit(150_000)).cast("string")).alias("k"), (i % 7).cast("double").alias("x"), (i % 11).cast("double").alias("price")
    )
    formula = WideFormula.fit(df, "price ~ .", f"{root}/wide")
    out = formula.transform(df)
    assert formula.sizes["k"] > 100_000 and "label-" not in str(out.schema["features"].metadata)
    row = out.first()
    assert isinstance(row["features"], SparseVector) and row["features"].size == formula.sizes["k"]
    assert row["features"].numNonzeros() <= 2 and out.count() == 200_000
    model = models.linear_regression("label", maxIter=3, solver="l-bfgs").fit(out.select("features", "label"))
    assert model.numFeatures == formula.sizes["k"]
