"""One key, label or model with a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tabprep.operators import clean, features, impute, registry

SMALL_THRESHOLDS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_THRESHOLDS}
    for key, value in SMALL_THRESHOLDS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_labels(spark, n):
    label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 20_000).cast("string")))
    return spark.range(0, n, 1, 20).select(F.xxhash64("id").alias("id"), label.alias("k"))


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.find("Initial Plan")]


def test_a_hot_label_is_split_in_the_join(spark, small_thresholds):
    indexed = features.index_wide(hot_labels(spark, 600_000), "k")
    # The random ids keep the hot partition large after compression.
    result = indexed.agg(
        F.count_if(F.col("k_index") == 0).alias("hot"), F.count(F.lit(1)).alias("n"), F.max("id").alias("id")
    )
    plan = final_plan(result)
    assert "SortMergeJoin(skew=true)" in plan
    assert tuple(result.first())[:2] == (200_000, 600_000)


def test_copies_collapse_before_the_shuffle(spark):
    df = hot_labels(spark, 30_000).select("k")
    plan = clean.dedup_rows(df)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "HashAggregate" in before_shuffle
    assert clean.dedup_rows(df).count() == df.select("k").toPandas()["k"].nunique()


def test_the_mode_of_a_hot_column(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 100 == 1, None).otherwise(F.col("id").cast("double")).alias("x")
    )
    filled = impute.impute_mode(df, ["x"])
    missing = df.filter("x IS NULL").count()
    assert missing > 0 and filled.filter("x = 5").count() == 3000 + missing + df.filter("x = 5").count() - 3000


def test_a_model_with_most_versions(spark):
    i = F.col("id")
    hot = i % 3 == 0
    events = spark.range(3000).select(
        i.alias("seq"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("m"), i.cast("string"))).alias("name"),
        F.when(hot, i / 3 + 1).otherwise(1).cast("long").alias("version"),
        F.lit(registry.REGISTER).alias("kind"),
        F.concat(F.lit("run-"), i.cast("string")).alias("value"),
    )
    live = registry.versions(events)
    assert live.count() == 3000 and live.select("name", "version").distinct().count() == 3000
    latest = {r["name"]: r["latest_version"] for r in registry.latest_versions(events).collect()}
    assert latest["hot"] == 1000 and len(latest) == 2001
