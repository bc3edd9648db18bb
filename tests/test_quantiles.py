import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabprep.operators import profile, quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def brute_element(data, p):
    data = sorted(data)
    return data[max(1, math.ceil(p * len(data))) - 1]


def frame(spark, data):
    return spark.createDataFrame([(None if x is None else float(x),) for x in data], "x double").repartition(5)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(st.integers(-50, 50), min_size=1, max_size=120),
    exact_rows=st.sampled_from([1, 3, 1000]),
)
def test_any_data_matches_sorting(spark, data, exact_rows):
    df = frame(spark, data)
    assert quantiles.exact_quantiles(df, ["x"], SHARES, exact_rows=exact_rows)["x"] == [
        brute_element(data, p) for p in SHARES
    ]
    blended = quantiles.exact_quantiles(df, ["x"], SHARES, True, exact_rows)["x"]
    assert blended == pytest.approx(list(np.quantile(data, SHARES)))


@pytest.mark.parametrize("shape", ["uniform", "hot", "outlier", "few"])
def test_narrowing_rounds(spark, shape):
    """Small limits force the bracket rounds that large tables take."""
    rng = np.random.default_rng(7)
    data = {
        "uniform": rng.uniform(0, 1e6, 60_000),
        "hot": np.where(rng.uniform(size=60_000) < 0.34, 5.0, rng.normal(5, 1, 60_000)),
        "outlier": np.append(rng.uniform(0, 1, 59_999), 1e300),
        "few": rng.integers(0, 4, 60_000).astype(float),
    }[shape]
    df = spark.createDataFrame([(float(x),) for x in data], "x double").repartition(8)
    got = quantiles.exact_quantiles(df, ["x"], SHARES, exact_rows=20)["x"]
    assert got == [brute_element(data, p) for p in SHARES]


def test_a_bad_bracket_does_not_matter(spark, monkeypatch):
    """Counting decides, so even a sketch that is wrong leads to the exact element."""
    monkeypatch.setattr(quantiles, "_around", lambda share: [0.9, 0.95])
    data = list(range(1000))
    assert quantiles.exact_quantiles(frame(spark, data), ["x"], [0.5], exact_rows=10)["x"] == [brute_element(data, 0.5)]


def test_sketches_are_merged_by_groups(spark):
    """No task gets the sketch of every partition: groups of partitions are merged before the end."""
    df = spark.range(0, 1000, 1, 600).select(F.col("id").cast("double").alias("x"))
    merged = quantiles._merged_sketches(df, [F.col("x")])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_group") == 1 and plan.count("Exchange SinglePartition") == 1
    assert merged.select(F.kll_sketch_get_n_double("s0")).first()[0] == 1000


def test_missing_values_do_not_count(spark):
    df = frame(spark, [1, 2, 3, 10, None, float("nan")])
    assert quantiles.median(df, "x") == 2.5
    assert quantiles.exact_quantiles(df, ["x"], [0.5])["x"] == [2.0]
    assert quantiles.exact_quantiles(df.filter("x > 99"), ["x"], [0.5])["x"] == [None]


def test_a_million_values_fit_the_exact_sketch(spark):
    df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).cast("double").alias("x"))
    data = np.sort((np.arange(1_000_000) * 7919) % 1_000_003)
    got = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    assert got == [float(data[math.ceil(p * len(data)) - 1]) for p in (0.25, 0.5, 0.75)]


def test_summary_of_columns(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None), (3, float("nan")), (4, 2.5)], "a int, b double")
    rows = {r["column_name"]: r for r in profile.summarize(df).collect()}
    assert (rows["a"]["n"], rows["a"]["mean"], rows["a"]["q25"], rows["a"]["q50"], rows["a"]["q75"]) == (4, 2.5, 1, 2, 3)
    assert (rows["b"]["n"], rows["b"]["min_value"], rows["b"]["max_value"]) == (2, 1.5, 2.5)


def test_null_profile(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", float("nan"))], "k string, v double")
    rows = {r["column_name"]: r for r in profile.null_profile(df).collect()}
    assert (rows["k"]["n_rows"], rows["k"]["n_complete"], rows["k"]["n_missing"], rows["v"]["n_missing"]) == (3, 1, 1, 1)


def test_histogram_edges(spark):
    df = frame(spark, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None])
    got = {r["bin"]: (r["low"], r["n_rows"]) for r in profile.histogram(df, "x", 5).collect()}
    assert got == {0: (0.0, 2), 1: (2.0, 2), 2: (4.0, 2), 3: (6.0, 2), 4: (8.0, 3)}
    same = profile.histogram(frame(spark, [3, 3, 3]), "x", 5).collect()
    assert sorted((r["bin"], r["n_rows"]) for r in same) == [(0, 3), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_histogram_has_empty_bins(spark):
    rows = profile.histogram(frame(spark, [0, 10, float("nan"), None]), "x", 5).collect()
    assert sorted((r["bin"], r["low"], r["n_rows"]) for r in rows) == [(0, 0.0, 1), (1, 2.0, 0), (2, 4.0, 0), (3, 6.0, 0), (4, 8.0, 1)]
    assert profile.histogram(frame(spark, [None]), "x", 5).collect() == []


def test_one_budget_for_all_columns_and_ranks(spark, monkeypatch):
    """22 columns and three quartiles: no last aggregate holds more rows than one budget."""
    n, names = 4000, [f"c{k}" for k in range(22)]
    df = spark.range(n).select(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50 + 40 * k * k)).cast("double").alias(c) for k, c in enumerate(names)])
    held = []
    pick = quantiles._pick

    def watched(frame, values, searches):
        held.append(sum(max(s.rows for s in g) for g in quantiles._by_interval(searches)))
        pick(frame, values, searches)

    monkeypatch.setattr(quantiles, "_pick", watched)
    table = df.toPandas()
    for budget in (300, 5000, 10**6):
        found = quantiles.exact_quantiles(df, names, [0.25, 0.5, 0.75], exact_rows=budget)
        for c in names:
            ordered = sorted(table[c])
            assert found[c] == [ordered[max(1, -(-int(p * 100) * n // 100)) - 1] for p in (0.25, 0.5, 0.75)]
    assert held and all(h <= b for h, b in zip(sorted(held), sorted((300, 5000, 10**6))[-len(held) :]))


def test_summary_takes_two_scans_and_merges_moments(spark, root):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 0.5 + 1e6).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("b"), F.lit(None).cast("int").alias("c"))
    df.write.parquet(f"{root}/t")
    read = spark.read.parquet(f"{root}/t")
    table = df.toPandas()
    spark.sparkContext.setJobGroup("summary", "")
    try:
        found = {r["column_name"]: r for r in profile.summarize(read).collect()}
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("summary") for s in tracker.getJobInfo(j).stageIds]
        tasks = sum(i.numCompletedTasks for s in set(stages) if (i := tracker.getStageInfo(s)) and i.numTasks > 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found["a"]["stddev"] == pytest.approx(table["a"].std(), rel=1e-12) and found["a"]["mean"] == pytest.approx(table["a"].mean())
    assert (found["b"]["n"], found["b"]["min_value"], found["b"]["max_value"]) == (int(table["b"].count()), 0.0, 10.0)
    assert (found["c"]["n"], found["c"]["mean"], found["c"]["stddev"], found["c"]["q50"]) == (0, None, None, None)
    assert tasks <= 2 * read.rdd.getNumPartitions() + 8
