"""Two models on two versions of a table: track, register, compare and promote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.operators import evaluate, features, models, tracking
from tabprep.operators.registry import ModelRegistry, versions as registered_versions
from tabprep.sources import versions

LOG_LABEL = "log_label"


def promote_best(spark: SparkSession, train: DataFrame, test: DataFrame, label: str, name: str, root: str) -> DataFrame:
    """(version, stage, data_version, rmse, r2) of both models after the better one went to production.

    Version 0 of the tables is as given, version 1 adds the log of the label. The
    first model predicts the label, the second one its log; both are measured on
    the label. All other columns are features.
    """
    parts = {"train": train, "test": test}
    for part, df in parts.items():
        versions.overwrite_version(df, f"{root}/{part}")
        old = versions.read_version(spark, f"{root}/{part}", 0)
        versions.overwrite_version(features.add_log(old, label, LOG_LABEL), f"{root}/{part}", merge_schema=True)

    plans = [
        (0, f"{label} ~ .", label, "prediction"),
        (1, f"{LOG_LABEL} ~ . - {label}", LOG_LABEL, "log_prediction"),
    ]
    log, registry = tracking.RunLog(spark, root), ModelRegistry(spark, root)
    for data_version, formula, target, prediction in plans:
        model = models.fit_formula(versions.read_version(spark, f"{root}/train", data_version), formula, target, prediction)
        # The first version of the test table serves both: a model needs no label column to score.
        scored = models.score(model, versions.read_version(spark, f"{root}/test", 0))
        if target == LOG_LABEL:
            scored = features.undo_log(scored, prediction)
        measured = evaluate.regression_metrics(scored, label).first()
        run = log.record(
            name,
            f"line on {target}",
            {"label": target, "data_version": data_version, "data_path": f"{root}/train"},
            {"rmse": measured["rmse"], "r2": measured["r2"]},
            model,
        )
        registry.register(name, run, "Staging", f"all features, {target} as label")
    log.flush()
    registry.describe(name, "Forecasts prices from all other columns.")

    runs = tracking.search_runs(log.runs(), log.params(), log.metrics(), ["data_version", "data_path"], ["rmse", "r2"])
    found = tracking.with_params(runs, data_path=f"{root}/train")
    by_version = tracking.best_runs(found, "param_data_version", "metric_rmse")
    best = by_version.orderBy("metric_rmse", "run_id").first()["run_id"]
    candidates = registry.search(name).select("version", "source").collect()  # one row per version
    registry.transition(name, {r["version"]: "Production" if r["source"] == best else "Archived" for r in candidates})

    live = registered_versions(registry.events()).filter(F.col("name") == name)
    return live.join(runs, live["source"] == runs["run_id"]).select(
        "version",
        "stage",
        F.col("param_data_version").alias("data_version"),
        F.col("metric_rmse").alias("rmse"),
        F.col("metric_r2").alias("r2"),
    )
