"""Queries over runs, their parameters and metrics.

Each supplier's deliveries count as one run that predicts the net price by the
list price, so the run tables grow with the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators import evaluate, models, tracking
from tabprep.plans.catalog import query, table
from tabprep.plans.model_queries import FEW_ROLES, LINE_SQL, compare_line_with_baselines, train_test
from tabprep.plans.oracles import metrics_sql
from tabprep.plans.roles import DEAL_LABEL, DEALS_SQL
from tabprep.session import shared_path
from tabprep.sources.tables import overwrite_table, read_table


def _long(rows: DataFrame, values: dict[str, str]) -> DataFrame:
    """(run_id, key, value) from one column per key."""
    pairs = [F.struct(F.lit(key).alias("key"), F.col(column).alias("value")) for key, column in values.items()]
    return rows.select("run_id", F.inline(F.array(*pairs)))


def run_tables(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs, parameters and metrics derived from the line items by one combined aggregate, which is written once."""
    error = F.col(DEAL_LABEL) - F.col("l_extendedprice")
    summary = (
        table(spark, folder, "lineitem")
        .withColumn(DEAL_LABEL, F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
        .groupBy("l_suppkey")
        .agg(
            F.max("l_shipdate").alias("last"),
            F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
            F.round(1 - F.avg(error * error) / F.nullif(F.var_pop(DEAL_LABEL), F.lit(0.0)), 8).alias("r2"),
        )
        .select(
            F.format_string("run-%06d", "l_suppkey").alias("run_id"),
            F.concat(F.lit("experiment-"), (F.col("l_suppkey") % 7).cast("string")).alias("experiment"),
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("run_name"),
            F.col("last").cast("date").cast("string").alias("start_time"),
            F.lit(None).cast("string").alias("model_path"),
            (F.col("l_suppkey") % 3).cast("string").alias("data_version"),
            F.lit("deals").alias("data_path"),
            "rmse",
            "r2",
        )
    )
    path = overwrite_table(summary, shared_path(spark, "runs-of-suppliers"))
    summary = read_table(spark, path)
    runs = summary.select(*tracking.RUNS.names)
    params = _long(summary, {"data_version": "data_version", "data_path": "data_path"})
    return runs, params, _long(summary, {"rmse": "rmse", "r2": "r2"})


RUNS_SQL = """pivoted AS (
  SELECT printf('run-%06d', l_suppkey) AS run_id, 'experiment-' || CAST(l_suppkey % 7 AS VARCHAR) AS experiment,
         'supplier ' || CAST(l_suppkey AS VARCHAR) AS run_name, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS start_time,
         CAST(l_suppkey % 3 AS VARCHAR) AS param_data_version, 'deals' AS param_data_path,
         round(sqrt(avg((p - l_extendedprice) * (p - l_extendedprice))), 4) AS metric_rmse,
         round(1 - avg((p - l_extendedprice) * (p - l_extendedprice)) / nullif(var_pop(p), 0), 8) AS metric_r2
  FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS p FROM lineitem) GROUP BY l_suppkey)"""
PIVOT_NAMES = "run_id, experiment, run_name, start_time, param_data_version, param_data_path, metric_rmse, metric_r2"


def pivoted_runs(spark, folder) -> DataFrame:
    """All runs with the parameters and metrics that occur; nobody names them."""
    return tracking.search_runs(*run_tables(spark, folder)).drop("model_path")


@query("runs_pivot", f"WITH {RUNS_SQL} SELECT {PIVOT_NAMES} FROM pivoted")
def runs_pivot(spark, folder):
    return pivoted_runs(spark, folder)


@query(
    "runs_by_data_version",
    f"""WITH {RUNS_SQL} SELECT {PIVOT_NAMES} FROM pivoted
        WHERE param_data_version = '1' AND param_data_path = 'deals'""",
)
def runs_by_data_version(spark, folder):
    return tracking.with_params(pivoted_runs(spark, folder), data_version="1", data_path="deals")


@query("experiment_list", f"WITH {RUNS_SQL} SELECT experiment, count(*) AS n_runs FROM pivoted GROUP BY experiment")
def experiment_list(spark, folder):
    return tracking.experiments(run_tables(spark, folder)[0])


@query(
    "latest_run",
    f"""WITH {RUNS_SQL} SELECT run_id, experiment, run_name, start_time, metric_rmse, metric_r2
        FROM pivoted ORDER BY start_time DESC, run_id DESC LIMIT 1""",
)
def latest_run(spark, folder):
    """The last run with its metrics."""
    runs, params, metrics = run_tables(spark, folder)
    latest = tracking.with_values(tracking.latest_run(runs), params, metrics, [], ["rmse", "r2"])
    return latest.select("run_id", "experiment", "run_name", "start_time", "metric_rmse", "metric_r2")


@query(
    "best_run",
    f"""WITH {RUNS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY param_data_version ORDER BY metric_rmse, run_id) AS place
        FROM pivoted) SELECT param_data_version, run_id, metric_rmse FROM ranked WHERE place = 1""",
)
def best_run(spark, folder):
    return tracking.best_runs(pivoted_runs(spark, folder), "param_data_version", "metric_rmse")


_LOGGED = (("mean", "mean_price", "none"), ("median", "median_price", "none"), ("line", "line_prediction", "l_quantity"))


@query(
    "run_log",
    f"WITH {LINE_SQL} "
    + " UNION ALL ".join(
        f"SELECT 'deals' AS experiment, '{name}' AS run_name, 'net_price' AS param_label, '{used}' AS param_features, "
        f"rmse AS metric_rmse, r2 AS metric_r2 FROM (SELECT {metrics_sql('lined', 'net_price', column)})"
        for name, column, used in _LOGGED
    ),
)
def run_log(spark, folder):
    """Three runs recorded, written, read back and pivoted."""
    train, test = train_test(spark, folder)
    measured = compare_line_with_baselines(train, test, "l_quantity", DEAL_LABEL)
    features = {name: used for name, _, used in _LOGGED}
    log = tracking.RunLog(spark, shared_path(spark, "run-log"))
    for row in measured.collect():  # one row per run
        params = {"label": DEAL_LABEL, "features": features[row["model"]]}
        log.record("deals", row["model"], params, {"rmse": round(row["rmse"], 4), "r2": round(row["r2"], 8)})
    log.flush()
    wide = tracking.search_runs(log.runs(), log.params(), log.metrics(), ["label", "features"], ["rmse", "r2"])
    return wide.drop("run_id", "start_time", "model_path")


# What Spark's stages are set to unless told otherwise.
_SET_PARAMS = {
    "0.StringIndexerModel.handleInvalid": "skip",
    "0.StringIndexerModel.inputCols": "['l_returnflag', 'l_linestatus']",
    "0.StringIndexerModel.outputCols": "['l_returnflag_index', 'l_linestatus_index']",
    "0.StringIndexerModel.stringOrderType": "frequencyDesc",
    "1.OneHotEncoderModel.dropLast": "True",
    "1.OneHotEncoderModel.handleInvalid": "error",
    "1.OneHotEncoderModel.inputCols": "['l_returnflag_index', 'l_linestatus_index']",
    "1.OneHotEncoderModel.outputCols": "['l_returnflag_onehot', 'l_linestatus_onehot']",
    "2.VectorAssembler.handleInvalid": "error",
    "2.VectorAssembler.inputCols": "['l_returnflag_onehot', 'l_linestatus_onehot', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']",
    "2.VectorAssembler.outputCol": "features",
    "3.LinearRegressionModel.aggregationDepth": "2",
    "3.LinearRegressionModel.elasticNetParam": "0.0",
    "3.LinearRegressionModel.epsilon": "1.35",
    "3.LinearRegressionModel.featuresCol": "features",
    "3.LinearRegressionModel.fitIntercept": "True",
    "3.LinearRegressionModel.labelCol": "net_price",
    "3.LinearRegressionModel.loss": "squaredError",
    "3.LinearRegressionModel.maxBlockSizeInMB": "0.0",
    "3.LinearRegressionModel.maxIter": "100",
    "3.LinearRegressionModel.predictionCol": "prediction",
    "3.LinearRegressionModel.regParam": "0.0",
    "3.LinearRegressionModel.solver": "auto",
    "3.LinearRegressionModel.standardization": "True",
    "3.LinearRegressionModel.tol": "1e-06",
}
_LEARNED_SQL = ", ".join(
    f"(SELECT list({c} ORDER BY n DESC, {c}) FROM (SELECT {c}, count(*) AS n FROM deals WHERE part = 'train' GROUP BY {c})) AS {c}s"
    for c in FEW_ROLES.categorical
)


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "estimator_params",
    f"""WITH {DEALS_SQL}, learned AS (SELECT {_LEARNED_SQL})
        SELECT 'linear' AS run_name, key, value FROM (VALUES {", ".join(f"({_text_sql(k)}, {_text_sql(v)})" for k, v in _SET_PARAMS.items())}) AS fixed(key, value)
        UNION ALL SELECT 'linear', '0.StringIndexerModel.labels',
          '[' || array_to_string(list_transform([l_returnflags, l_linestatuss], lambda x: '[' || array_to_string(list_transform(x, lambda y: '''' || y || ''''), ', ') || ']'), ', ') || ']' FROM learned
        UNION ALL SELECT 'linear', '1.OneHotEncoderModel.categorySizes', '[' || len(l_returnflags) || ', ' || len(l_linestatuss) || ']' FROM learned
        UNION ALL SELECT 'linear', '3.LinearRegressionModel.numFeatures', CAST(len(l_returnflags) + len(l_linestatuss) - 2 + 4 AS VARCHAR) FROM learned""",
)
def estimator_params(spark, folder):
    """Every parameter of a fitted pipeline, and what its stages learned from the rows, as rows of its run."""
    train, test = train_test(spark, folder)
    model = models.fit_linear(train, FEW_ROLES, DEAL_LABEL)
    row = evaluate.regression_metrics(models.score(model, test), DEAL_LABEL).first()
    log = tracking.RunLog(spark, shared_path(spark, "run-params"))
    params = {**models.estimator_params(model), **models.learned(model)}
    log.record("deals", "linear", params, {"rmse": row["rmse"], "r2": row["r2"]}, model)
    log.flush()
    named = log.runs().select("run_id", "run_name")
    return named.join(log.params(), "run_id").where(~F.col("key").like("%.coefficients")).select("run_name", "key", "value")
