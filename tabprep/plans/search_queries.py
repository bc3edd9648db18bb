"""Queries over recorded searches: trials as runs, resumed after a stop, and the winner refitted.

Losses that SQL knows: ridge regression on one feature has a closed form; trees of depth 0
predict the mean, trees that may grow until every cell of two categories is a leaf the cell means.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import evaluate, features, models, tracking, tune
from tabprep.operators.clean import union_rows
from tabprep.operators.search import BEST, LOSS, RecordedSearch, refit_best, run_search
from tabprep.operators.split import assign_parts
from tabprep.plans.catalog import query
from tabprep.plans.model_queries import CELL_DEPTH, CELL_ROLES, rounded_metrics
from tabprep.plans.oracles import metrics_sql
from tabprep.plans.roles import DEAL_LABEL, SPLIT_KEYS, deals
from tabprep.plans.tuning_queries import EVALUATIONS, RIDGE_SPACE, THREE_PARTS, THREE_SQL, TRIALS_SQL, lined, points_sql, rmse_sql, three_parts
from tabprep.session import shared_path
from tabprep.sources.tables import kept, stored

ABOUT = {"data": "deals", "label": DEAL_LABEL}


@query(
    "search_runs_logged",
    f"""WITH {TRIALS_SQL} SELECT trial, round("regParam", 6) AS "regParam", round(loss, 4) AS loss,
        CAST(1 AS BIGINT) AS runs, 'deals' AS data FROM losses""",
)
def search_runs_logged(spark, folder):
    """A search that stops after three trials and is started again: every point is one run, read back from the log."""
    root = shared_path(spark, "search")
    train, validation, _ = (lined(part) for part in three_parts(spark, folder))
    search = RecordedSearch("ridge", RIDGE_SPACE, ABOUT)
    with kept(train) as rows, kept(validation) as held:
        fit = lambda point: tune.with_params(models.linear_regression(DEAL_LABEL), point).fit(rows)
        for evaluations in (3, EVALUATIONS):
            run_search(spark, root, search, fit, lambda model: _measures(model, held), evaluations)
    log = tracking.RunLog(spark, root)
    wide = tracking.search_runs(log.runs(), log.params(), log.metrics(), ["regParam", "data"], [LOSS])
    named = wide.groupBy("run_name", F.col("param_data").alias("data")).agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.min(f"metric_{LOSS}"), 4).alias(LOSS)
    )
    trials = tune.sample_space(spark, RIDGE_SPACE, EVALUATIONS)
    point = F.from_json("run_name", "regParam double")["regParam"]
    found = named.withColumn("regParam", F.round(point, 6))
    return trials.select("trial", F.round("regParam", 6).alias("regParam")).join(found, "regParam").select(
        "trial", "regParam", LOSS, "runs", "data"
    )


def _measures(model, held: DataFrame) -> dict[str, float]:
    row = evaluate.regression_metrics(models.score(model, held), DEAL_LABEL).first()
    return {LOSS: row["rmse"], "r2": row["r2"]}


@contextmanager
def _encoded_search(spark, folder, name: str, space: dict, estimator, label: str, roles: ColumnRoles, measure, prepare=lambda df: df):
    """Search with one encoding for all trials, then the winner with its encoding refitted on train and validation.

    Gives the log, the result of the search, the refitted model and the prepared test part. All parts are read from
    one frame that is stored with the columns in use.
    """
    root = shared_path(spark, name)
    labels = [*{DEAL_LABEL, label}]
    source = assign_parts(deals(spark, folder), SPLIT_KEYS, *THREE_PARTS, column="part")
    used = source.select(*roles.categorical, *roles.numeric, DEAL_LABEL, "part")
    search = RecordedSearch(name, space, {**ABOUT, "estimator": type(estimator).__name__})
    names = ["features", *labels]
    with stored(prepare(used), used.drop("part")) as parts:
        train, validation, test = (parts.filter(F.col("part") == part).drop("part") for part in THREE_PARTS[1])
        encoded = models.encode(train, roles, label=label, max_labels=models.max_bins(estimator))
        unscored = encoded.encoder.transform(validation).select(*names)
        with models.learned_rows(encoded, roles, estimator, keep=True) as rows, stored(unscored, validation) as held:
            result = run_search(
                spark,
                root,
                search,
                lambda point: models.fit_rows(tune.with_params(estimator, point), rows),
                lambda model: measure(models.score(model, held)),
                EVALUATIONS,
                tune.fits_at_once(rows),
            )
        model, _ = refit_best(
            spark,
            root,
            search,
            result.best,
            lambda point: models.fit_trees(union_rows(train, validation), roles, tune.with_params(estimator, point)),
            lambda fitted: measure(models.score(fitted, test)),
        )
        yield tracking.RunLog(spark, root), result, model, test


def _refitted_run(log: tracking.RunLog, space: dict) -> DataFrame:
    """The recorded run of the refitted winner: its point and its measures."""
    best = log.runs().where(F.col("run_name") == BEST)
    wide = tracking.search_runs(best, log.params(), log.metrics(), list(space), ["rmse", "r2", "n_rows"])
    return wide.select(
        *[F.round(F.col(f"param_{n}").cast("double"), 6).alias(n) for n in space],
        F.col("metric_n_rows").cast("long").alias("n_rows"),
        F.round("metric_rmse", 4).alias("rmse"),
        F.round("metric_r2", 8).alias("r2"),
    )


def _refit_sql(space: dict, cell: str, flat: str) -> str:
    """SQL for the winner of a search over trees that are either flat or hold every cell, refitted and measured."""
    names = ", ".join(f'round("{n}", 6) AS "{n}"' for n in space)
    return f"""WITH {THREE_SQL}, cells AS (
        SELECT size_band, l_linestatus, {cell} AS cell_price FROM deals WHERE part = 'train' GROUP BY ALL),
      means AS (SELECT {flat} AS mean_price FROM deals WHERE part = 'train'),
      held AS (SELECT {rmse_sql('mean_price')} AS flat, {rmse_sql('cell_price')} AS full_depth
        FROM deals JOIN cells USING (size_band, l_linestatus), means WHERE part = 'validation'),
      best AS (SELECT points.* FROM ({points_sql(space, EVALUATIONS)}) AS points, held
        ORDER BY round(CASE WHEN "maxDepth" = 0 THEN flat ELSE full_depth END, 6), trial LIMIT 1),
      again AS (SELECT size_band, l_linestatus, {cell} AS cell_price FROM deals WHERE part <> 'test' GROUP BY ALL),
      final AS (SELECT net_price, CASE WHEN "maxDepth" = 0 THEN m.mean_price ELSE cell_price END AS prediction
        FROM deals JOIN again USING (size_band, l_linestatus), best, (SELECT {flat} AS mean_price FROM deals WHERE part <> 'test') AS m
        WHERE part = 'test')
      SELECT {names}, n_rows, rmse, r2 FROM best, (SELECT {metrics_sql('final', 'net_price')})"""


_FLAT_OR_FULL = tune.Uniform(0, CELL_DEPTH, CELL_DEPTH)
FOREST_CELLS = {"maxDepth": _FLAT_OR_FULL, "numTrees": tune.Uniform(1, 4, 1)}
BOOSTED_CELLS = {"maxIter": tune.Uniform(1, 3, 1), "maxDepth": _FLAT_OR_FULL, "stepSize": tune.Uniform(0.01, 0.3)}


@query("search_retrain_forest", _refit_sql(FOREST_CELLS, "avg(net_price)", "avg(net_price)"))
def search_retrain_forest(spark, folder):
    """The best forest of a recorded search, refitted with its encoding, saved and measured on the test part."""
    forest = models.forest_regressor(DEAL_LABEL, bootstrap=False, featureSubsetStrategy="all")

    def measure(scored: DataFrame) -> dict[str, float]:
        row = evaluate.regression_metrics(scored, DEAL_LABEL).first()
        # Trials that differ in the last digits of a sum are equal.
        return {LOSS: round(row["rmse"], 6), "rmse": row["rmse"], "r2": row["r2"], "n_rows": row["n_rows"]}

    with _encoded_search(spark, folder, "forest", FOREST_CELLS, forest, DEAL_LABEL, CELL_ROLES, measure) as (log, *_):
        return _refitted_run(log, FOREST_CELLS)


@query("search_retrain_boosting", _refit_sql(BOOSTED_CELLS, "exp(avg(ln(net_price)))", "exp(avg(ln(net_price)))"))
def search_retrain_boosting(spark, folder):
    """The best boosted trees of the log price, refitted with their encoding; the saved model is loaded to score."""
    boosted = models.boosted_trees("label", featureSubsetStrategy="all")

    def measure(scored: DataFrame) -> dict[str, float]:
        row = evaluate.log_scale_metrics(scored, DEAL_LABEL, "prediction").first()
        return {LOSS: round(row["rmse"], 6), "rmse": row["rmse"], "r2": row["r2"], "n_rows": row["n_rows"]}

    add_log = lambda df: features.add_log(df, DEAL_LABEL, "label")
    with _encoded_search(
        spark, folder, "boosting", BOOSTED_CELLS, boosted, "label", CELL_ROLES, measure, add_log
    ) as (log, _, _, test):
        run = log.runs().where(F.col("run_name") == BEST).first()["run_id"]
        scored = models.score(log.load_model(run), test)
        again = rounded_metrics(evaluate.log_scale_metrics(scored, DEAL_LABEL, "prediction")).first()
    measured = [F.lit(again[c]).cast(kind).alias(c) for c, kind in (("n_rows", "long"), ("rmse", "double"), ("r2", "double"))]
    return _refitted_run(log, BOOSTED_CELLS).select(*BOOSTED_CELLS, *measured)
