"""Queries over fitted models, their scores and their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import ColumnRoles
from tabprep.operators import evaluate, features, models
from tabprep.operators.split import assign_parts, split_parts
from tabprep.operators.tracking import RunLog
from tabprep.plans import roles
from tabprep.plans.catalog import query, table
from tabprep.plans.cleaning_queries import CLEAN_LISTINGS_SQL, cleaned_listings
from tabprep.plans.oracles import coefficient_sql, least_squares_sql, metrics_sql
from tabprep.plans.promotion import promote_best
from tabprep.plans.roles import DEAL_LABEL, DEAL_NUMBERS, DEALS_SQL, PRICED_SQL, SPLIT_KEYS, hash_share_sql
from tabprep.session import shared_path
from tabprep.sources.tables import kept, overwrite_table, read_table, stored

KEYS_SQL = ", ".join(SPLIT_KEYS)
ALL_ROLES = ColumnRoles(["l_returnflag", "l_linestatus", "size_band"], DEAL_NUMBERS)
FEW_ROLES = ColumnRoles(["l_returnflag", "l_linestatus"], DEAL_NUMBERS)
CELL_ROLES = ColumnRoles(["size_band", "l_linestatus"], [])
HIGH_PRICE = 25000.0


def train_test(spark, folder) -> tuple[DataFrame, DataFrame]:
    return tuple(split_parts(roles.deals(spark, folder), SPLIT_KEYS))


def rounded_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 8)})


# One numeric feature: slope and intercept in closed form.
LINE_SQL = f"""{DEALS_SQL}, line AS (
  SELECT regr_slope(net_price, l_quantity) AS slope, regr_intercept(net_price, l_quantity) AS intercept,
         avg(net_price) AS mean_price, median(net_price) AS median_price FROM deals WHERE part = 'train'),
 lined AS (
  SELECT deals.*, intercept + slope * l_quantity AS line_prediction, mean_price, median_price
  FROM deals, line WHERE part = 'test')"""


def single_feature_fit(train: DataFrame, feature: str = "l_quantity", label: str = DEAL_LABEL):
    return models.fit_stages(train, features.assembler_stage([feature]), models.linear_regression(label))


def compare_line_with_baselines(train: DataFrame, test: DataFrame, feature: str, label: str) -> DataFrame:
    """Mean, median and a one-feature line, measured in one pass over the test part."""
    with kept(train.select(feature, label)) as rows:
        scored = models.score(single_feature_fit(rows, feature, label), evaluate.add_baselines(rows, test, label))
    predictions = {"mean": "mean_prediction", "median": "median_prediction", "line": "prediction"}
    return evaluate.compare_predictions(scored, label, predictions)


@query(
    "baseline_predict",
    f"""WITH {LINE_SQL} SELECT {KEYS_SQL}, round(mean_price, 4) AS mean_prediction,
        round(median_price, 6) AS median_prediction FROM lined""",
)
def baseline_predict(spark, folder):
    train, test = train_test(spark, folder)
    predicted = evaluate.add_baselines(train, test, DEAL_LABEL)
    return predicted.select(
        *SPLIT_KEYS,
        F.round("mean_prediction", 4).alias("mean_prediction"),
        F.round("median_prediction", 6).alias("median_prediction"),
    )


@query("ols_single", f"WITH {LINE_SQL} SELECT {metrics_sql('lined', 'net_price', 'line_prediction')}")
def ols_single(spark, folder):
    train, test = train_test(spark, folder)
    scored = models.score(single_feature_fit(train), test)
    return rounded_metrics(evaluate.regression_metrics(scored, DEAL_LABEL))


@query(
    "ols_coefficients",
    f"""WITH {LINE_SQL} SELECT 0 AS position, 'l_quantity' AS feature, round(slope, 4) AS coefficient FROM line
        UNION ALL SELECT 1, '(intercept)', round(intercept, 4) FROM line""",
)
def ols_coefficients(spark, folder):
    train, _ = train_test(spark, folder)
    found = models.coefficients(single_feature_fit(train), train)
    return found.withColumn("coefficient", F.round("coefficient", 4))


# Five numeric features, as least squares by orthogonal steps.
_FIVE = {"x1": "l_quantity", "x2": "l_extendedprice", "x3": "l_discount", "x4": "l_tax", "x5": "l_linenumber"}
_FIVE_CTES, _FIVE_SELECT = coefficient_sql("deals", _FIVE, "net_price")


@query(
    "ols_multi",
    f"WITH {DEALS_SQL}, {_FIVE_CTES}, found AS ({_FIVE_SELECT}) SELECT CASE feature "
    + " ".join(f"WHEN '{n}' THEN '{e}'" for n, e in _FIVE.items())
    + " END AS feature, round(coefficient, 5) AS coefficient FROM found",
)
def ols_multi(spark, folder):
    train, _ = train_test(spark, folder)
    model = models.fit_stages(
        train, features.assembler_stage(list(_FIVE.values())), models.linear_regression(DEAL_LABEL)
    )
    found = models.coefficients(model, train).filter("feature <> '(intercept)'")
    return found.select("feature", F.round("coefficient", 5).alias("coefficient"))


# Categories as 0/1 features; which category is left out does not change the fit.
_FEW = {
    "f1": "CAST(l_returnflag = 'A' AS INTEGER)",
    "f2": "CAST(l_returnflag = 'N' AS INTEGER)",
    "f3": "CAST(l_linestatus = 'O' AS INTEGER)",
    "x1": "l_quantity",
    "x2": "l_extendedprice",
    "x3": "l_discount",
    "x4": "l_tax",
}
_FEW_SQL = f"{DEALS_SQL}, {least_squares_sql('deals', _FEW, 'net_price', SPLIT_KEYS)}"


@query("ols_onehot", f"WITH {_FEW_SQL} SELECT {metrics_sql('s_fit WHERE NOT is_train')}")
def ols_onehot(spark, folder):
    train, test = train_test(spark, folder)
    scored = models.score(models.fit_linear(train, FEW_ROLES, DEAL_LABEL), test)
    return rounded_metrics(evaluate.regression_metrics(scored, DEAL_LABEL))


@query("score_table", f"WITH {_FEW_SQL} SELECT {KEYS_SQL}, round(prediction, 2) AS prediction FROM s_fit WHERE NOT is_train")
def score_table(spark, folder):
    train, test = train_test(spark, folder)
    scored = models.score(models.fit_linear(train, FEW_ROLES, DEAL_LABEL), test)
    return scored.select(*SPLIT_KEYS, F.round("prediction", 2).alias("prediction"))


@query("ols_formula", f"WITH {_FEW_SQL} SELECT {metrics_sql('s_fit WHERE NOT is_train')}")
def ols_formula(spark, folder):
    """The same fit from a formula over all columns."""
    names = [*FEW_ROLES.categorical, *FEW_ROLES.numeric, DEAL_LABEL]
    train, test = (part.select(*names) for part in train_test(spark, folder))
    with stored(train) as rows:
        model = models.fit_formula(rows, f"{DEAL_LABEL} ~ .", DEAL_LABEL)
    return rounded_metrics(evaluate.regression_metrics(models.score(model, test), DEAL_LABEL))


_LOG_SQL = f"""{DEALS_SQL}, line AS (
  SELECT regr_slope(ln(net_price), l_quantity) AS slope, regr_intercept(ln(net_price), l_quantity) AS intercept
  FROM deals WHERE part = 'train'),
 lined AS (SELECT net_price, exp(intercept + slope * l_quantity) AS prediction FROM deals, line WHERE part = 'test')"""


@query("eval_log_scale", f"WITH {_LOG_SQL} SELECT {metrics_sql('lined', 'net_price')}")
def eval_log_scale(spark, folder):
    """A model of the log price, measured in prices."""
    train, test = (features.add_log(p, DEAL_LABEL, "log_price") for p in train_test(spark, folder))
    model = models.fit_stages(
        train,
        features.assembler_stage(["l_quantity"]),
        models.linear_regression("log_price", "log_prediction"),
    )
    scored = models.score(model, test)
    return rounded_metrics(evaluate.log_scale_metrics(scored, DEAL_LABEL, "log_prediction"))


@query("eval_regression", "SELECT " + metrics_sql("lineitem", "l_extendedprice", "l_quantity * CAST(2000 AS DOUBLE)"))
def eval_regression(spark, folder):
    """Measures of a given prediction column, without any fit."""
    rows = table(spark, folder, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000.0).alias("prediction"))
    return rounded_metrics(evaluate.regression_metrics(rows, "l_extendedprice"))


# Area under the curve from average ranks, over (high, r).
AREA_SQL = """count(*) AS n_rows, count(*) FILTER (high) AS n_positive,
  round((sum(r) FILTER (high) - CAST(count(*) FILTER (high) AS DOUBLE) * (count(*) FILTER (high) + 1) / 2)
        / (CAST(count(*) FILTER (high) AS DOUBLE) * count(*) FILTER (NOT high)), 6) AS area_under_roc"""


@query(
    "eval_auc",
    f"""WITH {DEALS_SQL}, marked AS (SELECT l_quantity AS score, net_price >= {HIGH_PRICE} AS high FROM deals),
        ranked AS (SELECT high, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM marked)
        SELECT {AREA_SQL} FROM ranked""",
)
def eval_auc(spark, folder):
    high = (F.col(DEAL_LABEL) >= HIGH_PRICE).cast("double")
    marked = roles.deals(spark, folder).select(high.alias("high"), F.col("l_quantity").alias("score"))
    found = evaluate.roc_frame(marked, "high", "score")
    return found.withColumn("area_under_roc", F.round("area_under_roc", 6))


@query(
    "model_comparison",
    f"WITH {LINE_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, {metrics_sql('lined', 'net_price', column)}"
        for name, column in (("mean", "mean_price"), ("median", "median_price"), ("line", "line_prediction"))
    ),
)
def model_comparison(spark, folder):
    """A model against both baselines, measured in one pass over the test part."""
    train, test = train_test(spark, folder)
    return rounded_metrics(compare_line_with_baselines(train, test, "l_quantity", DEAL_LABEL))


@query(
    "predictions_ranked",
    f"""WITH {LINE_SQL} SELECT {KEYS_SQL}, round(net_price, 6) AS net_price, round(line_prediction, 2) AS prediction FROM lined
        WHERE line_prediction < 60000 AND net_price < 60000 ORDER BY net_price DESC""",
)
def predictions_ranked(spark, folder):
    """Scored rows, dearest first, outliers left out."""
    train, test = train_test(spark, folder)
    scored = models.score(single_feature_fit(train), test)
    ranked = scored.orderBy(F.desc(DEAL_LABEL)).filter(f"prediction < 60000 AND {DEAL_LABEL} < 60000")
    return ranked.select(*SPLIT_KEYS, F.round(DEAL_LABEL, 6).alias(DEAL_LABEL), F.round("prediction", 2).alias("prediction"))


# A tree that may grow until every cell of two categories is a leaf predicts the cell means.
_CELLS_SQL = f"""{DEALS_SQL}, cells AS (
  SELECT size_band, l_linestatus, avg(net_price) AS prediction FROM deals WHERE part = 'train' GROUP BY ALL),
 predicted AS (SELECT part, net_price, prediction FROM deals JOIN cells USING (size_band, l_linestatus))"""
CELL_DEPTH = 24


@query(
    "tree_regression",
    f"WITH {_CELLS_SQL} SELECT part, {metrics_sql('predicted', 'net_price')} GROUP BY part",
)
def tree_regression(spark, folder):
    """50 categories exceed the default bins, which are raised to fit."""
    marked = assign_parts(roles.deals(spark, folder), SPLIT_KEYS)
    tree = models.decision_tree(DEAL_LABEL, maxDepth=CELL_DEPTH)
    scored = models.score(models.fit_trees(marked.filter("part = 'train'"), CELL_ROLES, tree), marked)
    return rounded_metrics(evaluate.regression_metrics_by(scored, "part", DEAL_LABEL))


_CELL_TREES = {"maxDepth": CELL_DEPTH, "featureSubsetStrategy": "all"}


@query("forest_cell_means", f"WITH {_CELLS_SQL} SELECT {metrics_sql("predicted WHERE part = 'test'", 'net_price')}")
def forest_cell_means(spark, folder):
    """A forest without resampling, grown until every cell is a leaf: the cell means once more."""
    train, test = train_test(spark, folder)
    forest = models.forest_regressor(DEAL_LABEL, numTrees=2, bootstrap=False, **_CELL_TREES)
    scored = models.score(models.fit_trees(train, CELL_ROLES, forest), test)
    return rounded_metrics(evaluate.regression_metrics(scored, DEAL_LABEL))


HIGH_VOLUME = 1000000.0
_HALVES_SQL = f"""{DEALS_SQL}, halves AS (
  SELECT part, CASE WHEN l_quantity <= 25 THEN 'small' ELSE 'large' END AS half,
         l_extendedprice * l_quantity >= {HIGH_VOLUME} AS high FROM deals),
 shares AS (SELECT half, CAST(count(*) FILTER (high) AS DOUBLE) / count(*) AS score FROM halves WHERE part = 'train' GROUP BY half),
 scored AS (SELECT high, score FROM halves JOIN shares USING (half) WHERE part = 'test'),
 ranked AS (SELECT high, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)"""


@query("forest_class_shares", f"WITH {_HALVES_SQL} SELECT {AREA_SQL} FROM ranked")
def forest_class_shares(spark, folder):
    """Two halves, mostly low and mostly high: the score of a row is the share of high volumes in its half."""
    half = F.when(F.col("l_quantity") <= 25, "small").otherwise("large")
    high = (F.col("l_extendedprice") * F.col("l_quantity") >= HIGH_VOLUME).cast("double")
    rows = roles.deals(spark, folder).select(*SPLIT_KEYS, half.alias("half"), high.alias("price_class"))
    train, test = split_parts(rows, SPLIT_KEYS)
    forest = models.forest_classifier("price_class", numTrees=2, bootstrap=False, featureSubsetStrategy="all")
    scored = models.score(models.fit_trees(train, ColumnRoles(["half"], []), forest), test)
    found = evaluate.roc_frame(scored, "price_class", "probability")
    return found.withColumn("area_under_roc", F.round("area_under_roc", 6))


_LOG_CELLS_SQL = f"""{DEALS_SQL}, cells AS (
  SELECT size_band, l_linestatus, exp(avg(ln(net_price))) AS prediction FROM deals WHERE part = 'train' GROUP BY ALL),
 predicted AS (SELECT net_price, prediction FROM deals JOIN cells USING (size_band, l_linestatus) WHERE part = 'test')"""


@query("boosting_cell_means", f"WITH {_LOG_CELLS_SQL} SELECT {metrics_sql('predicted', 'net_price')}")
def boosting_cell_means(spark, folder):
    """Boosted trees of the log price that reach the cell means in the first round and stay there."""
    train, test = (features.add_log(p, DEAL_LABEL, "label") for p in train_test(spark, folder))
    boosted = models.boosted_trees("label", maxIter=2, **_CELL_TREES)
    scored = models.score(models.fit_trees(train, CELL_ROLES, boosted), test)
    return rounded_metrics(evaluate.log_scale_metrics(scored, DEAL_LABEL, "prediction"))


def _default_tree(train: DataFrame):
    return models.fit_trees(train, ALL_ROLES, models.decision_tree(DEAL_LABEL))


_FEATURES = [*(f"{c}_index" for c in ALL_ROLES.categorical), *ALL_ROLES.numeric]


@query(
    "feature_importance",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS feature, true AS is_share, true AS sums_to_one" for i, name in enumerate(_FEATURES)
    ),
)
def feature_importance(spark, folder):
    """Every feature in its slot, with an importance that is a share of all."""
    train, _ = train_test(spark, folder)
    found = models.feature_importances(_default_tree(train), train)
    total = found.agg(F.sum("importance")).scalar()
    share = F.col("importance").between(0, 1).alias("is_share")
    return found.select("position", "feature", share, (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


# A tree of one split: all importance goes to the feature whose best cut of ordered categories explains most.
_STUMP_SQL = f"""{DEALS_SQL}, counted AS (
  SELECT 'l_returnflag_index' AS feature, l_returnflag AS label, count(*) AS n, sum(net_price) AS s
  FROM deals WHERE part = 'train' GROUP BY l_returnflag
  UNION ALL SELECT 'l_linestatus_index', l_linestatus, count(*), sum(net_price)
  FROM deals WHERE part = 'train' GROUP BY l_linestatus),
 cuts AS (
  SELECT feature, CAST(sum(n) OVER up_to AS DOUBLE) AS nl, sum(s) OVER up_to AS sl,
         CAST(sum(n) OVER whole AS DOUBLE) AS na, sum(s) OVER whole AS sa FROM counted
  WINDOW up_to AS (PARTITION BY feature ORDER BY s / n), whole AS (PARTITION BY feature)),
 gains AS (
  SELECT feature, max(nl * (na - nl) / (na * na) * pow(sl / nl - (sa - sl) / (na - nl), 2)) AS gain
  FROM cuts WHERE nl < na GROUP BY feature)"""


@query(
    "stump_importance",
    f"""WITH {_STUMP_SQL} SELECT feature, CAST(CASE WHEN gain = max(gain) OVER () THEN 1 ELSE 0 END AS DOUBLE) AS importance
        FROM gains""",
)
def stump_importance(spark, folder):
    train, _ = train_test(spark, folder)
    roles_used = ColumnRoles(["l_returnflag", "l_linestatus"], [])
    model = models.fit_trees(train, roles_used, models.decision_tree(DEAL_LABEL, maxDepth=1))
    return models.feature_importances(model, train).drop("position")


@query(
    "top_features",
    "SELECT CAST(k AS INTEGER) AS place, k = 1 AS is_price, true AS is_ranked FROM range(1, 6) AS r(k)",
)
def top_features(spark, folder):
    """Five features by falling importance; the price before discount and tax comes first."""
    train, _ = train_test(spark, folder)
    found = models.top_features(models.feature_importances(_default_tree(train), train)).collect()  # five rows
    falling = all(a["importance"] >= b["importance"] for a, b in zip(found, found[1:]))
    return spark.range(1, 1 + len(found)).select(
        F.col("id").cast("int").alias("place"),
        (F.col("id") == 1 + [r["feature"] for r in found].index("l_extendedprice")).alias("is_price"),
        F.lit(falling).alias("is_ranked"),
    )


FOREST_TREES = 20


def _beats_mean(df: DataFrame) -> DataFrame:
    """Whether measures are those of a model that explains most of the spread."""
    return df.select("n_rows", (F.col("r2") > 0.5).alias("beats_mean"))


@query(
    "rf_regression",
    f"""WITH {DEALS_SQL} SELECT count(*) AS n_rows, count(*) AS n_consistent, true AS beats_mean
        FROM deals WHERE part = 'test'""",
)
def rf_regression(spark, folder):
    """The forest's prediction is the mean of its trees on every row, and better than the mean price."""
    train, test = train_test(spark, folder)
    forest = models.forest_regressor(DEAL_LABEL, numTrees=FOREST_TREES)
    fitted = models.fit_trees(train, ALL_ROLES, forest)
    scored = models.score(fitted, test)
    for i, tree in enumerate(fitted.stages[-1].trees):
        scored = tree.setPredictionCol(f"tree{i}").transform(scored)
    mean = sum(F.col(f"tree{i}") for i in range(FOREST_TREES)) / FOREST_TREES
    scored = scored.select(DEAL_LABEL, "prediction", (F.abs(mean - F.col("prediction")) < 1e-6).alias("consistent"))
    with kept(scored) as rows:
        measured = _beats_mean(evaluate.regression_metrics(rows, DEAL_LABEL)).first()
        consistent = rows.filter("consistent").count()
    return spark.range(1).select(
        F.lit(measured["n_rows"]).alias("n_rows"), F.lit(consistent).cast("long").alias("n_consistent"),
        F.lit(measured["beats_mean"]).alias("beats_mean"),
    )


@query(
    "rf_classification",
    f"""WITH {DEALS_SQL} SELECT count(*) AS n_rows, count(*) FILTER (net_price >= {HIGH_PRICE}) AS n_positive, true AS separates
        FROM deals WHERE part = 'test'""",
)
def rf_classification(spark, folder):
    """High against low price; the price itself is dropped."""
    rows = roles.deals(spark, folder).withColumn("price_class", (F.col(DEAL_LABEL) >= HIGH_PRICE).cast("double"))
    train, test = split_parts(rows.drop(DEAL_LABEL), SPLIT_KEYS)
    forest = models.forest_classifier("price_class", numTrees=FOREST_TREES)
    scored = models.score(models.fit_trees(train, ALL_ROLES, forest), test)
    found = evaluate.roc_frame(scored, "price_class")
    return found.select("n_rows", "n_positive", (F.col("area_under_roc") > 0.9).alias("separates"))


@query(
    "gbt_regression",
    f"WITH {DEALS_SQL} SELECT count(*) AS n_rows, true AS beats_mean FROM deals WHERE part = 'test'",
)
def gbt_regression(spark, folder):
    """Boosted trees on the log price, measured in prices."""
    train, test = (features.add_log(p, DEAL_LABEL, "label") for p in train_test(spark, folder))
    scored = models.score(models.fit_trees(train, ALL_ROLES, models.boosted_trees("label")), test)
    return _beats_mean(evaluate.log_scale_metrics(scored, DEAL_LABEL, "prediction"))


_RATED_SQL = f"""{PRICED_SQL}, rated AS (
  SELECT rating_value AS rating, avg(rating_value) OVER () AS mean_prediction, median(rating_value) OVER () AS median_prediction
  FROM priced)"""


@query(
    "baseline_missing",
    f"WITH {_RATED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, {metrics_sql('rated WHERE rating IS NOT NULL', 'rating', f'{name}_prediction')}" for name in ("mean", "median")
    ),
)
def baseline_missing(spark, folder):
    """Baselines of a label with null and NaN, which neither they nor their measures count."""
    rows = roles.listings(spark, folder).select("rating")
    names = {"mean": "mean_prediction", "median": "median_prediction"}
    return rounded_metrics(evaluate.compare_predictions(evaluate.add_baselines(rows, rows, "rating"), "rating", names))


@query(
    "model_roundtrip",
    f"""WITH {DEALS_SQL} SELECT count(*) AS n_rows, count(*) AS n_equal, CAST(5 AS BIGINT) AS n_examples
        FROM deals WHERE part = 'test'""",
)
def model_roundtrip(spark, folder):
    """Logged with example rows, loaded by run and scored: the same predictions again."""
    train, test = train_test(spark, folder)
    model = models.fit_linear(train, FEW_ROLES, DEAL_LABEL)
    log = RunLog(spark, shared_path(spark, "runs"))
    run = log.record("deals", "linear", {"label": DEAL_LABEL}, {}, model, (train, SPLIT_KEYS))
    log.flush()
    scored = models.score(model, test).select(
        *FEW_ROLES.categorical, *FEW_ROLES.numeric, F.col("prediction").alias("first")
    )
    again = models.score(log.load_model(run), scored)
    n_examples = spark.read.parquet(f"{log.root}/examples/{run}").agg(F.count(F.lit(1))).scalar()
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("first")).alias("n_equal")
    ).withColumn("n_examples", n_examples)


# Clean, split, fit on the imputed table, and measure against the baselines.
_RENTAL_SQL = f"""{CLEAN_LISTINGS_SQL}, rental AS (
  SELECT *, CASE WHEN {hash_share_sql(SPLIT_KEYS)} < CAST(0.8 AS DOUBLE)
            THEN 'train' ELSE 'test' END AS part FROM cleaned),
 line AS (SELECT regr_slope(price, rooms) AS slope, regr_intercept(price, rooms) AS intercept,
                 avg(price) AS mean_price, median(price) AS median_price FROM rental WHERE part = 'train'),
 lined AS (SELECT rental.*, intercept + slope * rooms AS line_prediction, mean_price, median_price
           FROM rental, line WHERE part = 'test')"""


@query(
    "clean_split_fit",
    f"WITH {_RENTAL_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, {metrics_sql('lined', 'price', column)}"
        for name, column in (("mean", "mean_price"), ("median", "median_price"), ("line", "line_prediction"))
    ),
)
def flagship(spark, folder):
    """From currency text to a model measured against its baselines."""
    path = overwrite_table(cleaned_listings(spark, folder), shared_path(spark, "rental"))
    train, test = split_parts(read_table(spark, path).select(*SPLIT_KEYS, "rooms", "price"), SPLIT_KEYS)
    return rounded_metrics(compare_line_with_baselines(train, test, "rooms", "price"))


_LOG_FEW_SQL = least_squares_sql("deals", _FEW, "ln(net_price)", ["net_price"], prefix="g")
_LOG_SCORED_SQL = f"{DEALS_SQL}, {_LOG_FEW_SQL}, scored AS (SELECT net_price, exp(prediction) AS p FROM g_fit WHERE NOT is_train)"


@query("ols_formula_log", f"WITH {_LOG_SCORED_SQL} SELECT {metrics_sql('scored', 'net_price', 'p')}")
def ols_formula_log(spark, folder):
    """A formula that leaves the price out of the features of its own logarithm."""
    names = [*FEW_ROLES.categorical, *FEW_ROLES.numeric, DEAL_LABEL]
    train, test = (part.select(*names) for part in train_test(spark, folder))
    with stored(features.add_log(train, DEAL_LABEL, "log_price")) as rows:
        model = models.fit_formula(rows, f"log_price ~ . - {DEAL_LABEL}", "log_price", "log_prediction")
    scored = models.score(model, test)
    return rounded_metrics(evaluate.log_scale_metrics(scored, DEAL_LABEL, "log_prediction"))


@query(
    "model_promotion",
    f"""WITH {_FEW_SQL}, {_LOG_FEW_SQL}, scored AS (SELECT net_price, exp(prediction) AS p FROM g_fit WHERE NOT is_train),
        measured AS (
          SELECT CAST(1 AS BIGINT) AS version, '0' AS data_version, {metrics_sql('s_fit WHERE NOT is_train')}
          UNION ALL SELECT CAST(2 AS BIGINT), '1', {metrics_sql('scored', 'net_price', 'p')})
        SELECT version, CASE WHEN rmse = min(rmse) OVER () THEN 'Production' ELSE 'Archived' END AS stage,
               data_version, rmse, r2 FROM measured""",
)
def model_promotion(spark, folder):
    """Two versions of the train table, two tracked and registered models, the better one in production."""
    names = [*FEW_ROLES.categorical, *FEW_ROLES.numeric, DEAL_LABEL]
    train, test = (part.select(*names) for part in train_test(spark, folder))
    return rounded_metrics(promote_best(spark, train, test, DEAL_LABEL, "net-price", shared_path(spark, "promotion")))
