"""Queries over imputation, encoding, vectors and formulas."""

from __future__ import annotations

from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from tabprep.operators import features, impute
from tabprep.operators.label_ranks import LabelRanker
from tabprep.operators.split import split_parts
from tabprep.operators.wide_formula import WideFormula
from tabprep.plans import roles
from tabprep.plans.catalog import query, table
from tabprep.plans.cleaning_queries import KEYS, KEYS_SQL, priced
from tabprep.plans.roles import DEALS_SQL, LISTINGS_SQL, PRICED_SQL, hash_share_sql
from tabprep.session import shared_path


def _imputed_sql(statistics: str) -> str:
    return f"""WITH {PRICED_SQL}, s AS ({statistics}) SELECT {KEYS_SQL},
        round(coalesce(CAST(rooms AS DOUBLE), m_rooms), 6) AS rooms,
        round(coalesce(rating_value, m_rating), 6) AS rating FROM priced, s"""


def _imputed(df):
    return df.select(*KEYS, *[F.round(n, 6).alias(n) for n in ("rooms", "rating")])


@query(
    "impute_mean",
    _imputed_sql("SELECT avg(rooms) AS m_rooms, avg(rating_value) AS m_rating FROM priced"),
)
def impute_mean(spark, folder):
    return _imputed(impute.impute_mean(roles.listings(spark, folder), ["rooms", "rating"]))


@query(
    "impute_median",
    _imputed_sql(
        "SELECT quantile_disc(CAST(rooms AS DOUBLE), 0.5) AS m_rooms, quantile_disc(rating_value, 0.5) AS m_rating FROM priced"
    ),
)
def impute_median(spark, folder):
    return _imputed(impute.impute_median(roles.listings(spark, folder), ["rooms", "rating"]))


def _mode_sql(value: str) -> str:
    return f"""(SELECT CAST({value} AS DOUBLE) FROM priced WHERE {value} IS NOT NULL
        GROUP BY {value} ORDER BY count(*) DESC, {value} LIMIT 1)"""


@query(
    "impute_mode",
    _imputed_sql(f"SELECT {_mode_sql('rooms')} AS m_rooms, {_mode_sql('rating_value')} AS m_rating"),
)
def impute_mode(spark, folder):
    return _imputed(impute.impute_mode(roles.listings(spark, folder), ["rooms", "rating"]))


@query(
    "impute_stage",
    _imputed_sql("SELECT avg(rooms) AS m_rooms, avg(rating_value) AS m_rating FROM priced"),
)
def impute_stage(spark, folder):
    """Mean imputation as a pipeline stage."""
    rows = roles.listings(spark, folder).withColumn("rooms", F.col("rooms").cast("double"))
    stage: Imputer = impute.imputer_stage(["rooms", "rating"])
    return _imputed(stage.fit(rows.select("rooms", "rating")).transform(rows))


@query(
    "impute_category",
    f"WITH {LISTINGS_SQL} SELECT {KEYS_SQL}, coalesce(superhost, 'absent') AS superhost FROM listings",
)
def impute_category(spark, folder):
    return impute.impute_category(roles.listings(spark, folder).select(*KEYS, "superhost"), ["superhost"])


@query(
    "impute_category_mode",
    f"""WITH {LISTINGS_SQL}, best AS (
          SELECT superhost AS mode FROM listings WHERE superhost IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT {KEYS_SQL}, coalesce(superhost, mode) AS superhost FROM listings, best""",
)
def impute_category_mode(spark, folder):
    return impute.impute_text_mode(roles.listings(spark, folder).select(*KEYS, "superhost"), ["superhost"])


@query(
    "impute_constant",
    _imputed_sql("SELECT CAST(0 AS DOUBLE) AS m_rooms, CAST(0 AS DOUBLE) AS m_rating"),
)
def impute_constant(spark, folder):
    rows = roles.listings(spark, folder).withColumn("rooms", F.col("rooms").cast("double"))
    return _imputed(impute.impute_zero(rows, ["rooms", "rating"]))


def _index_sql(source: str, column: str) -> str:
    """Label to index by falling frequency, then label."""
    return f"""SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_index
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


@query(
    "string_index",
    f"""WITH i AS ({_index_sql('part', 'p_brand')})
        SELECT p_partkey, p_brand, p_brand_index FROM part JOIN i USING (p_brand)""",
)
def string_index(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    return features.fit_indexer(part, ["p_brand"]).transform(part)


@query(
    "string_index_wide",
    f"""WITH i AS ({_index_sql('lineitem', 'l_partkey')})
        SELECT l_orderkey, l_linenumber, l_partkey, l_partkey_index FROM lineitem JOIN i USING (l_partkey)""",
)
def string_index_wide(spark, folder):
    """The index of a column with more labels than one machine should hold."""
    return features.index_wide(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")


_WIDE_SQL = f"""rows AS (
  SELECT l_orderkey, l_linenumber, l_partkey, {hash_share_sql(['l_orderkey', 'l_linenumber'])} AS share FROM lineitem),
 train AS (SELECT * FROM rows WHERE share < CAST(0.1 AS DOUBLE)), test AS (SELECT * FROM rows WHERE share >= CAST(0.1 AS DOUBLE))"""


@query(
    "string_index_wide_split",
    f"""WITH {_WIDE_SQL}, i AS ({_index_sql('train', 'l_partkey')}), n AS (SELECT CAST(count(*) AS DOUBLE) AS labels FROM i)
        SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_partkey_index, labels) AS l_partkey_index,
               l_partkey_index IS NOT NULL AS seen
        FROM test LEFT JOIN i USING (l_partkey), n""",
)
def string_index_wide_split(spark, folder):
    """Fitted on a small train part and applied to the test part, where many labels are unseen."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    train, test = split_parts(rows, ["l_orderkey", "l_linenumber"], (0.1, 0.9))
    index = features.WideIndex.fit(train, "l_partkey", shared_path(spark, "labels"))
    indexed = index.transform(test, "keep")
    n_labels = index.labels(spark).agg(F.count(F.lit(1))).scalar()
    return indexed.withColumn("seen", F.col("l_partkey_index") < n_labels)


_LABELLED_SQL = f"""labelled AS (
  SELECT p_partkey, p_brand || '-' || CAST(p_size AS VARCHAR) AS model, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS kind,
         {hash_share_sql(['p_partkey'])} AS share FROM part),
 train AS (SELECT * FROM labelled WHERE share < CAST(0.8 AS DOUBLE))"""


@query(
    "string_index_multi_skip",
    f"""WITH {_LABELLED_SQL}, a AS ({_index_sql('train', 'model')}), b AS ({_index_sql('train', 'kind')})
        SELECT p_partkey, model_index, kind_index FROM labelled JOIN a USING (model) JOIN b USING (kind)
        WHERE share >= CAST(0.8 AS DOUBLE)""",
)
def string_index_multi_skip(spark, folder):
    """Fitted on the train part; test rows with an unseen or missing label are dropped."""
    labelled = table(spark, folder, "part").select(
        "p_partkey",
        F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("model"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("kind"),
    )
    train, test = split_parts(labelled, ["p_partkey"])
    indexed = features.fit_indexer(train, ["model", "kind"], "skip").transform(test)
    return indexed.select("p_partkey", "model_index", "kind_index")


def _slots(df, column: str, n: int, *names: str):
    arrays = features.vectors_to_arrays(df, [column])
    return arrays.select(*names, *[F.col(column)[i].alias(f"slot{i}") for i in range(n)])


def _slots_sql(n: int) -> str:
    return ", ".join(f"CAST(CASE WHEN p_type_index = {i} THEN 1 ELSE 0 END AS DOUBLE) AS slot{i}" for i in range(n))


_TYPE_SLOTS = 5  # six part types, the last one is all zeros
_TYPED_SQL = f"WITH i AS ({_index_sql('part', 'p_type')}), typed AS (SELECT * FROM part JOIN i USING (p_type))"


@query("one_hot", f"{_TYPED_SQL} SELECT p_partkey, {_slots_sql(_TYPE_SLOTS)} FROM typed")
def one_hot(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    indexed = features.fit_indexer(part, ["p_type"]).transform(part)
    encoded = features.one_hot_stage(["p_type"]).fit(indexed).transform(indexed)
    return _slots(encoded, "p_type_onehot", _TYPE_SLOTS, "p_partkey")


@query(
    "assemble_vector",
    f"""WITH {PRICED_SQL}, m AS (SELECT quantile_disc(CAST(rooms AS DOUBLE), 0.5) AS m_rooms FROM priced)
        SELECT {KEYS_SQL}, coalesce(CAST(rooms AS DOUBLE), m_rooms) AS slot0, tax AS slot1,
        CAST(minimum_nights AS DOUBLE) AS slot2 FROM priced, m""",
)
def assemble_vector(spark, folder):
    """Imputed first, as the assembler rejects missing numbers."""
    rows = impute.impute_median(roles.listings(spark, folder), ["rooms"])
    vectors = features.assembler_stage(["rooms", "tax", "minimum_nights"]).transform(rows)
    return _slots(vectors, "features", 3, *KEYS)


@query(
    "rformula_terms",
    f"""{_TYPED_SQL} SELECT p_partkey, p_retailprice AS label, {_slots_sql(_TYPE_SLOTS)},
        CAST(p_size AS DOUBLE) AS slot{_TYPE_SLOTS} FROM typed""",
)
def rformula_terms(spark, folder):
    part = table(spark, folder, "part")
    formula = features.formula_stage("p_retailprice ~ p_type + p_size")
    return _slots(formula.fit(part).transform(part), "features", _TYPE_SLOTS + 1, "p_partkey", "label")


_ALL_SQL = (
    f"""WITH typed_part AS (
          SELECT CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS p_type, p_size, p_retailprice FROM part),
        i AS ({_index_sql('typed_part', 'p_type')}), typed AS (SELECT * FROM typed_part JOIN i USING (p_type))
        SELECT p_retailprice AS label, {_slots_sql(_TYPE_SLOTS)}, CAST(p_size AS DOUBLE) AS slot{_TYPE_SLOTS} FROM typed"""
)


def _typed_part(spark, folder):
    return table(spark, folder, "part").select(
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("p_type"), "p_size", "p_retailprice"
    )


@query("rformula_all", _ALL_SQL)
def rformula_all(spark, folder):
    """Label against all other columns; rows without a category are skipped."""
    part = _typed_part(spark, folder)
    formula = features.formula_stage("p_retailprice ~ .", handle_invalid="skip")
    return _slots(formula.fit(part).transform(part), "features", _TYPE_SLOTS + 1, "label")


@query("rformula_wide", _ALL_SQL)
def rformula_wide(spark, folder):
    """The same formula with its labels kept as a table."""
    part = _typed_part(spark, folder)
    formula = WideFormula.fit(part, "p_retailprice ~ .", shared_path(spark, "formula"))
    return _slots(formula.transform(part), "features", _TYPE_SLOTS + 1, "label")


@query(
    "rformula_minus",
    f"""{_TYPED_SQL} SELECT round(ln(p_retailprice), 6) AS label, {_slots_sql(_TYPE_SLOTS)},
        CAST(p_size AS DOUBLE) AS slot{_TYPE_SLOTS} FROM typed""",
)
def rformula_minus(spark, folder):
    """The log of a price against all columns but the price itself."""
    part = table(spark, folder, "part").select("p_type", "p_size", "p_retailprice")
    logged = features.add_log(part, "p_retailprice", "log_price")
    formula = features.formula_stage("log_price ~ . - p_retailprice", handle_invalid="skip")
    slots = _slots(formula.fit(logged).transform(logged), "features", _TYPE_SLOTS + 1, "label")
    return slots.withColumn("label", F.round("label", 6))


@query(
    "log_target",
    f"""WITH {PRICED_SQL} SELECT {KEYS_SQL}, round(CASE WHEN price > 0 THEN ln(price) END, 6) AS log_price,
        round(exp(CASE WHEN price > 0 THEN ln(price) END), 4) AS restored FROM priced""",
)
def log_target(spark, folder):
    logged = features.add_log(priced(spark, folder), "price", "log_price")
    restored = features.undo_log(logged, "log_price", "restored")
    return restored.select(*KEYS, F.round("log_price", 6).alias("log_price"), F.round("restored", 4).alias("restored"))


_RANKS_SQL = f"""{DEALS_SQL}, labelled AS (SELECT *, 'P' || CAST(l_partkey AS VARCHAR) AS part_label FROM deals),
 prior AS (SELECT avg(net_price) AS mean_price FROM labelled WHERE part = 'train'),
 scored AS (SELECT part_label, round((sum(net_price) + 10 * mean_price) / (count(*) + 10), 6) AS score
   FROM labelled, prior WHERE part = 'train' GROUP BY part_label, mean_price),
 ranked AS (SELECT part_label, row_number() OVER (ORDER BY score, part_label) - 1 AS r FROM scored)"""


@query(
    "label_ranks",
    f"""WITH {_RANKS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(coalesce(r, (SELECT count(*) FROM scored, prior WHERE score < round(mean_price, 6))) AS DOUBLE) AS part_rank
        FROM labelled LEFT JOIN ranked USING (part_label) WHERE part = 'test'""",
)
def label_ranks(spark, folder):
    """Labels as ranks by their smoothed mean price of the train part; labels only the test part has stand at the mean."""
    rows = roles.deals(spark, folder).withColumn("part_label", F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
    train, test = split_parts(rows, roles.SPLIT_KEYS)
    ranker = LabelRanker(inputCol="part_label", outputCol="part_rank", labelCol=roles.DEAL_LABEL)
    return ranker.fit(train).transform(test).select(*roles.SPLIT_KEYS, "part_rank")
