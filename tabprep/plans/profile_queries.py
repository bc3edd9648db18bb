"""Queries over profiles, orderings and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators import profile, split
from tabprep.plans.catalog import query, table
from tabprep.plans.cleaning_queries import KEYS, KEYS_SQL, priced
from tabprep.plans.roles import PRICED_SQL, hash_share_sql


def _rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return profile.row_count(table(spark, folder, "lineitem"))


@query(
    "group_count_ordered",
    f"WITH {PRICED_SQL} SELECT minimum_nights, count(*) AS n_rows FROM priced GROUP BY minimum_nights ORDER BY 2 DESC, 1",
)
def group_count_ordered(spark, folder):
    return profile.group_counts(priced(spark, folder), "minimum_nights")


@query("median_exact", "SELECT median(l_extendedprice) AS median FROM lineitem")
def median_exact(spark, folder):
    return profile.median_frame(table(spark, folder, "lineitem"), "l_extendedprice")


def _describe_sql(name: str, value: str) -> str:
    return f"""SELECT '{name}' AS column_name, count({value}) AS n, round(avg({value}), 4) AS mean,
        round(stddev_samp({value}), 4) AS stddev, CAST(min({value}) AS DOUBLE) AS min_value,
        CAST(max({value}) AS DOUBLE) AS max_value"""


PROFILED = {"rooms": "rooms", "rating": "rating_value", "minimum_nights": "minimum_nights", "price": "price"}


@query(
    "profile_describe",
    f"WITH {PRICED_SQL} " + " UNION ALL ".join(f"{_describe_sql(n, v)} FROM priced" for n, v in PROFILED.items()),
)
def profile_describe(spark, folder):
    found = profile.describe_numeric(priced(spark, folder), list(PROFILED))
    return _rounded(found, "mean", "stddev")


@query(
    "profile_text",
    f"""WITH {PRICED_SQL} SELECT 'superhost' AS column_name, count(superhost) AS n, min(superhost) AS min_text,
        max(superhost) AS max_text FROM priced
        UNION ALL SELECT 'room_type', count(room_type), min(room_type), max(room_type) FROM priced""",
)
def profile_text(spark, folder):
    return profile.describe_text(priced(spark, folder))


def _summary_sql(name: str, value: str) -> str:
    parts = ", ".join(
        f"CAST(quantile_disc({value}, {q}) AS DOUBLE) AS {column}"
        for q, column in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    )
    return f"{_describe_sql(name, value)}, {parts} FROM priced"


@query(
    "profile_summary",
    f"WITH {PRICED_SQL} " + " UNION ALL ".join(_summary_sql(n, v) for n, v in PROFILED.items()),
)
def profile_summary(spark, folder):
    return _rounded(profile.summarize(priced(spark, folder), list(PROFILED)), "mean", "stddev")


_COMPLETE = "rooms IS NOT NULL AND rating_value IS NOT NULL AND price IS NOT NULL AND superhost IS NOT NULL"


@query(
    "null_profile",
    f"WITH {PRICED_SQL}, t AS (SELECT count(*) AS n_rows, count(*) FILTER ({_COMPLETE}) AS n_complete FROM priced) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, n_rows, n_complete, (SELECT count(*) - count({v}) FROM priced) AS n_missing FROM t"
        for n, v in {**PROFILED, "superhost": "superhost"}.items()
    ),
)
def null_profile(spark, folder):
    return profile.null_profile(priced(spark, folder), [*PROFILED, "superhost"])


@query(
    "histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / CAST(100 AS DOUBLE)), 4) AS low,
              (SELECT count(*) FROM lineitem WHERE b =
                  least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / CAST(100 AS DOUBLE))) AS BIGINT), 99)) AS n_rows
       FROM range(100) AS r(b), e""",
)
def histogram(spark, folder):
    return _rounded(profile.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 100), "low")


@query(
    "histogram_gaps",
    """WITH v AS (SELECT CASE WHEN l_partkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_quantity * l_quantity * l_quantity END AS x
                  FROM lineitem),
       e AS (SELECT min(x) AS lo, max(x) AS hi FROM v WHERE NOT isnan(x))
       SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / CAST(200 AS DOUBLE)), 4) AS low,
              (SELECT count(*) FROM v WHERE NOT isnan(x)
                  AND b = least(CAST(floor((x - lo) / ((hi - lo) / CAST(200 AS DOUBLE))) AS BIGINT), 199)) AS n_rows
       FROM range(200) AS r(b), e""",
)
def histogram_gaps(spark, folder):
    """A skew column with NaN whose upper bins are mostly empty."""
    q = F.col("l_quantity")
    cube = F.when(F.col("l_partkey") % 7 == 0, F.lit("NaN").cast("double")).otherwise(q * q * q)
    rows = table(spark, folder, "lineitem").select(cube.alias("x"))
    return _rounded(profile.histogram(rows, "x", 200), "low")


@query(
    "topk_generic",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def topk_generic(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return profile.top_k(orders, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "limit_example",
    "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 5",
)
def limit_example(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return profile.example_rows(part, ["p_partkey"])


_SHARE = hash_share_sql(KEYS)


@query(
    "split_train_test",
    f"""SELECT {KEYS_SQL}, CASE WHEN share < CAST(0.8 AS DOUBLE) THEN 'train' ELSE 'test' END AS part
        FROM (SELECT *, {_SHARE} AS share FROM lineitem)""",
)
def split_train_test(spark, folder):
    keys = table(spark, folder, "lineitem").select(*KEYS)
    return split.assign_parts(keys, KEYS)


@query(
    "split_train_val_test",
    f"""SELECT {KEYS_SQL}, CASE WHEN share < CAST(0.6 AS DOUBLE) THEN 'train'
        WHEN share < CAST(0.8 AS DOUBLE) THEN 'validation' ELSE 'test' END AS part
        FROM (SELECT *, {_SHARE} AS share FROM lineitem)""",
)
def split_train_val_test(spark, folder):
    keys = table(spark, folder, "lineitem").select(*KEYS)
    return split.assign_parts(keys, KEYS, (0.6, 0.2, 0.2), ("train", "validation", "test"))


@query(
    "kfold_assign",
    f"""SELECT {KEYS_SQL}, CAST(floor(share * 3) AS INTEGER) AS fold
        FROM (SELECT *, {hash_share_sql(KEYS, "42-fold")} AS share FROM lineitem)""",
)
def kfold_assign(spark, folder):
    return split.assign_folds(table(spark, folder, "lineitem").select(*KEYS), KEYS)
