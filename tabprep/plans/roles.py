"""The given tables in the roles of the data sets worked on, with repeatable dirt.

The given tables are clean, so every defect is injected as a pure expression of
key columns, written once for Spark and once as SQL (``*_SQL``) for checking.
No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.text import format_ssn
from tabprep.plans.catalog import table

SPLIT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def hash_share_sql(keys: list[str], seed: str = "42") -> str:
    """SQL for ``unit_interval``."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{seed}', {text})), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as employees: mixed-case names, numbers in two formats or null, and
    a second, differently written copy of every fifth row."""
    key = F.col("c_custkey")
    digits = F.lpad(((key * 7919 + 1) % 1000000000).cast("string"), 9, "0")
    spelling = key + F.col("copy")
    return (
        table(spark, folder, "customer")
        .withColumn("copy", F.explode(F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            F.when(spelling % 3 == 0, F.upper("c_mktsegment")).otherwise(F.initcap("c_mktsegment")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(key % 97 != 0, F.when(spelling % 2 == 0, format_ssn(digits)).otherwise(digits)).alias("ssn"),
            F.col("c_acctbal").alias("salary"),
            F.col("c_nationkey").alias("department"),
        )
    )


EMPLOYEES_SQL = """employees AS (
  SELECT CASE WHEN spelling % 3 = 0 THEN upper(c_mktsegment)
              ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS first_name,
         c_name AS last_name,
         CASE WHEN c_custkey % 97 = 0 THEN NULL
              WHEN spelling % 2 = 0 THEN substr(digits, 1, 3) || '-' || substr(digits, 4, 2) || '-' || substr(digits, 6, 4)
              ELSE digits END AS ssn,
         c_acctbal AS salary, c_nationkey AS department
  FROM (SELECT *, c_custkey + copy AS spelling, lpad(CAST((c_custkey * 7919 + 1) % 1000000000 AS VARCHAR), 9, '0') AS digits
        FROM (SELECT *, unnest(CASE WHEN c_custkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM customer)))"""

REPAIRED_SQL = (
    EMPLOYEES_SQL
    + """, repaired AS (
  SELECT upper(substr(first_name, 1, 1)) || lower(substr(first_name, 2)) AS first_name, last_name,
         CASE WHEN contains(ssn, '-') THEN ssn
              ELSE substr(ssn, 1, 3) || '-' || substr(ssn, 4, 2) || '-' || substr(ssn, 6, 4) END AS ssn,
         salary, department
  FROM employees WHERE ssn IS NOT NULL)"""
)

LISTING_NAMES = [*SPLIT_KEYS, "superhost", "room_type", "rooms", "rating", "tax", "minimum_nights", "price"]


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as listings: currency text with gaps, zeros, negatives and words; numbers with nulls and NaN."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    amount = F.format_number("l_extendedprice", 2)
    return table(spark, folder, "lineitem").select(
        *SPLIT_KEYS,
        F.when(part % 19 != 0, F.col("l_returnflag")).alias("superhost"),
        F.col("l_linestatus").alias("room_type"),
        F.when(supplier % 11 != 0, F.col("l_quantity").cast("int")).alias("rooms"),
        F.when(part % 17 == 0, None)
        .when(order % 13 == 0, F.lit("NaN").cast("double"))
        .otherwise(F.col("l_discount") * 100)
        .alias("rating"),
        F.col("l_tax").alias("tax"),
        (part % 500).cast("int").alias("minimum_nights"),
        F.when(order % 7 == 0, None)
        .when(order % 101 == 0, "N/A")
        .when(order % 103 == 0, "$0.00")
        .when(order % 53 == 0, F.concat(F.lit("$-"), amount))
        .otherwise(F.concat(F.lit("$"), amount))
        .alias("price"),
    )


LISTINGS_SQL = """listings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_partkey % 19 <> 0 THEN l_returnflag END AS superhost,
         l_linestatus AS room_type,
         CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_quantity AS INTEGER) END AS rooms,
         CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE l_discount * 100 END AS rating,
         l_tax AS tax, CAST(l_partkey % 500 AS INTEGER) AS minimum_nights,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'N/A'
              WHEN l_orderkey % 103 = 0 THEN '$0.00'
              WHEN l_orderkey % 53 = 0 THEN concat('$-', format('{:,.2f}', l_extendedprice))
              ELSE concat('$', format('{:,.2f}', l_extendedprice)) END AS price
  FROM lineitem)"""

PRICED_SQL = (
    LISTINGS_SQL
    + """, priced AS (
  SELECT * REPLACE (TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS price),
         CASE WHEN isnan(rating) THEN NULL ELSE rating END AS rating_value
  FROM listings)"""
)

DEAL_LABEL = "net_price"
DEAL_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def deals(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a price that models can learn; 50 size bands exceed the default tree bins."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    band = F.concat(F.lit("Q"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"))
    return table(spark, folder, "lineitem").select(
        *SPLIT_KEYS,
        "l_returnflag",
        "l_linestatus",
        band.alias("size_band"),
        *DEAL_NUMBERS,
        net.alias(DEAL_LABEL),
    )


def deals_sql(weights: tuple[tuple[str, float], ...] = (("train", 0.8), ("test", 1.0))) -> str:
    """SQL for ``deals`` with the part of every row; ``weights`` are cumulative."""
    cases = " ".join(f"WHEN share < CAST({bound} AS DOUBLE) THEN '{name}'" for name, bound in weights[:-1])
    return f"""deals AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         'Q' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS size_band,
         l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net_price,
         CASE {cases} ELSE '{weights[-1][0]}' END AS part,
         CAST(floor(fold_share * 3) AS INTEGER) AS fold
  FROM (SELECT *, {hash_share_sql(SPLIT_KEYS)} AS share, {hash_share_sql(SPLIT_KEYS, "42-fold")} AS fold_share
        FROM lineitem))"""


DEALS_SQL = deals_sql()
THREE_WAY = (("train", 0.6), ("validation", 0.8), ("test", 1.0))
