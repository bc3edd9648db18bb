"""Queries over projections, filters, text repair and row cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions import text
from tabprep.functions.columns import column_roles
from tabprep.operators import clean
from tabprep.plans import roles
from tabprep.plans.catalog import query, table
from tabprep.plans.employees import clean_employees
from tabprep.plans.listings import clean_listings
from tabprep.plans.roles import EMPLOYEES_SQL, LISTINGS_SQL, PRICED_SQL, REPAIRED_SQL
from tabprep.session import shared_path
from tabprep.sources.tables import describe_schema, overwrite_table, read_table

PRICE_RANGE = (0.0, 50000.0)
KEYS = roles.SPLIT_KEYS
KEYS_SQL = ", ".join(KEYS)


def priced(spark, folder):
    return clean.clean_currency(roles.listings(spark, folder), "price")


@query(
    "select_columns",
    "SELECT l_orderkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def select_columns(spark, folder):
    names = ["l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    return clean.select_columns(table(spark, folder, "lineitem"), names)


@query("clean_currency", f"WITH {PRICED_SQL} SELECT {KEYS_SQL}, price FROM priced")
def clean_currency(spark, folder):
    return priced(spark, folder).select(*KEYS, "price")


@query(
    "filter_price_range",
    f"WITH {PRICED_SQL} SELECT {KEYS_SQL}, price FROM priced WHERE price > 0 AND price < 50000",
)
def filter_price_range(spark, folder):
    return clean.filter_open_range(priced(spark, folder), "price", *PRICE_RANGE).select(*KEYS, "price")


@query(
    "filter_outliers",
    f"WITH {LISTINGS_SQL} SELECT {KEYS_SQL}, minimum_nights FROM listings WHERE minimum_nights <= 365",
)
def filter_outliers(spark, folder):
    return clean.filter_upper_bound(roles.listings(spark, folder), "minimum_nights").select(*KEYS, "minimum_nights")


@query(
    "filter_sql_string",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 250000 AND o_orderstatus <> 'P'",
)
def filter_sql_string(spark, folder):
    predicate = "o_totalprice < 250000 AND o_orderstatus <> 'P'"
    return clean.filter_sql(table(spark, folder, "orders"), predicate).select("o_orderkey", "o_totalprice")


@query(
    "cast_ints_to_double",
    f"""WITH {LISTINGS_SQL} SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
        CAST(rooms AS DOUBLE) AS rooms, CAST(minimum_nights AS DOUBLE) AS minimum_nights, room_type FROM listings""",
)
def cast_ints_to_double(spark, folder):
    names = ["l_orderkey", "l_linenumber", "rooms", "minimum_nights", "room_type"]
    return clean.cast_numbers_to_double(roles.listings(spark, folder).select(*names))


@query(
    "missing_flags",
    f"""WITH {PRICED_SQL} SELECT {KEYS_SQL},
        CAST(CASE WHEN rooms IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS rooms_na,
        CAST(CASE WHEN rating_value IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS rating_na FROM priced""",
)
def missing_flags(spark, folder):
    flagged = clean.add_missing_flags(roles.listings(spark, folder), ["rooms", "rating"])
    return flagged.select(*KEYS, "rooms_na", "rating_na")


@query(
    "label_binarize",
    f"""WITH {PRICED_SQL} SELECT {KEYS_SQL},
        CAST(CASE WHEN price >= 25000 THEN 1 WHEN price < 25000 THEN 0 END AS DOUBLE) AS price_class FROM priced""",
)
def label_binarize(spark, folder):
    rows = priced(spark, folder).select(*KEYS, "price")
    return clean.binary_label(rows, "price", "price_class", 25000.0)


@query(
    "label_missing",
    f"""WITH {PRICED_SQL} SELECT {KEYS_SQL},
        CAST(CASE WHEN rating_value >= 5 THEN 1 WHEN rating_value < 5 THEN 0 END AS DOUBLE) AS rated_high FROM priced""",
)
def label_missing(spark, folder):
    """A source with null and NaN: both stay without a class."""
    return clean.binary_label(roles.listings(spark, folder).select(*KEYS, "rating"), "rating", "rated_high", 5.0)


@query(
    "column_roles",
    f"""WITH {LISTINGS_SQL} SELECT 'superhost' AS column_name, 'categorical' AS role, count(superhost) AS n_values FROM listings
        UNION ALL SELECT 'room_type', 'categorical', count(room_type) FROM listings
        UNION ALL SELECT 'rooms', 'numeric', count(rooms) FROM listings
        UNION ALL SELECT 'rating', 'numeric', count(rating) FROM listings
        UNION ALL SELECT 'tax', 'numeric', count(tax) FROM listings
        UNION ALL SELECT 'minimum_nights', 'numeric', count(minimum_nights) FROM listings""",
)
def column_roles_query(spark, folder):
    """The role of every feature column, with its number of values."""
    rows = priced(spark, folder)
    found = column_roles(rows, labels=["price"], exclude=KEYS)
    role = F.when(F.col("column_name").isin(*found.categorical), "categorical").otherwise("numeric")
    listed = describe_schema(rows.select(*found.categorical, *found.numeric))
    return listed.select("column_name", role.alias("role"), "n_values")


@query(
    "ssn_format_partition",
    f"""WITH {EMPLOYEES_SQL} SELECT last_name, ssn, 'hyphenated' AS format FROM employees WHERE contains(ssn, '-')
        UNION ALL SELECT last_name, ssn, 'plain' FROM employees WHERE NOT contains(ssn, '-')""",
)
def ssn_format_partition(spark, folder):
    names = roles.employees(spark, folder).select("last_name", "ssn")
    return clean.mark_by_substring(names, "ssn", "-", "format", "hyphenated", "plain")


@query(
    "format_ssn",
    """SELECT c_custkey, substr(d, 1, 3) || '-' || substr(d, 4, 2) || '-' || substr(d, 6, 4) AS ssn
       FROM (SELECT c_custkey, lpad(CAST((c_custkey * 7919 + 1) % 1000000000 AS VARCHAR), 9, '0') AS d FROM customer)""",
)
def format_ssn(spark, folder):
    key = F.col("c_custkey")
    digits = F.lpad(((key * 7919 + 1) % 1000000000).cast("string"), 9, "0")
    return table(spark, folder, "customer").select(key, text.format_ssn(digits).alias("ssn"))


@query(
    "repair_ssn",
    f"WITH {REPAIRED_SQL} SELECT last_name, ssn FROM repaired",
)
def repair_ssn(spark, folder):
    return clean.repair_ssn(roles.employees(spark, folder)).select("last_name", "ssn")


@query(
    "initcap_name",
    f"""WITH {EMPLOYEES_SQL} SELECT upper(substr(first_name, 1, 1)) || lower(substr(first_name, 2)) AS first_name,
        upper(substr(last_name, 1, 1)) || lower(substr(last_name, 2)) AS last_name FROM employees""",
)
def initcap_name(spark, folder):
    names = roles.employees(spark, folder).select("first_name", "last_name")
    return clean.title_case_columns(names, ["first_name", "last_name"])


@query(
    "anonymize",
    f"""WITH {EMPLOYEES_SQL} SELECT last_name, sha256(ssn) AS ssn,
        sha256(CAST(CAST(salary AS DECIMAL(38, 2)) AS VARCHAR)) AS salary FROM employees""",
)
def anonymize(spark, folder):
    rows = roles.employees(spark, folder).select("last_name", "ssn", "salary")
    return clean.anonymize_columns(rows, texts=["ssn"], amounts=["salary"])


@query("dedup_rows", f"WITH {REPAIRED_SQL} SELECT DISTINCT * FROM repaired")
def dedup_rows(spark, folder):
    repaired = clean.title_case_columns(clean.repair_ssn(roles.employees(spark, folder)), ["first_name"])
    return clean.dedup_rows(repaired)


@query(
    "drop_nulls",
    f"""WITH {PRICED_SQL} SELECT {KEYS_SQL}, rooms, rating, price FROM priced
        WHERE rooms IS NOT NULL AND rating_value IS NOT NULL AND price IS NOT NULL AND superhost IS NOT NULL""",
)
def drop_nulls(spark, folder):
    return clean.drop_nulls(priced(spark, folder)).select(*KEYS, "rooms", "rating", "price")


@query(
    "union_all",
    "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem",
)
def union_all(spark, folder):
    """Columns are matched by name, whatever their order."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("o_totalprice"), F.col("l_orderkey").alias("o_orderkey")
    )
    return clean.union_rows(orders, lines)


@query(
    "employee_pipeline",
    f"""WITH {REPAIRED_SQL} SELECT first_name, last_name, sha256(ssn) AS ssn,
        sha256(CAST(CAST(salary AS DECIMAL(38, 2)) AS VARCHAR)) AS salary, department
        FROM (SELECT DISTINCT * FROM repaired)""",
)
def employee_pipeline(spark, folder):
    return clean_employees(roles.employees(spark, folder))


CLEAN_LISTINGS_SQL = f"""{PRICED_SQL}, kept AS (
  SELECT * FROM priced WHERE price > 0 AND price < 50000 AND minimum_nights <= 365),
 medians AS (SELECT quantile_disc(CAST(rooms AS DOUBLE), 0.5) AS m_rooms, quantile_disc(rating_value, 0.5) AS m_rating FROM kept),
 cleaned AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, superhost, room_type,
         coalesce(CAST(rooms AS DOUBLE), m_rooms) AS rooms, coalesce(rating_value, m_rating) AS rating, tax,
         CAST(minimum_nights AS DOUBLE) AS minimum_nights, price,
         CAST(CASE WHEN rooms IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS rooms_na,
         CAST(CASE WHEN rating_value IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS rating_na
  FROM kept, medians)"""


def cleaned_listings(spark, folder):
    return clean_listings(
        roles.listings(spark, folder), roles.LISTING_NAMES, ["rooms", "rating"], price_range=PRICE_RANGE, keys=roles.SPLIT_KEYS
    )


@query("listing_pipeline", f"WITH {CLEAN_LISTINGS_SQL} SELECT * FROM cleaned")
def listing_pipeline(spark, folder):
    """From currency text to a stored, imputed table."""
    path = overwrite_table(cleaned_listings(spark, folder), shared_path(spark, "listings"))
    return read_table(spark, path)
