"""Queries over sources, sinks and versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators.features import add_log
from tabprep.plans.catalog import query, table
from tabprep.session import shared_path
from tabprep.sources import quoted_csv, tables, versions

ROWS_PER_CSV_FILE = 50_000


@query(
    "csv_scan_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_scan_roundtrip(spark, folder):
    """A folder of CSV files, types inferred."""
    source = table(spark, folder, "customer")
    path = tables.write_csv(source, shared_path(spark, "csv"))
    found = tables.read_csv(spark, path)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("long")).select(source.columns)


@query("csv_multiline_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_multiline_scan(spark, folder):
    """Whole texts with line breaks and quotes through CSV and back."""
    source = table(spark, folder, "documents")
    path = tables.write_csv(source, shared_path(spark, "csv-multiline"), ROWS_PER_CSV_FILE)
    return tables.read_multiline_csv(spark, path, source.schema)


@query("csv_quoted_splits", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_quoted_splits(spark, folder):
    """The same texts from CSV files, one per task that read the table; each file is read in splits."""
    source = table(spark, folder, "documents")
    path = tables.write_csv(source, shared_path(spark, "csv-quoted"))
    return quoted_csv.read_quoted_csv(spark, path, source.schema)


@query("write_overwrite_roundtrip", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def write_overwrite_roundtrip(spark, folder):
    """The second write replaces the first one wholly."""
    part = table(spark, folder, "part")
    path = shared_path(spark, "overwrite")
    tables.overwrite_table(part.select("p_partkey", "p_name"), path)
    tables.overwrite_table(part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), path)
    return tables.read_table(spark, path)


def _two_versions(spark, folder) -> str:
    root = shared_path(spark, "versions")
    first = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    versions.overwrite_version(first, root)
    second = add_log(versions.read_version(spark, root, 0), "o_totalprice", "log_price")
    versions.overwrite_version(second, root, merge_schema=True)
    return root


@query("snapshot_as_of", "SELECT o_orderkey, o_totalprice FROM orders")
def snapshot_as_of(spark, folder):
    """Version 0 as it was, after version 1 added a column."""
    return versions.read_version(spark, _two_versions(spark, folder), 0)


@query(
    "table_history",
    """SELECT CAST(v AS BIGINT) AS version, CASE WHEN v = 0 THEN 'CREATE' ELSE 'OVERWRITE' END AS operation,
              count(*) AS n_rows, CAST(2 + v AS BIGINT) AS n_columns
       FROM orders, (VALUES (0), (1)) AS t(v) GROUP BY v""",
)
def table_history(spark, folder):
    return versions.history(spark, _two_versions(spark, folder)).drop("committed_at")


@query(
    "schema_evolution",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS log_price, CAST(0 AS BIGINT) AS version FROM orders
       UNION ALL SELECT o_orderkey, o_totalprice, round(ln(o_totalprice), 6), 1 FROM orders""",
)
def schema_evolution(spark, folder):
    """All versions at once: the old one has null where the new column is."""
    rows = versions.read_all_versions(spark, _two_versions(spark, folder))
    return rows.withColumn("log_price", F.round("log_price", 6)).withColumnRenamed("_version", "version")


@query(
    "schema_listing",
    """SELECT 0 AS position, 'c_custkey' AS column_name, 'bigint' AS data_type, count(c_custkey) AS n_values FROM customer
       UNION ALL SELECT 1, 'c_name', 'string', count(c_name) FROM customer
       UNION ALL SELECT 2, 'c_nationkey', 'int', count(c_nationkey) FROM customer
       UNION ALL SELECT 3, 'c_acctbal', 'double', count(c_acctbal) FROM customer
       UNION ALL SELECT 4, 'c_mktsegment', 'string', count(c_mktsegment) FROM customer""",
)
def schema_listing(spark, folder):
    return tables.describe_schema(table(spark, folder, "customer"))
