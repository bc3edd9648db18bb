"""Whole-table versions kept as ordinary Parquet folders.

Layout below one root: ``data/_version=N`` holds the rows of version N and
``commits`` holds one row per finished version with its schema. A version is
visible only once its commit row exists, so a write that dies half-way leaves
nothing to clean up: the next write of the same number replaces its folder.
One writer at a time is assumed; there is no transaction log.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.sources.tables import rows_frame

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("schema_json", T.StringType()),
    ]
)


class VersionNotFound(LookupError):
    """No commit exists for the asked version."""


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The commit rows; an empty frame before the first write."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows_frame(spark, [], COMMIT_SCHEMA)


def latest_version(spark: SparkSession, root: str) -> int | None:
    return commits(spark, root).agg(F.max("version")).first()[0]


def _schema_of(spark: SparkSession, root: str, version: int) -> T.StructType:
    row = commits(spark, root).filter(F.col("version") == version).select("schema_json").first()
    if row is None:
        raise VersionNotFound(f"version {version} of {root}")
    return T.StructType.fromJson(json.loads(row[0]))


def overwrite_version(df: DataFrame, root: str, merge_schema: bool = False) -> int:
    """Write ``df`` as the next version and return its number.

    As with a table format, columns may only change when ``merge_schema`` is set.
    """
    spark = df.sparkSession
    previous = latest_version(spark, root)
    version = 0 if previous is None else previous + 1
    if previous is not None and not merge_schema:
        known = {f.name: f.dataType for f in _schema_of(spark, root, previous)}
        if known != {f.name: f.dataType for f in df.schema}:
            raise ValueError("schema differs from the last version; pass merge_schema=True")
    folder = f"{root}/data/_version={version}"
    df.write.mode("overwrite").parquet(folder)
    # Counted from the written files: a retried task cannot be counted twice.
    n_rows = spark.read.schema(df.schema).parquet(folder).count()
    commit = (
        version,
        datetime.now(timezone.utc).isoformat(),
        "CREATE" if version == 0 else "OVERWRITE",
        n_rows,
        df.schema.json(),
    )
    rows_frame(spark, [commit], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (default: the latest), with the columns it had then.

    Only the folder of that version is listed and the recorded schema is used, so
    no other version's files or footers are touched.
    """
    if version is None:
        version = latest_version(spark, root)
        if version is None:
            raise VersionNotFound(f"no version of {root}")
    return spark.read.schema(_schema_of(spark, root, version)).parquet(f"{root}/data/_version={version}")


def read_all_versions(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every version plus ``_version``; columns a version lacks read as null.

    The merged schema comes from the commit rows, not from reading every file
    footer. A filter on ``_version`` prunes to the matching folders.
    """
    merged: dict[str, T.StructField] = {}
    # One short row per version: metadata, not data.
    history_rows = commits(spark, root).orderBy("version").select("version", "schema_json").collect()
    if not history_rows:
        raise VersionNotFound(f"no version of {root}")
    for row in history_rows:
        for field in T.StructType.fromJson(json.loads(row["schema_json"])):
            known = merged.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise ValueError(f"column {field.name} changes type across versions")
    schema = T.StructType([*merged.values(), T.StructField("_version", T.LongType())])
    folders = [f"{root}/data/_version={row['version']}" for row in history_rows]
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per version: time, operation, rows and columns."""
    columns = F.json_array_length(F.get_json_object("schema_json", "$.fields"))
    return commits(spark, root).select(
        "version", "committed_at", "operation", "n_rows", columns.cast("long").alias("n_columns")
    )
