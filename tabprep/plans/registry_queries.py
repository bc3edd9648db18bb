"""Queries over model registry events; every order is one event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators import registry
from tabprep.plans.catalog import query, table


def model_events(spark, folder) -> DataFrame:
    """Customers own models; the last digits of an order decide what happened to which version."""
    key = F.col("o_orderkey")
    digit = key % 10
    kind = (
        F.when(key % 50 == 49, registry.DELETE)
        .when(digit < 4, registry.REGISTER)
        .when(digit < 8, registry.STAGE)
        .otherwise(registry.DESCRIBE)
    )
    stage = (
        F.when(F.col("o_orderstatus") == "F", "Staging").when(F.col("o_orderstatus") == "O", "Production").otherwise("Archived")
    )
    about_model = (key % 50 == 49) | (digit == 9)
    return table(spark, folder, "orders").select(
        key.alias("seq"),
        F.concat(F.lit("model-"), F.col("o_custkey").cast("string")).alias("name"),
        F.when(~about_model, F.floor(key / 10) % 3 + 1).cast("long").alias("version"),
        kind.alias("kind"),
        F.when(kind == registry.REGISTER, F.concat(F.lit("run-"), key.cast("string")))
        .when(kind == registry.STAGE, stage)
        .when(kind == registry.DESCRIBE, F.concat(F.lit("note "), F.col("o_orderpriority")))
        .alias("value"),
    )


EVENTS_SQL = """events_of AS (
  SELECT o_orderkey AS seq, 'model-' || CAST(o_custkey AS VARCHAR) AS name,
         CASE WHEN NOT (o_orderkey % 50 = 49 OR o_orderkey % 10 = 9) THEN o_orderkey // 10 % 3 + 1 END AS version,
         CASE WHEN o_orderkey % 50 = 49 THEN 'delete' WHEN o_orderkey % 10 < 4 THEN 'register'
              WHEN o_orderkey % 10 < 8 THEN 'stage' ELSE 'describe' END AS kind,
         CASE WHEN o_orderkey % 50 = 49 THEN NULL WHEN o_orderkey % 10 < 4 THEN 'run-' || CAST(o_orderkey AS VARCHAR)
              WHEN o_orderkey % 10 < 8 THEN CASE o_orderstatus WHEN 'F' THEN 'Staging' WHEN 'O' THEN 'Production' ELSE 'Archived' END
              ELSE 'note ' || o_orderpriority END AS value
  FROM orders),
 alive AS (
  SELECT e.* FROM events_of e
  WHERE seq > coalesce((SELECT max(d.seq) FROM events_of d WHERE d.name = e.name AND d.kind = 'delete'), -1)),
 registered AS (
  SELECT name, version, seq AS born, value AS source FROM alive WHERE kind = 'register'
  QUALIFY row_number() OVER (PARTITION BY name, version ORDER BY seq DESC) = 1),
 last_stage AS (
  SELECT r.name, r.version, a.value AS stage FROM registered r JOIN alive a
    ON a.name = r.name AND a.version = r.version AND a.kind = 'stage' AND a.seq > r.born
  QUALIFY row_number() OVER (PARTITION BY r.name, r.version ORDER BY a.seq DESC) = 1),
 last_note AS (
  SELECT r.name, r.version, a.value AS description FROM registered r JOIN alive a
    ON a.name = r.name AND a.version = r.version AND a.kind = 'describe' AND a.seq > r.born
  QUALIFY row_number() OVER (PARTITION BY r.name, r.version ORDER BY a.seq DESC) = 1),
 model_note AS (
  SELECT name, value AS model_description FROM alive WHERE kind = 'describe' AND version IS NULL
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1),
 live AS (
  SELECT name, version, source, coalesce(stage, 'None') AS stage, description, model_description
  FROM registered LEFT JOIN last_stage USING (name, version) LEFT JOIN last_note USING (name, version)
       LEFT JOIN model_note USING (name))"""


@query("registry_current_stage", f"WITH {EVENTS_SQL} SELECT * FROM live")
def registry_current_stage(spark, folder):
    """Every live version with its stage and descriptions."""
    return registry.versions(model_events(spark, folder))


@query(
    "registry_versions",
    f"WITH {EVENTS_SQL} SELECT name, version, source FROM live",
)
def registry_versions(spark, folder):
    return registry.versions(model_events(spark, folder)).select("name", "version", "source")


@query(
    "registry_latest_version",
    f"WITH {EVENTS_SQL} SELECT name, count(*) AS n_versions, max(version) AS latest_version FROM live GROUP BY name",
)
def registry_latest_version(spark, folder):
    return registry.latest_versions(model_events(spark, folder))


@query(
    "registry_in_production",
    f"WITH {EVENTS_SQL} SELECT name, version, source FROM live WHERE stage = 'Production'",
)
def registry_in_production(spark, folder):
    return registry.in_stage(model_events(spark, folder), "Production").select("name", "version", "source")
