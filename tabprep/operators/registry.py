"""A model registry as an append-only event table; the state is a query over it.

Events carry ``seq`` (rising and unique), ``name``, ``version`` (null for events about the
whole model), ``kind`` and ``value``. The last events are told by combined ``max`` aggregates
over ``seq`` alone, never by a window over one model's events; their values are joined by ``seq``.
A snapshot holds the events that still matter, so the state is a snapshot and the events after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.session import reliable_checkpoint
from tabprep.sources.tables import rows_frame

# The stages a model version can be in.
STAGES = ("None", "Staging", "Production", "Archived")

EVENTS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
SNAPSHOTS = T.StructType([T.StructField("upto", T.LongType()), T.StructField("path", T.StringType())])
REGISTER, STAGE, DESCRIBE, DELETE = "register", "stage", "describe", "delete"


def _marks(events: DataFrame) -> DataFrame:
    """(name, version, registered, staged, described, deleted): the ``seq`` of the last event of each kind.

    A null value never overrides an earlier stage or description. One row per version, and one
    with a null version per model; numbers alone are kept, so Spark hashes them.
    """

    def last(kind: str, valued: bool = False) -> Column:
        wanted = F.col("kind") == kind
        return F.max(F.when(wanted & F.col("value").isNotNull() if valued else wanted, F.col("seq")))

    return events.groupBy("name", "version").agg(
        last(REGISTER).alias("registered"),
        last(STAGE, True).alias("staged"),
        last(DESCRIBE, True).alias("described"),
        last(DELETE).alias("deleted"),
    )


def _living(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Live versions and live model descriptions, all as numbers of events.

    A version lives if it was registered after the last deletion of its model; stages and
    descriptions count from then on. Both sides of the join come from a checkpoint, so
    adaptive execution can split the rows of a model with very many versions.
    """
    marks = reliable_checkpoint(_marks(events))
    since = lambda c, start: F.when(F.col(c) > F.coalesce(F.col(start), F.lit(-1)), F.col(c))
    models = marks.where(F.col("version").isNull()).select("name", "deleted", since("described", "deleted").alias("noted"))
    versions_ = marks.where(F.col("version").isNotNull() & F.col("registered").isNotNull()).drop("deleted")
    alive = versions_.join(models, "name", "left").where(F.col("registered") > F.coalesce("deleted", F.lit(-1)))
    living = alive.select("name", "version", "registered", since("staged", "registered").alias("staged"), since("described", "registered").alias("described"), "noted")
    return living, models.where(F.col("noted").isNotNull()).select("name", F.col("noted").alias("seq"))


def versions(events: DataFrame) -> DataFrame:
    """Live versions: (name, version, source, stage, description, model_description).

    The log is read twice: names and kinds to find the events that count, then the values of those.
    """
    living, _ = _living(events)
    numbered = ("registered", "staged", "described", "noted")
    wanted = living.select(
        "name", "version", F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("seq")) for c in numbered]))
    ).where(F.col("seq").isNotNull())
    values = wanted.join(events.select("seq", "value"), "seq").groupBy("name", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("what", "value"))).alias("known")
    )
    value = lambda what: F.try_element_at("known", F.lit(what))
    return values.select(
        "name",
        "version",
        value("registered").alias("source"),
        F.coalesce(value("staged"), F.lit(STAGES[0])).alias("stage"),
        value("described").alias("description"),
        value("noted").alias("model_description"),
    )


def compacted(events: DataFrame) -> DataFrame:
    """The events that still matter: with any later events they give the same versions as all of them."""
    living, notes = _living(events)
    seqs = living.select(F.explode(F.array("registered", "staged", "described")).alias("seq")).unionByName(notes.select("seq"))
    return events.join(seqs.where(F.col("seq").isNotNull()), "seq", "left_semi").select(*EVENTS.names)


def latest_versions(events: DataFrame) -> DataFrame:
    """(name, n_versions, latest_version) of live models; versions compare as numbers."""
    return (
        versions(events)
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n_versions"), F.max("version").alias("latest_version"))
    )


def in_stage(events: DataFrame, stage: str) -> DataFrame:
    return versions(events).filter(F.col("stage") == stage)


def _known_stage(stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; one of {STAGES}")
    return stage


class ModelRegistry:
    """Appends events below ``root``. One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.path = f"{root}/model_events"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return rows_frame(self.spark, [], schema)

    def _snapshot(self):
        """The last finished snapshot, or None."""
        return self._read(f"{self.root}/model_snapshots", SNAPSHOTS).orderBy(F.desc("upto"), "path").first()

    def events(self) -> DataFrame:
        """The last snapshot's events and those after it; files of older events are skipped by their ``seq``."""
        taken, log = self._snapshot(), self._read(self.path, EVENTS)
        if taken is None:
            return log
        return self._read(taken["path"], EVENTS).unionByName(log.where(F.col("seq") > taken["upto"]))

    def compact(self) -> int:
        """Take a snapshot of the events that still matter; returns the number of the last one it stands for.

        The snapshot counts once its row in the table of snapshots is written, so a lost driver
        leaves the one before. The log itself stays whole.
        """
        upto = self._last_seq()
        path = f"{self.root}/model_states/{uuid.uuid4().hex}"
        compacted(self.events()).write.parquet(path)
        rows_frame(self.spark, [(upto, path)], SNAPSHOTS).coalesce(1).write.mode("append").parquet(f"{self.root}/model_snapshots")
        return upto

    def _last_seq(self) -> int:
        taken = self._snapshot()
        upto = taken["upto"] if taken else 0
        later = self._read(self.path, EVENTS).where(F.col("seq") > upto)
        return later.agg(F.max("seq")).first()[0] or upto

    def _append(self, name: str, changes: Sequence[tuple[int | None, str, str | None]]) -> None:
        """Add (version, kind, value) events in order, in one write."""
        last = self._last_seq()
        rows = [(last + i, name, *change) for i, change in enumerate(changes, start=1)]
        rows_frame(self.spark, rows, EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def _require(self, name: str, wanted: Iterable[int]) -> None:
        # Only the asked versions come back.
        known = {r["version"] for r in self.search(name).filter(F.col("version").isin(*wanted)).collect()}
        if missing := set(wanted) - known:
            raise LookupError(f"no version {sorted(missing)} of {name}")

    def register(self, name: str, source: str, stage: str | None = None, description: str | None = None) -> int:
        """Add the next version of a model, in a stage and with a description if given; return its number."""
        row = latest_versions(self.events().filter(F.col("name") == name)).select("latest_version").first()
        version = 1 if row is None else row[0] + 1
        changes = [(version, REGISTER, source)]
        if stage is not None:
            changes.append((version, STAGE, _known_stage(stage)))
        if description is not None:
            changes.append((version, DESCRIBE, description))
        self._append(name, changes)
        return version

    def transition(self, name: str, stages: Mapping[int, str]) -> None:
        """Move versions to stages, given as {version: stage}."""
        changes = [(version, STAGE, _known_stage(stage)) for version, stage in stages.items()]
        self._require(name, list(stages))
        self._append(name, changes)

    def describe(self, name: str, description: str, version: int | None = None) -> None:
        """Describe a model, or one version of it."""
        if version is not None:
            self._require(name, [version])
        self._append(name, [(version, DESCRIBE, description)])

    def delete(self, name: str) -> None:
        """Remove a model with all its versions; a later registration starts at 1 again."""
        self._append(name, [(None, DELETE, None)])

    def search(self, name: str) -> DataFrame:
        return versions(self.events().filter(F.col("name") == name))

    def get(self, name: str, version: int):
        """The state of one version as a row."""
        row = self.search(name).filter(F.col("version") == version).first()
        if row is None:
            raise LookupError(f"no version {version} of {name}")
        return row
