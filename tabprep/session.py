"""Session defaults and the shared folder for side tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# One fallback folder per local application; never used on a cluster.
_local_folders: dict[str, str] = {}


def build_session(
    app_name: str = "tabprep",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on.

    ``shuffle_partitions`` is the number AQE starts from before it merges small
    partitions. Leave it unset on a cluster to keep the cluster's own value.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets one temporary
    folder per application. On a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tabprep-")
    return _local_folders[app]


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder, one per call."""
    return f"{shared_root(spark)}/tabprep/{tag}-{uuid.uuid4().hex}"


def set_checkpoints(spark: SparkSession) -> None:
    """Name the shared folder for checkpoints, unless the session has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def reliable_checkpoint(df):
    """Cut lineage with a checkpoint in the shared folder; survives executor loss."""
    set_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)
