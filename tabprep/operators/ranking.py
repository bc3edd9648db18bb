"""Row numbers over a whole frame without pulling it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import reliable_checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low bits


def global_row_number(df: DataFrame, order: Sequence[Column], column: str = "row_number") -> DataFrame:
    """Number all rows from 0 in the given order.

    A window without partitions would sort everything in one task. Here Spark
    sorts by range partitions; every row knows its place within its partition,
    and only the partition sizes (one number per partition) are accumulated.
    The sorted frame is checkpointed, so both uses see the same partitions.
    """
    placed = reliable_checkpoint(
        df.orderBy(*order).select("*", F.monotonically_increasing_id().alias("_id"))
    ).withColumn("_partition", F.shiftright("_id", _ROW_BITS))
    sizes = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per partition of the sort, so this side is always small.
    starts = sizes.select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.col("_id") - F.shiftleft(F.col("_partition"), _ROW_BITS)
    return (
        placed.join(F.broadcast(starts), "_partition")
        .withColumn(column, F.col("_start") + within)
        .drop("_id", "_partition", "_start")
    )
