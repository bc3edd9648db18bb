"""Scans, sinks and schema listing."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from math import isqrt

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without ``schema`` Spark infers types in one more pass over the files."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_multiline_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV whose quoted fields hold line breaks and doubled quotes.

    Such a file cannot be split, so each file is one task: keep files small
    (``write_csv(rows_per_file=...)``) or land the data in Parquet once.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> str:
    """CSV that ``read_multiline_csv`` reads back unchanged, blanks and quotes included."""
    (
        df.write.mode("overwrite")
        .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the Parquet table at ``path``. The source must not read from the same path."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def rows_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Inline rows as a local relation: no Python worker is started to read them."""
    arrays = {f.name: [row[i] for row in rows] for i, f in enumerate(schema)}
    types = {f.name: _arrow_type(f.dataType) for f in schema}
    table = pa.table({name: pa.array(values, types[name]) for name, values in arrays.items()})
    return spark.createDataFrame(table, schema=schema)


def _arrow_type(data_type: T.DataType) -> pa.DataType:
    simple = {
        T.StringType: pa.string(),
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.BooleanType: pa.bool_(),
    }
    return simple[type(data_type)]


#: A kept frame of n units gets the root of n partitions, but none larger than the most.
KEPT_UNIT, KEPT_MOST_BYTES = 256 << 10, 128 << 20
#: The session setting that names a number of partitions for all kept frames.
KEPT_KEY = "spark.tabprep.keptPartitions"
#: A partition with this many times the mean number of rows holds copies of some row.
CROWDED = 4
#: Rows are first counted by so many parts of their hash; a part with one in so many rows of a partition is looked into.
_HASH_PARTS, _NEAR = 4096, 8
#: Copies of one row that are dealt out by one task.
_COPIES = 1 << 16


def _row_bytes(field: T.StructField):
    """Bytes of a column's value, or the expression that measures them."""
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(F.col(f"`{field.name}`")), F.lit(0)) * 8 + 8
    slots = field.metadata.get("ml_attr", {}).get("num_attrs", 1)
    return F.lit(8 * slots)


def kept_partitions(df: DataFrame) -> int:
    """How many partitions a kept frame gets: from its row count and the width of its rows alone,
    unless the session names a number.

    Number and size of partitions grow alike, so that a fit over few rows is not all task
    overhead (3 MB: 3 partitions, 1 GB: 64), until partitions have ``KEPT_MOST_BYTES``; then the number does.
    """
    named = int(df.sparkSession.conf.get(KEPT_KEY, "0"))
    return named or _partitions_of(df.agg(F.sum(_width(df))).first()[0] or 0)


def _width(df: DataFrame):
    return sum((_row_bytes(f) for f in df.schema), F.lit(0)).cast("long")


def _partitions_of(size: int) -> int:
    return max(1, isqrt(size // KEPT_UNIT), -(-size // KEPT_MOST_BYTES))


def _dealing(df: DataFrame, partitions: int | None) -> tuple[int, bool]:
    """How many partitions, and if copies of some row would crowd one of them: told by counts, before any row moves.

    The pass that measures the frame counts rows by a part of their hash. Where no such count is near the rows
    of a partition nothing can be crowded; else the rows of every partition are counted.
    """
    row = F.xxhash64(*df.columns)
    n = partitions or int(df.sparkSession.conf.get(KEPT_KEY, "0"))
    if not n:
        parts = df.groupBy(F.pmod(row, F.lit(_HASH_PARTS))).agg(F.sum(_width(df)).alias("size"), F.count(F.lit(1)).alias("rows"))
        size, total, largest = parts.agg(F.sum("size"), F.sum("rows"), F.max("rows")).first()
        n = _partitions_of(size or 0)
        if (largest or 0) * n * _NEAR <= (total or 0):
            return n, False
    if n == 1:
        return n, False
    # The partition of a row, as the shuffle of ``spread`` picks it.
    sizes = df.groupBy(F.pmod(F.hash(row), F.lit(n))).count()
    largest, total = sizes.agg(F.max("count"), F.sum("count")).first()
    return n, (largest or 0) * n > CROWDED * (total or 0) and largest > CROWDED * n


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out by their hash and put each partition in a fixed order.

    Seeded sampling in a fit follows the layout, so the layout depends on the rows and on
    ``partitions`` alone, never on cores, files or the order in which rows arrive. The number
    comes from the data (``kept_partitions``) unless given.
    """
    row = F.xxhash64(*df.columns)
    return df.repartition(partitions or kept_partitions(df), row).sortWithinPartitions(row)


def spread_copies(df: DataFrame, partitions: int) -> DataFrame:
    """Like ``spread``, with the copies of a row dealt over all partitions in turn.

    Equal rows are counted with map-side combine; their copies, numbered from the row's hash
    on, go round the partitions. So the layout still depends on the rows alone, and no task
    holds all copies of a row.
    """
    place, copies, part = "_place", "_copies", "_part"
    row = F.xxhash64(*df.columns)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies)).withColumn(place, row)
    blocks = F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(_COPIES).cast("long"))
    chunks = counted.withColumn(part, F.explode(blocks)).repartition(partitions, place, part)
    last = F.least(F.col(copies), F.col(part) + _COPIES) - 1
    each = chunks.withColumn("_copy", F.explode(F.sequence(F.col(part), last)))
    target = F.pmod(F.pmod(F.col(place), F.lit(partitions)) + F.col("_copy"), F.lit(partitions))
    dealt = each.withColumn(part, target.cast("int")).repartitionById(partitions, F.col(part))
    return dealt.sortWithinPartitions(place).select(*df.columns)


@contextmanager
def kept(df: DataFrame, partitions: int | None = None):
    """Keep a frame in memory and on disk while an iterative fit reads it several times.

    If a partition would hold ``CROWDED`` times the mean, as it does where a row has very many
    copies, those are dealt over all partitions (``_dealing``), so no task ever holds them.
    """
    n, crowded = _dealing(df, partitions)
    held = (spread_copies if crowded else spread)(df, n).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if n > 1:
            held.count()  # filled once, before concurrent fits read it
        yield held
    finally:
        held.unpersist()


@contextmanager
def stored(df: DataFrame, source: DataFrame | None = None):
    """Keep a frame where it is read, for uses whose result does not follow the layout: least squares, measures, scores.

    No row is moved or sorted, as ``kept`` does for seeded fits. Only a frame that lies in fewer partitions
    than its bytes (``kept_partitions``) and the cores of the session ask for is dealt out in turn. That is told
    from ``source``, if given: the frame that ``df`` is a projection of, and cheaper to scan.
    """
    level, first = StorageLevel.MEMORY_AND_DISK, None
    if source is None:
        source = first = df.persist(level)  # measured as it is filled, not in a pass of its own
    size, last = source.select(_width(source).alias("size"), F.spark_partition_id().alias("part")).agg(F.sum("size"), F.max("part")).first()
    wanted = min(_partitions_of(size or 0), df.sparkSession.sparkContext.defaultParallelism)
    held = df.repartition(wanted).persist(level) if (last or 0) + 1 < wanted else first or df.persist(level)
    try:
        yield held
    finally:
        for frame in {id(f): f for f in (first, held) if f is not None}.values():
            frame.unpersist()


def materialize(df: DataFrame) -> int:
    """Persist the frame, fill the cache and return the row count."""
    return df.persist(StorageLevel.MEMORY_AND_DISK).count()


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and count of non-null values."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("n_values"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
