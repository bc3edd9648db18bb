"""CSV whose quoted fields hold line breaks, read by as many tasks as its files have splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.session import reliable_checkpoint

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, odd): the lines of each file split in order, and if their quotes are uneven in number.

    A line belongs to the split it begins in. Only ``\\n`` ends a line, so a carriage return before it stays.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_line"),
        (quotes % 2 == 1).alias("_odd"),
    )


def _by_split(df: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows with those of their split, in as many tasks as there are splits, so that a task gets some splits at most."""
    return df.repartition(max(1, lines.rdd.getNumPartitions()), *_SPLIT)


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside, open_block, open_record) per split: whether it begins inside quotes, and in which record.

    A quoted field is open where the number of quotes so far is odd; doubled quotes inside it do not
    change that. So one number per split and its prefix sum tell the state at every split. Of the
    lines of a split, those that begin outside quotes begin a record; their number is known for both
    states, so the state picks it. ``open_block`` is the last split before that begins a record.
    """
    order = Window.partitionBy(*_SPLIT).orderBy("_at")
    # What a split looks like if it begins outside quotes; inside, the other lines begin records.
    parity = F.sum(F.col("_odd").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    dealt = _by_split(lines.select(*_SPLIT, "_at", "_odd"), lines)
    marked = dealt.select(*_SPLIT, "_odd", (F.coalesce(parity, F.lit(0)) % 2 == 0).alias("_even"))
    sums = marked.groupBy(*_SPLIT).agg(
        F.sum(F.col("_odd").cast("long")).alias("_odds"), F.count_if("_even").alias("_if_out"), F.count_if(~F.col("_even")).alias("_if_in")
    )
    # One row per split of a file, some per gigabyte.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("_odds").over(before), F.lit(0)) % 2 == 1).alias("_inside")
    states = sums.select(*_SPLIT, inside, "_if_out", "_if_in")
    begun = F.when(F.col("_inside"), F.col("_if_in")).otherwise(F.col("_if_out"))
    states = states.select(*_SPLIT, "_inside", begun.alias("_begun"))
    last = F.last(F.when(F.col("_begun") > 0, F.struct(F.col("_block").alias("b"), F.col("_begun").alias("n"))), ignorenulls=True)
    open_ = last.over(before)
    return states.select(*_SPLIT, "_inside", open_["b"].alias("_open_block"), open_["n"].alias("_open_record"))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, record, text): every record of the files below ``path`` with its line breaks.

    ``block`` and ``record`` count from the split where the record begins; numbers start at 1.
    """
    lines = _lines(spark, path)
    # One row per split: known before the lines are read again to be cut.
    states = reliable_checkpoint(split_states(lines))
    order = Window.partitionBy(*_SPLIT).orderBy("_at")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    known = _by_split(lines, lines).join(F.broadcast(states), _SPLIT)
    odd_before = F.coalesce(F.sum(F.col("_odd").cast("long")).over(earlier), F.lit(0)) + F.col("_inside").cast("long")
    begins = known.withColumn("_begins", odd_before % 2 == 0)
    own = F.sum(F.col("_begins").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = begins.withColumn("_own", own)
    carried = F.col("_own") == 0  # lines before the first begin go on with the record that is open
    placed = placed.select(
        "_file",
        F.when(carried, F.col("_open_block")).otherwise(F.col("_block")).alias("block"),
        F.when(carried, F.col("_open_record")).otherwise(F.col("_own")).alias("record"),
        F.struct(F.col("_block").alias("b"), F.col("_at").alias("a"), F.col("_line").alias("t")).alias("piece"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["t"]), "\n")
    return placed.groupBy(F.col("_file").alias("file"), "block", "record").agg(joined.alias("text"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """CSV files with a header whose quoted fields hold line breaks and doubled quotes, read in splits.

    Gives the rows of ``read_multiline_csv``, which needs a task per file. Files are cut into splits
    as any text is; a first pass counts the quotes of each split, their prefix sum over the
    splits of a file tells which lines begin a record, and records are then put together inside
    the splits (``split_states``, ``quoted_records``). Only a record that goes on over the end of its split
    meets lines of another one. A split has some tens of megabytes, so no task holds more than
    that and one record, however large the files.

    A quote that is neither doubled nor around a field (``5" pipe``) is not allowed for. Empty
    lines are no records, the first record of every file is its header. The types must be given.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = quoted_records(spark, path).where(~((F.col("block") == 0) & (F.col("record") == 1)))
    text = F.regexp_replace("text", "\r$", "")
    blank: Column = F.trim(text) == ""
    row = F.from_csv(text, _ddl(kind), {"quote": '"', "escape": '"', **options})
    return records.where(~blank).select(row.alias("row")).select("row.*")


def _ddl(kind: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
