"""Periodic runs of ``documents``, a tenth of which are first made periodic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import table
from tabprep.llm.runs import find_runs

_SPACE = "\x09\x0a\x0b\x0c\x0d\x20"


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The words of ``text``; for a tenth of the ids the words from some place on repeat their first ones."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.split(F.btrim(text, F.lit(_SPACE)), r"[\x20\x09-\x0D]+")
    n = F.size(words)
    a = F.pmod(g, n.cast("long")).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    unit = F.slice(words, a + 1, p)
    turns = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, turns)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    chosen = (F.pmod(h, F.lit(10)) == 0) & (F.btrim(text, F.lit(_SPACE)) != "")
    return F.when(chosen, repeated).otherwise(text)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(docs)

    def better(best: Column, r: Column) -> Column:
        """The run with the greater length by period; of equal ones the first in order of start and period."""
        gain = best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
        return F.when(gain, r).otherwise(best)

    kind = found.schema["runs"].dataType.elementType
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_runs": op13_runs}
ORACLES: dict[str, str] = {}
