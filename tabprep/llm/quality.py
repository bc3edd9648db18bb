"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import WORD, free_names, lower_ascii

WINDOW = 5

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it for on with as at by this that are was be have "
    "der die das und ist ein eine nicht mit sich den von zu im "
    "le la les de et des un une du que qui est pour dans "
    "el los las y en por con una para se no es"
).split()


class Threshold(NamedTuple):
    """A document fails if ``measure``, where it is known, lies outside [low, high].

    The rule is asked only of documents with at least ``from_words`` words.
    """

    name: str
    measure: str
    low: float | None
    high: float | None
    from_words: int = 0


#: SQL expressions over the columns made by ``measured``. The first two are the base.
THRESHOLDS = (
    Threshold("words", "n_words", 10, None),
    Threshold("repeated windows", "100 * n_repeat_words - 20 * n_words", None, 0),
    Threshold("word length", "try_divide(word_chars, n_words)", 1.5, 20),
    Threshold("symbols", "try_divide(n_symbols, n_words)", None, 0.25),
    Threshold("stop words", "try_divide(n_stop_words, n_words)", 0.02, None, 50),
    Threshold("repeated lines", "try_divide(n_dup_lines, n_lines)", None, 0.5),
)
BASE = ("words", "repeated windows")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")


def _repeat_words(words: Column, hashes: Column, ordered: Column) -> Column:
    """Words inside windows that occur twice or more.

    ``ordered`` are the sorted window hashes. Only texts with two equal neighbours there pay
    for sorting hashes with their places; the covered length then comes from the gaps between
    the sorted places. All steps are n log n, so a very long text stays cheap.
    """
    some = F.exists(
        F.sequence(F.lit(1), F.size(ordered) - 1), lambda k: F.get(ordered, k) == F.get(ordered, k - 1)
    )
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts_of(pairs: Column) -> Column:
        def shared(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(pairs, k + 1)["h"] == x["h"], F.lit(False)
            )

        return F.array_sort(F.transform(F.filter(pairs, shared), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        def step(state: Column, p: Column) -> Column:
            return F.struct(
                (state["n"] + F.least(F.lit(WINDOW), p + WINDOW - state["end"])).cast("long").alias("n"),
                (p + WINDOW).alias("end"),
            )

        return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), step)["n"]

    # A one-element transform binds an intermediate result to a name inside one expression.
    starts = F.transform(F.array(placed), starts_of)[0]
    return F.when((F.size(ordered) > 1) & some, F.transform(F.array(starts), covered)[0]).otherwise(
        F.lit(0).cast("long")
    )


def measured(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with the columns of ``MEASURES``, counted over whole texts (null counts as empty)."""
    body, words, hashes, ordered = free_names(docs, ["body", "words", "hashes", "ordered"])
    lines = free_names(docs, ["lines"])[0]
    n = F.size(words)
    w = F.col(words)
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)])
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    kept = list(docs.columns)
    return (
        docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
        .withColumn(words, F.regexp_extract_all(F.col(body), F.lit(WORD), F.lit(0)))
        .withColumn(lines, F.filter(F.split(F.col(body), "\n"), lambda s: s.rlike(WORD)))
        .withColumn(hashes, windows)
        .withColumn(ordered, F.sort_array(hashes))
        .select(
            *kept,
            # A generator, so that a later filter on a measure is not rewritten into one that makes them again.
            F.inline(
                F.array(
                    F.struct(
                        n.cast("long").alias("n_words"),
                        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                        _repeat_words(w, F.col(hashes), F.col(ordered)).alias("n_repeat_words"),
                        F.size(F.filter(w, lambda x: lower_ascii(x).isin(*stop_words))).cast("long").alias("n_stop_words"),
                        F.size(lines).cast("long").alias("n_lines"),
                    )
                )
            ),
        )
    )


def fails(rule: Threshold) -> Column:
    value = F.expr(rule.measure)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (value < rule.low)
    if rule.high is not None:
        bad = bad | (value > rule.high)
    return (F.col("n_words") >= rule.from_words) & F.coalesce(bad, F.lit(False))


def judge_quality(
    docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS, base: Sequence[str] = BASE, text: str = "text"
) -> DataFrame:
    """``docs`` with its measures, ``base_failed``, ``failed`` (names of failed rules) and ``kept``.

    Null texts count as empty and have no words. A ratio without denominator fails no rule.
    Rows are judged one by one: repeated rows all stay, an empty frame stays empty. Columns
    of ``docs`` that bear a name of the result are renamed with closing underscores first.
    """
    for name in (*MEASURES, "base_failed", "failed", "kept"):
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    text = text if text in docs.columns else free_names(docs, [text])[0]
    frame = measured(docs, text)
    names = F.filter(
        F.array(*[F.when(fails(t), F.lit(t.name)) for t in thresholds]), lambda x: x.isNotNull()
    )
    frame = frame.withColumn("failed", names)
    return frame.withColumn("base_failed", F.arrays_overlap("failed", F.array(*map(F.lit, base)))).withColumn(
        "kept", F.size("failed") == 0
    )
