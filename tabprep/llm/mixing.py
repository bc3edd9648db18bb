"""Mixes sources to target weights: budgets flow down a tree, then each leaf takes a token-prefix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabprep.llm.common import WORD, free_names
from tabprep.session import reliable_checkpoint


#: A table with a row per leaf is broadcast up to this many leaves (some megabytes).
BROADCAST_LEAVES = 20_000


class Level(NamedTuple):
    """One level of the tree: its name, the value of a row, and positive whole weights of values."""

    name: str
    value: Column
    weights: Mapping[str, int]
    other: int = 1


def source_domain(source: Column) -> Column:
    """``web`` for sources numbered below 10, ``library`` for all others."""
    number = F.regexp_extract(source, "([0-9]+)$", 1).try_cast("long")
    return F.when(number < 10, F.lit("web")).otherwise(F.lit("library"))


def default_levels() -> list[Level]:
    return [
        Level("domain", source_domain(F.col("source")), {"web": 60, "library": 40}),
        Level("lang", F.col("lang"), {"en": 50, "de": 20, "fr": 20, "es": 10}, 5),
        Level("source", F.col("source"), {}),
    ]


def _weight(level: Level) -> Column:
    if level.other <= 0 or any(w <= 0 for w in level.weights.values()):
        raise ValueError(f"weights of {level.name} must be positive")
    out = F.lit(level.other)
    for name, weight in level.weights.items():
        out = F.when(F.col(level.name) == name, F.lit(weight)).otherwise(out)
    return out.cast("long")


def _water_fill(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Splits ``budget`` of each parent among its children: (weight, capacity) to ``share``.

    Children that cannot use what their weight gives them get their capacity; what they leave
    goes to their siblings by weight. In order of capacity per weight those children come first.
    """
    whole = Window.partitionBy(*parents)
    order = whole.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = nodes.withColumn("full", F.col("capacity") * after <= (F.col("budget") - before) * F.col("weight"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0).cast("long")).otherwise(F.col("weight"))).over(whole)
    part = F.try_divide(left * F.col("weight") - (left * F.col("weight")) % open_weight, open_weight).cast("long")
    return full.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(part)).drop("full")


def leaf_budgets(leaves: DataFrame, levels: Sequence[Level], share: tuple[int, int], epochs: int) -> DataFrame:
    """``leaves(level names, tokens)`` with ``capacity`` and ``budget``.

    The tree has one row per combination of level values, not of documents. A node can use at
    most ``epochs`` times the tokens below it. As a child's shortage is dealt with inside its
    parent's budget, siblings take it up first; a parent is given less only if all below it
    is used up, and then its own siblings take up the rest.
    """
    names = [level.name for level in levels]
    tree = leaves.withColumn("capacity", F.col("tokens") * epochs)
    root = tree.agg(
        F.least(
            F.expr(f"sum(tokens) * {share[0]} div {share[1]}"), F.sum("capacity")
        ).alias("budget")
    )
    budgets, parents = root.withColumn("tree", F.lit(0)), ["tree"]
    tree = tree.withColumn("tree", F.lit(0))
    for level in levels:
        nodes = tree.groupBy(*parents, level.name).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(level)).join(budgets, parents)
        filled = _water_fill(nodes, parents, level.name)
        parents = [*parents, level.name]
        budgets = filled.select(*parents, F.col("share").alias("budget"))
    return tree.join(budgets, parents).select(*names, "tokens", "capacity", "budget")


def _small(plan: DataFrame) -> DataFrame:
    """``plan`` marked for broadcast if it has few rows; else Spark joins it by shuffling."""
    return F.broadcast(plan) if plan.count() <= BROADCAST_LEAVES else plan


def _key(seed: int, epoch: Column, id_text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_text))


def mix_sources(
    docs: DataFrame,
    levels: Sequence[Level] | None = None,
    share: tuple[int, int] = (4, 5),
    epochs: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of ``docs`` chosen for the target mix, with ``epoch``, ``n_tokens`` and the level columns.

    ``share`` of all tokens (words) is the total budget. ``leaf_budgets`` deals it out. A leaf
    repeats its documents while its budget covers whole epochs, then takes the longest prefix
    that fits of one more, in the order of an md5 of seed, epoch and id; rows with equal ids
    are taken or left together. Each level's columns are ``levels[i].name``.

    The prefix ends are found by sums over 65,536 ranges of the order, then inside the one
    range where each leaf's budget ends; equal keys are summed before they move, so a leaf
    with a third of all rows, or one id on many rows, stays spread out. Null texts count as
    empty and have no tokens; null values of a level are a node ``(none)``; null ids order as
    empty text. No rows, or no tokens, give no rows or those without tokens. Columns of
    ``docs`` that bear a name of the result get closing underscores, unless a level is read
    from the column of its own name.
    """
    levels = levels or default_levels()
    names = [level.name for level in levels]
    for name in ("epoch", "n_tokens", *(n for n in names if n not in ("lang", "source"))):
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_names(docs, [name])[0])
    text = text if text in docs.columns else free_names(docs, [text])[0]
    leaf = [f"{n}_node_" for n in names]
    ident = free_names(docs, ["id_text"])[0]
    marked = docs.withColumns(
        {n: F.coalesce(level.value.cast("string"), F.lit("(none)")) for n, level in zip(leaf, levels)}
        | {
            "n_tokens": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long"),
            ident: F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        }
    )
    slim = reliable_checkpoint(
        marked.select(*[F.col(n).alias(m) for n, m in zip(leaf, names)], F.col(ident).alias("id"), "n_tokens")
    )
    tokens = slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(tokens, levels, share, epochs)
    plan = reliable_checkpoint(
        budgets.select(
            *names,
            F.coalesce(F.expr("try_divide(budget - budget % tokens, tokens)").cast("int"), F.lit(epochs)).alias("whole"),
            F.coalesce(F.expr("budget % nullif(tokens, 0)"), F.lit(0)).alias("rest"),
        )
    )

    keyed = slim.join(_small(plan), names).select(
        *names, "rest", _key(seed, F.col("whole"), F.col("id")).alias("key"), "n_tokens"
    )
    ranges = keyed.groupBy(*names, "rest", F.substring("key", 1, 4).alias("range")).agg(F.sum("n_tokens").alias("sum"))
    running = F.sum("sum").over(Window.partitionBy(*names).orderBy("range"))
    ends = ranges.withColumn("upto", running).where("upto > rest").groupBy(*names).agg(
        F.min("range").alias("range"), F.min(F.struct("range", (F.col("upto") - F.col("sum")).alias("n")))["n"].alias("before")
    )
    inside = (
        keyed.join(ends, names)
        .where(F.substring("key", 1, 4) == F.col("range"))
        .groupBy(*names, "range", "before", "rest", "key")
        .agg(F.sum("n_tokens").alias("sum"))
    )
    upto = F.sum("sum").over(Window.partitionBy(*names, "range").orderBy("key")) + F.col("before")
    cuts = inside.withColumn("upto", upto).groupBy(*names).agg(
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))), F.first("range")).alias("cut")
    )
    chosen = reliable_checkpoint(
        plan.join(cuts, names, "left").select(
            *[F.col(m).alias(n) for n, m in zip(leaf, names)], "whole", F.coalesce("cut", F.lit("g")).alias("cut")
        )
    )
    last = _key(seed, F.col("whole"), F.col(ident)) <= F.col("cut")
    taken = marked.join(_small(chosen), leaf).withColumn(
        "epoch",
        F.explode(
            F.filter(
                F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: (e < F.col("whole")) | ((e == F.col("whole")) & last)
            )
        ),
    )
    kept = [F.col(c) for c in docs.columns if c not in names]
    return taken.select(*kept, *[F.col(n).alias(m) for n, m in zip(leaf, names)], "epoch", "n_tokens")
