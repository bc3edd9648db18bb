"""Exact order statistics of columns with any number of distinct values.

Spark's ``median`` keeps every distinct value of the column in one task, and
``percentile_approx`` is off by up to n/accuracy ranks. Here an approximate
sketch only brackets the exact answer: each round counts how many rows lie
below, on and inside the bracket and goes on with the rows inside, which are
fewer by a factor of about a thousand. Once few enough rows are left, one more
aggregate picks the exact elements; the rows it holds for all columns and ranks
together have one budget, and what does not fit is narrowed further first. Every pass is one map-side combined aggregate
over all columns and ranks at once; only a handful of numbers per rank reach the
driver. Up to ``EXACT_ROWS`` rows take two passes, a thousand times as many
three, and every further factor of a thousand two more.

Sketches of all map tasks are merged in two steps, so that with very many
partitions no single task receives all of them.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import present

# With accuracy well above the number of rows the sketch drops nothing, so its answer is exact.
EXACT_ROWS = 1_000_000
EXACT_ACCURACY = 10_000_000
# Size parameter of the bracket sketch; its rank error is well below the margin put around a share.
SKETCH_SIZE = 8_000
BRACKET_MARGIN = 0.0005
MERGE_GROUPS = 256


@dataclass
class _Search:
    """Open interval (low, high) known to hold the wanted element, which is its ``rank``-th of ``rows``."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    bracket: tuple[float, float] | None = None
    answer: float | None = None

    def inside(self, value: Column) -> Column:
        condition = value.isNotNull()
        if self.low is not None:
            condition &= value > self.low
        if self.high is not None:
            condition &= value < self.high
        return condition

    @property
    def share(self) -> float:
        return (self.rank - 0.5) / self.rows


def _around(share: float) -> list[float]:
    return [max(share - BRACKET_MARGIN, 0.0), min(share + BRACKET_MARGIN, 1.0)]


def _merged_sketches(
    df: DataFrame, values: Sequence[Column], partial: Mapping[str, Column] | None = None, merged: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row with a KLL sketch ``s<i>`` per value column, merged by groups of partitions first.

    ``partial`` aggregates are formed beside the sketches, and ``merged`` ones of them, in the same pass.
    """
    names = [f"s{i}" for i in range(len(values))]
    grouped = df.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("_group")).agg(
        *[F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(n) for n, v in zip(names, values)],
        *[c.alias(n) for n, c in (partial or {}).items()],
    )
    return grouped.agg(
        *[F.kll_merge_agg_double(n).alias(n) for n in names], *[c.alias(n) for n, c in (merged or {}).items()]
    )


def _quantiles(sketch: str, shares: Sequence[float]) -> Column:
    asked = F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, shares)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, asked)


def _by_interval(searches: Sequence[_Search]) -> list[list[_Search]]:
    intervals: dict[tuple, list[_Search]] = defaultdict(list)
    for s in searches:
        intervals[(s.column, s.low, s.high)].append(s)
    return list(intervals.values())


def _inner_values(values: Mapping[str, Column], groups: Sequence[Sequence[_Search]]) -> list[Column]:
    """The column values inside the interval of each group, null for other rows."""
    return [F.when(g[0].inside(values[g[0].column]), values[g[0].column]) for g in groups]


def _bracket(df: DataFrame, values: Mapping[str, Column], searches: Sequence[_Search]) -> None:
    groups = _by_interval(searches)
    asked = [_quantiles(f"s{i}", [p for s in g for p in _around(s.share)]) for i, g in enumerate(groups)]
    row = _merged_sketches(df, _inner_values(values, groups)).select(*asked).first()
    for found, group in zip(row, groups):
        for i, s in enumerate(group):
            s.bracket = (found[2 * i], found[2 * i + 1])


def _pick(df: DataFrame, values: Mapping[str, Column], searches: Sequence[_Search]) -> None:
    """The exact elements of intervals that hold few rows."""
    groups = _by_interval(searches)
    picked = [
        F.percentile_approx(v, [s.share for s in g], EXACT_ACCURACY) for v, g in zip(_inner_values(values, groups), groups)
    ]
    row = df.agg(*[x.alias(f"x{i}") for i, x in enumerate(picked)]).first()
    for found, group in zip(row, groups):
        for value, s in zip(found, group):
            s.answer = value


def _narrow(df: DataFrame, values: Mapping[str, Column], searches: Sequence[_Search]) -> None:
    """Count the rows around each bracket and keep the side that holds the wanted rank.

    Correct for any bracket; a good one merely leaves few rows.
    """
    counts = []
    for s in searches:
        v, (a, b) = values[s.column], s.bracket
        inside = s.inside(v)
        counts += [
            F.count_if(inside & (v < a)),
            F.count_if(inside & (v == a)),
            F.count_if(inside & (v > a) & (v < b)),
            F.count_if(inside & (v == b) & (v > a)),
        ]
    found = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()

    for i, s in enumerate(searches):
        (a, b), s.bracket = s.bracket, None
        below, on_a, between, on_b = found[4 * i : 4 * i + 4]
        if s.rank <= below:
            s.rows, s.high = below, a
        elif s.rank <= below + on_a:
            s.answer = a
        elif s.rank <= below + on_a + between:
            s.rank, s.rows, s.low, s.high = s.rank - below - on_a, between, a, b
        elif s.rank <= below + on_a + between + on_b:
            s.answer = b
        else:
            skipped = below + on_a + between + on_b
            s.rank, s.rows, s.low = s.rank - skipped, s.rows - skipped, b


def _too_many(searches: Sequence[_Search], budget: int) -> list[_Search]:
    """The open searches whose rows do not fit one aggregate with those of the others, largest first to go."""
    groups = sorted(_by_interval([s for s in searches if s.answer is None]), key=lambda g: max(s.rows for s in g))
    held, out = 0, []
    for group in groups:
        held += max(s.rows for s in group)
        if held > budget:
            out += group
    return out


def _resolve(df: DataFrame, values: Mapping[str, Column], searches: Sequence[_Search], exact_rows: int) -> None:
    while wide := _too_many(searches, exact_rows):
        if unbracketed := [s for s in wide if s.bracket is None]:
            _bracket(df, values, unbracketed)
        _narrow(df, values, wide)
    if last := [s for s in searches if s.answer is None]:
        _pick(df, values, last)


def _first_look(
    df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float], partial: Mapping[str, Column], merged: Mapping[str, Column]
) -> tuple[dict[str, tuple[int, list[tuple[float, float]]]], dict]:
    """Per column the exact number of values and a bracket per probability, and the merged aggregates, in one pass."""
    shares = [share for p in probabilities for share in _around(p)]
    sketches = _merged_sketches(df, list(values.values()), partial, merged)
    asked = [x for i in range(len(values)) for x in (F.kll_sketch_get_n_double(f"s{i}"), _quantiles(f"s{i}", shares))]
    row = sketches.select(*asked, *merged).first()
    found = {
        name: (row[2 * i] or 0, list(zip(row[2 * i + 1][::2], row[2 * i + 1][1::2])) if row[2 * i] else [])
        for i, name in enumerate(values)
    }
    return found, {name: row[name] for name in merged}


def _position(n: int, p: float, interpolate: bool) -> tuple[int, int, float]:
    """Ranks (from 1) of the element or of the two neighbours, and the weight of the second."""
    if not interpolate:
        k = max(1, math.ceil(p * n))
        return k, k, 0.0
    exact = p * (n - 1)
    k = math.floor(exact)
    return k + 1, min(k + 2, n), exact - k


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    interpolate: bool = False,
    exact_rows: int = EXACT_ROWS,
) -> dict[str, list[float | None]]:
    """Exact quantiles per column; missing values do not count, an empty column gives ``None``.

    Without ``interpolate`` the result is an element of the column (the smallest
    whose cumulative share reaches p); with it, neighbours are blended linearly. ``exact_rows`` bounds
    the rows that the last aggregate holds, of all columns and probabilities together.
    """
    return quantiles_beside(df, columns, probabilities, {}, {}, interpolate, exact_rows)[0]


def quantiles_beside(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    partial: Mapping[str, Column],
    merged: Mapping[str, Column],
    interpolate: bool = False,
    exact_rows: int = EXACT_ROWS,
) -> tuple[dict[str, list[float | None]], dict]:
    """``exact_quantiles``, and other aggregates from their first pass.

    ``partial`` are aggregates over groups of partitions, ``merged`` ones over those; values of the latter come back.
    """
    values = {name: present(df, name).cast("double") for name in columns}
    looked, extra = _first_look(df, values, probabilities, partial, merged)
    searches: dict[tuple[str, int], _Search] = {}
    places: dict[str, list[tuple[int, int, float]]] = {}
    for name, (n, brackets) in looked.items():
        if not n:
            continue
        places[name] = [_position(n, p, interpolate) for p in probabilities]
        for (low, high, _), bracket in zip(places[name], brackets):
            for k in (low, high):
                searches.setdefault((name, k), _Search(name, k, n, bracket=bracket))
    _resolve(df, values, list(searches.values()), exact_rows)

    def blend(name: str, low: int, high: int, weight: float) -> float:
        a, b = searches[(name, low)].answer, searches[(name, high)].answer
        return a if weight == 0.0 else a + (b - a) * weight

    quantiles = {
        name: [blend(name, *place) for place in places[name]] if name in places else [None] * len(probabilities)
        for name in columns
    }
    return quantiles, extra


def median(df: DataFrame, column: str) -> float | None:
    """The exact median, halfway between the two middle values when their number is even."""
    return exact_quantiles(df, [column], [0.5], interpolate=True)[column][0]
