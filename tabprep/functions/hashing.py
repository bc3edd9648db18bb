"""Replayable pseudo-random numbers: a pure function of key columns and a seed."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 4294967296.0  # eight hexadecimal digits


def key_digest(keys: Sequence[Column], seed: int | str = 42) -> Column:
    """md5 of seed and keys in hexadecimal.

    Unlike ``rand(seed)`` it does not depend on partition layout, so the same row
    gets the same text in every job, retry and engine.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))


def unit_interval(keys: Sequence[Column], seed: int | str = 42) -> Column:
    """A double in [0, 1): the first eight digits of the digest as a share of their range."""
    return F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("long") / F.lit(HASH_RANGE)


def digest_below(digest: Column, share: float) -> Column:
    """Whether the digest's ``unit_interval`` is below ``share``, without converting it to a number."""
    bound = math.ceil(share * HASH_RANGE)
    return F.lit(True) if bound >= HASH_RANGE else digest < F.lit(f"{bound:08x}")


def uniform(u: Column, low: float, high: float) -> Column:
    """Stretch a [0, 1) column to [low, high)."""
    return F.lit(float(low)) + u * F.lit(float(high) - float(low))


def quantized_uniform(u: Column, low: float, high: float, step: float) -> Column:
    """A uniform value rounded to a multiple of ``step``."""
    return F.round(uniform(u, low, high) / F.lit(float(step))) * F.lit(float(step))
