"""Randomness that depends on the data only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bits(text: Column) -> Column:
    """The first 32 bits of the MD5 digest as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def unit_hash(text: Column) -> Column:
    """A value in [0, 1) fixed by ``text``."""
    return _bits(text).cast("double") / F.lit(4294967296.0)


def percent_bucket(*keys: Column) -> Column:
    """An integer 0..99 fixed by the keys."""
    return _bits(F.concat_ws(":", *[k.cast("string") for k in keys])) % 100


def unit_vector(prefix: str, key: Column, rank: int, low: float = 0.0, high: float = 1.0) -> Column:
    """``rank`` uniform values in [low, high), fixed by prefix and key."""
    cells = [unit_hash(F.concat(F.lit(prefix), key.cast("string"), F.lit(f":{k}"))) for k in range(rank)]
    if (low, high) != (0.0, 1.0):
        cells = [F.lit(low) + cell * F.lit(high - low) for cell in cells]
    return F.array(*cells)
