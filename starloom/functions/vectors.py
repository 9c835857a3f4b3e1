"""Arithmetic on factor vectors (``ARRAY<DOUBLE>`` columns)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this width unrolled expressions outgrow one generated method.
UNROLL_LIMIT = 64


def dot(a: Column, b: Column, rank: int | None = None) -> Column:
    """Dot product. With a known rank the sum is unrolled, which keeps it in
    generated code; otherwise a higher-order function walks the arrays."""
    if rank is not None and rank <= UNROLL_LIMIT:
        return reduce(add, [a[k] * b[k] for k in range(rank)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_norm(a: Column, rank: int | None = None) -> Column:
    return dot(a, a, rank)


def widen(a: Column) -> Column:
    """Vector elements as doubles, whatever numeric type they were stored in."""
    return a.cast("array<double>")


def has_nan(a: Column) -> Column:
    return F.exists(a, lambda x: F.isnan(x))


def nan_vectors(a: Column) -> Column:
    """Aggregate: how many vectors hold a NaN."""
    return F.count_if(has_nan(a))


def squared_error(rating: Column, a: Column, b: Column, rank: int | None = None) -> Column:
    return F.pow(rating - dot(a, b, rank), 2)
