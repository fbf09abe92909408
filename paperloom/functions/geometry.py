"""Distances and overlaps of intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import parallel_max, parallel_min


def gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Distance of two intervals, 0 where they meet; null if an end is null."""
    return parallel_max(b0 - a1, a0 - b1, F.lit(0) * a0)


def _shared(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    raw = parallel_min(a1, b1) - parallel_max(a0, b0)
    return F.when(raw.isNotNull(), F.greatest(raw, F.lit(0)))


def overlap_of_shorter(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length over the shorter interval; null if that has no length."""
    return F.try_divide(_shared(a0, a1, b0, b1), parallel_min(a1 - a0, b1 - b0))


def overlap_of_longer(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length over the longer interval; null if that has no length."""
    return F.try_divide(_shared(a0, a1, b0, b1), parallel_max(a1 - a0, b1 - b0))
