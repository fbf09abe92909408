"""Aggregates and window measures with definitions of their own."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def median_counting_nulls(value: Column) -> Column:
    """Median whose middle is found with nulls counted (sorted last) but not averaged.

    Of n rows, nulls included, the middle one or two sorted values are averaged, nulls among
    them skipped: {1,2,3,null} gives 2.5. Null if no middle value is known. Gathers a group's
    values; for groups of unbounded size use ``median`` on non-null input instead.
    """
    n = F.count(F.lit(1))
    middle = F.slice(
        F.sort_array(F.collect_list(value.cast("double"))),
        F.ceil(n / F.lit(2.0)).cast("int"), F.when(n % 2 == 0, 2).otherwise(1),
    )
    return F.try_divide(F.aggregate(middle, F.lit(0.0), lambda s, x: s + x), F.size(middle))


def average_rank(order: Column, partition: WindowSpec, ties: WindowSpec) -> Column:
    """Rank with ties sharing their average; ``partition`` is unordered, ``ties`` adds the value."""
    return F.rank().over(partition.orderBy(order)) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0)


def distinct_sorted_concat(value: Column, separator: str = "; ") -> Column:
    """Distinct non-null values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def ordered_concat(value: Column, order: list[Column], separator: str = " ") -> Column:
    """Non-null values joined in the given order."""
    rows = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], value.alias("v")))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), separator)
