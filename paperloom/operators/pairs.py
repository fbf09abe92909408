"""Pairs of rows that share a group and differ in a label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unequal_pairs(rows: DataFrame, group: str, label: str, row_id: str, names: tuple[str, str]) -> DataFrame:
    """The two row ids, smaller first, of each pair of rows of one group with unequal labels.

    Labels of a group meet once each, then each pair of labels is expanded to its rows: the work
    follows the result, and many rows of one label cost nothing by themselves. Rows with a null
    in group or label form no pairs.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    classes = rows.select(F.col(group).alias("g"), F.col(label).alias("l")).distinct()
    a, b = classes.alias("a"), classes.alias("b")
    met = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.l") < F.col("b.l"))).select(F.col("a.g").alias("g"), F.col("a.l").alias("la"), F.col("b.l").alias("lb"))
    left = rows.select(F.col(group).alias("g"), F.col(label).alias("la"), F.col(row_id).alias("ra"))
    right = rows.select(F.col(group).alias("g"), F.col(label).alias("lb"), F.col(row_id).alias("rb"))
    both = met.join(left, ["g", "la"]).join(right, ["g", "lb"])
    return both.select(F.least("ra", "rb").cast("bigint").alias(names[0]), F.greatest("ra", "rb").cast("bigint").alias(names[1])).distinct()


def linked_classes(rows: DataFrame, group: str, label: str, row_id: str, keep: list[str] | None = None) -> DataFrame:
    """row_id, ``keep``, class_id (the smallest row id of its group) and links: how many rows of its
    group have another label. What unequal_pairs holds, one row each and without expanding pairs.
    Counts are made per group and label first, so a hot group is partly summed before any shuffle."""
    kept = keep or []
    rows = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    same = rows.groupBy(group, label).agg(F.count_distinct(row_id).alias("same"), F.min(row_id).alias("least"))
    whole = same.groupBy(group).agg(F.sum("same").alias("all"), F.min("least").alias("class_id"))
    return rows.select(row_id, *kept, group, label).distinct().join(same.drop("least"), [group, label]).join(whole, group).select(
        F.col(row_id).cast("bigint").alias(row_id), *kept, F.col("class_id").cast("bigint").alias("class_id"), (F.col("all") - F.col("same")).cast("bigint").alias("links")
    )
