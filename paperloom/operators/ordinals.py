"""Dense global numbers without a step that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage


def global_ordinals(rows: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """``rows`` with a number from 0 in the given order, nulls first; ties in any order.

    Range-partitioned, then per-partition counts turned into offsets. The placed table is
    written before it is numbered, so a lost executor can't renumber it. The only broadcast is
    one row per partition.
    """
    by = [F.col(k).asc_nulls_first() for k in order]
    placed = cut_lineage(rows.repartitionByRange(*by)).withColumn("_part", F.spark_partition_id())
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1
    return placed.withColumn("_place", place).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")
