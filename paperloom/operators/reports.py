"""Batch reports: counts and page statistics per batch, with a grand-total row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.stats import median_counting_nulls


def _five(value: str):
    v = F.col(value)
    return [
        median_counting_nulls(v).alias("median"), F.min(v).cast("bigint").alias("min"), F.max(v).cast("bigint").alias("max"),
        F.round(F.avg(v), 6).alias("avg"), F.sum(v).cast("bigint").alias("sum"),
    ]


def pdfs_per_batch(batches: DataFrame, pdfs: DataFrame) -> DataFrame:
    """count, dropbox_path per batch, and the total as 'all' (pdfs without a batch only there)."""
    per = pdfs.groupBy("batch_id").agg(F.count(F.lit(1)).alias("count"))
    named = per.join(batches.select(F.col("id").alias("batch_id"), "dropbox_path"), "batch_id").select("count", "dropbox_path")
    total = pdfs.agg(F.count(F.lit(1)).alias("count")).withColumn("dropbox_path", F.lit("all"))
    return named.unionByName(total).distinct()


def crids_per_batch(batches: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Statistics of the number of pdfs per log and batch, and over all logs as 'combined'.

    The pdfs without a log form a group of count 0, as count(cr_id) has it.
    """
    paths = batches.select(F.col("id").alias("batch_id"), "dropbox_path")
    counts = pdfs.groupBy("batch_id", "cr_id").agg(F.count("cr_id").alias("n"))
    per = counts.join(paths, "batch_id").groupBy("cr_id", "dropbox_path").agg(F.sum("n").alias("n")).groupBy("dropbox_path").agg(*_five("n"))
    every = pdfs.groupBy("cr_id").agg(F.count("cr_id").alias("n")).agg(*_five("n")).withColumn("dropbox_path", F.lit("combined"))
    return per.unionByName(every).distinct()


def pages_per_batch(batches: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Statistics of page_count per batch path and over all pdfs as 'combined'."""
    paths = batches.select(F.col("id").alias("batch_id"), "dropbox_path")
    per = pdfs.join(paths, "batch_id").groupBy("dropbox_path").agg(*_five("page_count"))
    every = pdfs.agg(*_five("page_count")).withColumn("dropbox_path", F.lit("combined"))
    return per.unionByName(every).distinct()


def count_histogram(pdfs: DataFrame) -> DataFrame:
    """count (pdfs of a log) and count_of_count (logs with that many)."""
    return pdfs.groupBy("cr_id").agg(F.count("cr_id").alias("count")).groupBy("count").agg(F.count("count").alias("count_of_count"))


def count_histogram_per_batch(batches: DataFrame, pdfs: DataFrame) -> DataFrame:
    """The histogram of pdfs per log within each batch path."""
    paths = batches.select(F.col("id").alias("batch_id"), "dropbox_path")
    return (
        pdfs.groupBy("cr_id", "batch_id").agg(F.count("cr_id").alias("count")).join(paths, "batch_id")
        .groupBy("count", "dropbox_path").agg(F.count("count").alias("count_of_count"))
    )


def ordered_histogram(pdfs: DataFrame) -> DataFrame:
    """The histogram in report order with its position: commonest first, then smaller counts."""
    from pyspark.sql import Window

    h = count_histogram(pdfs)  # as many rows as there are different counts
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("count_of_count"), F.asc_nulls_last("count"))
    return h.withColumn("position", F.row_number().over(order).cast("bigint"))
