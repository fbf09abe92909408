"""Arriving page files as a stream that is drained and stops: the resume check as a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.classify import kept_lines, page_class


def arriving_pages(spark: SparkSession, folder: str) -> DataFrame:
    """pdf_name, page, text of page text files as they arrive."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder, wholetext=True).select(
        F.regexp_extract(name, r"^(.*)\.\d+\.txt$", 1).alias("pdf_name"), F.regexp_extract(name, r"\.(\d+)\.txt$", 1).try_cast("int").alias("page"),
        F.col("value").alias("text"),
    )


def ingest_pages(spark: SparkSession, folder: str, out: str, checkpoint: str) -> None:
    """Classify the pages that arrived since the last call and append them to a Parquet table."""
    pages = arriving_pages(spark, folder).withColumn("page_classification", page_class(kept_lines(F.col("text"))))
    query = pages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
