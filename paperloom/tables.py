"""Table readers and the fixed schemas of the record model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: DDL schemas of the record model, by table (units stand in the column name where they matter).
SCHEMAS = {
    "cr_batch": ("id INT, dropbox_path STRING, date_received TIMESTAMP"),
    "cr_batch_data": (
        "id INT, batch_id INT, control_number STRING, prod_begin STRING, prod_end STRING, "
        "prod_begin_attachment STRING, prod_end_attachment STRING, filename STRING, "
        "filepath STRING, log_number STRING, placeholder STRING"
    ),
    "cr_pdfs": (
        "id INT, batch_id INT, cr_id INT, page_count INT, filename STRING, doccloud_id INT, doccloud_url STRING"
    ),
    "cr_pdf_pages": ("id INT, pdf_id INT, page_num INT, page_classification STRING"),
    "cr_ocr_text": ("id INT, pdf_id INT, page_id INT, ocr_text STRING"),
    "cr_summary_data": (
        "id INT, pdf_id INT, page_id INT, section_name STRING, column_name STRING, row_num INT, text STRING"
    ),
    "cr_redaction_blocks": ("id INT, page_num INT, coords STRING"),
    "cr_ocr_tokens": (
        "id INT, pdf_id INT, page_id INT, page_num INT, lvl INT, block_num INT, par_num INT, line_num INT, "
        "word_num INT, left_bound INT, top_bound INT, width_bound INT, height_bound INT, conf INT, text STRING, "
        "background_color STRING, text_color STRING, background_color_name STRING"
    ),
    "token_tsv": (
        "level INT, page_num INT, block_num INT, par_num INT, line_num INT, word_num INT, "
        "left INT, top INT, width INT, height INT, conf INT, text STRING"
    ),
    "word_box_px": (
        "docid STRING, docpg INT, line_id INT, word_id INT, text STRING, x0 INT, y0 INT, x1 INT, y1 INT, conf INT"
    ),
}


def spread(df: DataFrame, waves: int = 3) -> DataFrame:
    """``df`` over at least ``waves`` partitions a core, so that few large files don't leave
    cores idle in row-by-row Python steps. Reads the plan only; well split inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(waves * cores) if df.rdd.getNumPartitions() < waves * cores else df
