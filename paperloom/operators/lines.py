"""Word boxes to lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.stats import ordered_concat


def token_lines(tokens: DataFrame, page: list[str]) -> DataFrame:
    """One row per line of a page (block, paragraph, line) with its text; empty tokens are dropped."""
    keys = [*page, "block_num", "par_num", "line_num"]
    return tokens.where((F.col("text").isNotNull()) & (F.col("text") != "")).groupBy(*keys).agg(
        ordered_concat(F.col("text"), [F.col("word_num")]).alias("text"),
        F.min("left").alias("left"), F.min("top").alias("top"),
        F.max(F.col("left") + F.col("width")).alias("right"), F.max(F.col("top") + F.col("height")).alias("bottom"),
    )


def without_page_heads(tokens: DataFrame, page: list[str]) -> DataFrame:
    """Tokens of the lines that don't start as a page header or footer of the form does."""
    keys = [*page, "block_num", "par_num", "line_num"]
    heads = token_lines(tokens, page).where(F.col("text").startswith("AUTO CR - LOG SUMMARY") | F.col("text").startswith("CPD 00"))
    return tokens.join(heads.select(*keys), keys, "left_anti")


def document_lines(words: DataFrame, line: list[str], order: list[str]) -> DataFrame:
    """One row per line: its words joined in order, and its box."""
    return words.groupBy(*line).agg(
        ordered_concat(F.col("text"), [F.col(o) for o in order]).alias("text"),
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"),
    )


def confident_words(words: DataFrame, least: int = 50) -> DataFrame:
    """Words with confidence above ``least`` (unknown ones are dropped) and some text."""
    return words.where((F.col("conf") > least) & (F.trim("text") != ""))


def in_box(left, right, top, bottom):
    """Condition that a token lies wholly inside bounds, borders included."""
    return (
        (F.col("left") >= left) & (F.col("left") + F.col("width") <= right)
        & (F.col("top") >= top) & (F.col("top") + F.col("height") <= bottom)
    )


def same_line_groups(words: DataFrame, page: list[str]) -> DataFrame:
    """``words`` with line_no: a word starts a new line unless its top lies at or above the middle
    of the word before it in top order."""
    order = [F.col("y0"), *[F.col(c) for c in words.columns if c == "word_id"]]
    w = Window.partitionBy(*page).orderBy(*order)
    middle = F.lag((F.col("y0") + F.col("y1")) / 2).over(w)
    return words.withColumn("_new", F.when(F.col("y0") <= middle, 0).otherwise(1)).withColumn(
        "line_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_new")


def break_groups(rows: DataFrame, group: list[str], order: list[str], starts, name: str = "pid") -> DataFrame:
    """``rows`` with a running number that rises where ``starts`` holds (null counts as a start)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(w))


def fill_down(rows: DataFrame, group: list[str], order: list[str], column: str) -> DataFrame:
    """``column`` with nulls replaced by the last value before, within the group."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(w))
