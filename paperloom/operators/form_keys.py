"""Telling unevenly written file names and form headings apart.

A *cell* of the form is right file + section + column + row_num. Names arrive in any case,
with blanks, colons, line ends, 0 for o, 1 for l, or one letter missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_key(name: Column) -> Column:
    """Case-, blank- and underscore-insensitive form of a file name."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(name, r"\s+", " ")), "[ _]+", "_"))


def heading_key(name: Column) -> Column:
    """Letters of a heading in lower case, with the digits scanners put for letters undone."""
    return F.regexp_replace(F.translate(F.lower(name), "01", "ol"), "[^a-z]", "")


def one_deletes(key: Column) -> Column:
    """The key itself and every string one letter shorter (symmetric-delete neighbourhood)."""
    return F.array_distinct(
        F.concat(
            F.array(key),
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1))),
                lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, F.length(key))),
            ),
        )
    )


def _nearest(raw: DataFrame, right: DataFrame, on: list[str], least: int = 3) -> DataFrame:
    """Join raw.key to right.key within one edit (exact wins; an ambiguous nearest is dropped)."""
    a = raw.select(*on, F.col("key").alias("raw_key"), F.explode(one_deletes(F.col("key"))).alias("variant"))
    b = right.select(*on, F.col("key").alias("right_key"), "right", F.explode(one_deletes(F.col("key"))).alias("variant"))
    near = (
        a.join(b, [*on, "variant"])
        .select(*on, "raw_key", "right_key", "right")
        .distinct()
        .withColumn("d", F.levenshtein("raw_key", "right_key"))
        .where((F.col("d") == 0) | ((F.col("d") == 1) & (F.length("right_key") >= least)))
    )
    best = near.groupBy(*on, "raw_key").agg(F.min(F.struct("d", "right")).alias("m"), F.collect_set(F.struct("d", "right")).alias("all"))
    sole = F.size(F.filter("all", lambda x: x["d"] == F.col("m.d"))) == 1
    return best.where(sole).select(*on, F.col("raw_key").alias("key"), F.col("m.right").alias("right"))


def heading_map(cells: DataFrame, form: DataFrame) -> DataFrame:
    """(raw_section, raw_column) of ``cells`` with the right section, column, attribute and type.

    One row per distinct pair of written headings that belongs to the form; pairs that belong
    to no form column, or hold a null, are absent. ``form`` has the columns of form_columns.
    Matching runs over the distinct headings only, by equi-join on one-letter deletions.
    """
    raw = (
        cells.select(F.col("section_name").alias("raw_section"), F.col("column_name").alias("raw_column"))
        .where(F.col("raw_section").isNotNull() & F.col("raw_column").isNotNull())
        .distinct()
        .withColumns({"skey": heading_key(F.col("raw_section")), "ckey": heading_key(F.col("raw_column"))})
    )
    sections = form.select("section_name").distinct().select(heading_key(F.col("section_name")).alias("key"), F.col("section_name").alias("right"))
    by_section = _nearest(raw.select(F.col("skey").alias("key")).distinct(), sections, [])
    raw = raw.join(by_section.select(F.col("key").alias("skey"), F.col("right").alias("section_name")), "skey")
    columns = form.select("section_name", heading_key(F.col("column_name")).alias("key"), F.col("column_name").alias("right"))
    by_column = _nearest(raw.select("section_name", F.col("ckey").alias("key")).distinct(), columns, ["section_name"])
    raw = raw.join(
        by_column.select("section_name", F.col("key").alias("ckey"), F.col("right").alias("column_name")),
        ["section_name", "ckey"],
    )
    return raw.join(form.select("section_name", "column_name", "attribute", "value_type"), ["section_name", "column_name"]).select(
        "raw_section", "raw_column", "section_name", "column_name", "attribute", "value_type"
    )


def resolve_cells(cells: DataFrame, pdfs: DataFrame, form: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of ``cells`` that belong to a cell, with right pdf_name, section, column, attribute.

    Rows of an unknown file or a heading not of the form are left out; a null row_num stays a
    value of its own. ``keep`` names further columns of ``cells`` to carry. Extra columns are
    ignored. Joins are inner look-ups on unique keys, so a hot file is split by AQE skew join.
    """
    rows = cells.select(
        F.col("section_name").alias("raw_section"), F.col("column_name").alias("raw_column"),
        file_key(F.col("pdf_name")).alias("fkey"), "row_num", *keep,
    )
    names = pdfs.groupBy(file_key(F.col("filename")).alias("fkey")).agg(F.min("filename").alias("pdf_name"), F.min("id").alias("pdf_id"))
    return (
        rows.join(heading_map(cells, form), ["raw_section", "raw_column"])
        .join(names, "fkey")
        .drop("raw_section", "raw_column", "fkey")
    )
