"""Attribute-value rows into wide tables by positional stitching."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.readings import READERS, canonical_reading
from paperloom.operators.form_keys import resolve_cells
from paperloom.operators.ordinals import global_ordinals

#: Entities of one ordinal range; a range with all its attributes is what one task holds.
RANGE = 2048
#: Columns that a wide table may get; an error beyond.
MOST_ATTRIBUTES = 2000


def entity_ordinals(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct row of ``keys`` with a dense global ordinal in key order, from 0."""
    return global_ordinals(entities.select(*keys).distinct(), keys)


def stitch_wide(values: DataFrame, keys: list[str], columns: list[tuple[str, str]]) -> DataFrame:
    """One row per entity with one typed column per attribute.

    ``values`` has ``keys``, ``attribute`` and ``value`` (canonical text or null), at most one
    row per entity and attribute; ``columns`` lists (attribute, Spark type). Every entity of
    ``values`` comes out, with nulls where it has no value. Entities get global ordinals, each
    attribute becomes a vector aligned to ordinal ranges of ``RANGE``, and the vectors of a
    range are put side by side by position. Null keys are keys like any other; an empty input
    gives an empty table with the full schema.
    """
    numbered = entity_ordinals(values, keys)
    same = [F.col(f"v.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    rank = F.create_map(*[x for i, (name, _) in enumerate(columns) for x in (F.lit(name), F.lit(i))]) if columns else None
    placed = (
        values.where(F.col("value").isNotNull()).alias("v").join(numbered.alias("e"), condition)
        .select(
            (F.col("e.ordinal") / RANGE).cast("long").alias("block"), (F.col("e.ordinal") % RANGE).cast("int").alias("pos"),
            rank[F.col("v.attribute")].alias("attr"), F.col("v.value").alias("value"),
        )
    )
    skeleton = numbered.withColumns({"block": (F.col("ordinal") / RANGE).cast("long"), "pos": (F.col("ordinal") % RANGE).cast("int")})
    names = [name for name, _ in columns]
    fields = ", ".join([f"`{k}` {numbered.schema[k].dataType.simpleString()}" for k in keys] + [f"`{n}` string" for n in names])

    def assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("pos")
        out = {k: left[k].tolist() for k in keys}
        size = len(left)
        by_attr = {a: part for a, part in right.groupby("attr")} if len(right) else {}
        for i, name in enumerate(names):
            vector = [None] * size
            part = by_attr.get(i)
            if part is not None:
                for pos, value in zip(part["pos"].tolist(), part["value"].tolist()):
                    vector[pos] = value
            out[name] = vector
        return pd.DataFrame({k: pd.Series(v, dtype=left[k].dtype if k in keys else "object") for k, v in out.items()})

    wide = skeleton.groupBy("block").cogroup(placed.groupBy("block")).applyInPandas(assemble, fields)
    return wide.select(*keys, *[F.col(n).try_cast(t).alias(n) for n, t in columns])


def wide_columns(form: DataFrame) -> list[tuple[str, str]]:
    """(attribute, Spark type) of form_columns in order; the form table is fixed and small.

    An attribute that stands in several sections with unequal types becomes a string column.
    """
    rows = form.groupBy("attribute").agg(F.collect_set("value_type").alias("types")).orderBy("attribute").limit(MOST_ATTRIBUTES + 1).collect()
    if len(rows) > MOST_ATTRIBUTES:
        raise ValueError(f"more than {MOST_ATTRIBUTES} attributes for one wide table")
    return [(r["attribute"], READERS[r["types"][0]][1] if len(r["types"]) == 1 else "string") for r in rows]


def cell_values(cells: DataFrame, pdfs: DataFrame, form: DataFrame) -> DataFrame:
    """pdf_name, section_name, row_num, attribute, value: the last readable load of each cell.

    Cells without a readable load keep their row with a null value, so that their entry comes
    out. Of loads at the same moment the larger row_id counts.
    """
    rows = resolve_cells(cells, pdfs, form, ["row_id", "loaded_at", "text"])
    value = canonical_reading(F.col("text"), F.col("value_type"))
    return (
        rows.withColumn("value", value)
        .groupBy("pdf_name", "section_name", "row_num", "attribute")
        .agg(F.max(F.when(F.col("value").isNotNull(), F.struct("loaded_at", "row_id", "value"))).alias("last"))
        .select("pdf_name", "section_name", "row_num", "attribute", F.col("last.value").alias("value"))
    )


ENTRY = ["pdf_name", "section_name", "row_num"]


def form_entries(cells: DataFrame, pdfs: DataFrame, form: DataFrame) -> DataFrame:
    """One row per form entry (file, section, row_num) with the typed attributes of the form.

    Nulls, blanks and no-value marks give null attributes; rows of unknown headings or files
    are no entries; repeated rows don't matter; an empty input gives an empty typed table.
    """
    return stitch_wide(cell_values(cells, pdfs, form), ENTRY, wide_columns(form))


def readable_attributes(wide: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and attribute, one row per value that a wide table holds."""
    names = [c for c in wide.columns if c not in keys]
    held = F.filter(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    return wide.select(*keys, F.explode(held).alias("attribute"))
