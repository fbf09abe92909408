"""Best representative of each duplicate group: skyline selection, field by field.

The loads of one form cell are duplicates. Each field has dominance layers of its own: entries
that no other dominates form the first layer, those dominated only by that layer the second, and
so on. A text is placed by trust (no damage from scanning), completeness (letters and digits it
holds) and recency (loaded_at). A page number is whole or missing, so it is placed by recency
alone; one that the file doesn't have counts as missing. The first layer that holds a value of the
field gives it, by the lexicographic policy trust, completeness, recency: the text from the first
layer, as its best entry is never dominated; the page, where the last load has none or a wrong
one, from the next layer, which is the rule of TESTDATA.md.

Defined results: a cell whose loads hold no text at all keeps a null text_row_id; a cell
without a load on a page of its file a null page_num. Of exactly repeated loads (same text,
same loaded_at) the larger row_id is taken. Rows of unknown files or headings belong to no
cell. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.readings import plain_text
from paperloom.llm.page_noise import PROSE_COLUMNS, damaged_records
from paperloom.operators.form_keys import resolve_cells

CELL = ["pdf_name", "section_name", "column_name", "row_num"]


def placed_loads(cells: DataFrame, pdfs: DataFrame, pages: DataFrame, form: DataFrame, report_extract: DataFrame) -> DataFrame:
    """The loads of all cells with complete, trust, page_ok and loaded_at."""
    rows = resolve_cells(cells, pdfs, form, ["row_id", "page_num", "text", "loaded_at"])
    known = pages.select("pdf_id", "page_num", F.lit(True).alias("page_ok")).distinct()
    rows = rows.join(known, ["pdf_id", "page_num"], "left")
    damage = damaged_records(report_extract, cells).where("src = 'cr_summary_data_temp'").select(F.col("rec_id").cast("bigint").alias("row_id"), F.lit(True).alias("damage"))
    prose = F.col("column_name").isin(*PROSE_COLUMNS)
    rows = rows.join(damage, "row_id", "left")
    value = plain_text(F.col("text"))
    return rows.select(
        *CELL, "row_id", "page_num", "loaded_at",
        F.coalesce("page_ok", F.lit(False)).alias("page_ok"),
        F.coalesce(F.length(F.regexp_replace(value, r"[^\p{L}\p{N}]", "")), F.lit(0)).alias("complete"),
        F.when(prose & F.col("damage").isNotNull(), 0).otherwise(1).alias("trust"),
    )


def dominance_layers(entries: Column, dimensions: list[str]) -> Column:
    """``entries`` (structs) as structs of layer and entry, best first.

    An entry's layer is one more than the deepest layer among the entries that are at least as good
    in every dimension; of equal ones the larger struct goes first. Quadratic in the entries of a
    group, which are distinct marks, not loads.
    """
    ranked = F.sort_array(F.transform(entries, lambda e: F.struct(F.struct(*[e[d].alias(d) for d in dimensions]).alias("by"), e.alias("entry"))), asc=False)

    def place(done: Column, m: Column) -> Column:
        over = F.filter(done, lambda d: _all([d["entry"][k] >= m["entry"][k] for k in dimensions]))
        layer = F.coalesce(F.array_max(F.transform(over, lambda d: d["layer"])), F.lit(0)) + 1
        return F.concat(done, F.array(F.struct(layer.alias("layer"), m["entry"].alias("entry"))))

    # in falling order every dominator comes before what it dominates
    none = F.filter(F.transform(ranked, lambda m: F.struct(F.lit(0).alias("layer"), m["entry"].alias("entry"))), lambda _: F.lit(False))
    return F.aggregate(ranked, none, place)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def survivor(layers: Column, holds: str, policy: list[str]) -> Column:
    """The entry of the first layer that holds a value, by the lexicographic policy; null if none holds."""
    holding = F.filter(layers, lambda x: x["entry"][holds])
    top = F.array_min(F.transform(holding, lambda x: x["layer"]))
    best = F.array_max(F.transform(F.filter(holding, lambda x: x["layer"] == top), lambda x: F.struct(F.struct(*[x["entry"][k].alias(k) for k in policy]).alias("by"), x["entry"].alias("entry"))))
    return best["entry"]


def layered_cells(loads: DataFrame, group: list[str]) -> DataFrame:
    """group, first_row_id, n, texts, pages: per group the layers of its text and of its page.

    Loads are first reduced to the latest of each (trust, complete, page_ok): an earlier one with the
    same marks is dominated by it in every dimension and holds no more. What is gathered per group is one entry
    per marks, not one per load, and the reduction runs before the shuffle.
    """
    latest = loads.groupBy(*group, "trust", "complete", "page_ok").agg(
        F.max(F.struct("loaded_at", "row_id", "page_num")).alias("last"), F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    entry = F.struct("trust", "complete", (F.col("complete") > 0).alias("has_text"), "page_ok", "last.loaded_at", "last.row_id", "last.page_num")
    groups = latest.groupBy(*group).agg(F.min("first").alias("first_row_id"), F.sum("n").alias("n"), F.collect_list(entry).alias("entries"))
    newest = lambda ok: F.array_max(F.transform(F.filter("entries", lambda e: e["page_ok"] == F.lit(ok)), lambda e: F.struct(
        e["loaded_at"].alias("loaded_at"), e["row_id"].alias("row_id"), e["page_num"].alias("page_num"), e["page_ok"].alias("page_ok"))))
    return groups.select(
        *group, "first_row_id", "n", dominance_layers(F.col("entries"), ["trust", "complete", "loaded_at"]).alias("texts"),
        dominance_layers(F.array_compact(F.array(newest(True), newest(False))), ["loaded_at", "row_id"]).alias("pages"),
    )


def best_of_cells(cells: DataFrame, pdfs: DataFrame, pages: DataFrame, form: DataFrame, report_extract: DataFrame) -> DataFrame:
    """first_row_id, text_row_id, page_num of every cell loaded at least twice."""
    layered = layered_cells(placed_loads(cells, pdfs, pages, form, report_extract), CELL).where(F.col("n") >= 2)
    return layered.select(
        F.col("first_row_id").cast("bigint").alias("first_row_id"),
        survivor(F.col("texts"), "has_text", ["trust", "complete", "loaded_at", "row_id"])["row_id"].cast("bigint").alias("text_row_id"),
        survivor(F.col("pages"), "page_ok", ["loaded_at", "row_id"])["page_num"].cast("int").alias("page_num"),
    )
