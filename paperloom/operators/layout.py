"""Groups of word boxes: columns in one dimension, chunks in two."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.runs import map_runs


def column_islands(words: DataFrame, page: list[str], threshold: float = 40) -> DataFrame:
    """``words`` with column_id: connected groups of boxes less than ``threshold`` apart in x.

    In order of x0 a new group starts where a box begins ``threshold`` or more after all boxes
    before it end; for x1 >= x0 these are the connected components. Null boxes get no group.
    """
    w = Window.partitionBy(*page).orderBy("x0", "x1")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    known = F.col("x0").isNotNull() & F.col("x1").isNotNull()
    rows = words.withColumn("_new", F.when(known & (reach.isNull() | (F.col("x0") - reach >= threshold)), 1).otherwise(0))
    number = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("column_id", F.when(known, number)).drop("_new")


def _components(key: tuple, rows: list[tuple]) -> list[tuple]:
    """Union of boxes nearer than the smaller size in x and in y, by a sweep along x."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    widest = max((r[5] for r in rows), default=0.0)
    live: list[int] = []
    for i, (_, x0, x1, y0, y1, sz) in enumerate(rows):
        live = [j for j in live if x0 - rows[j][2] < widest]
        for j in live:
            _, _, b1, c0, c1, other = rows[j]
            near = min(sz, other)
            if max(x0 - b1, 0) < near and max(y0 - c1, c0 - y1, 0) < near:
                parent[root(i)] = root(j)
        live.append(i)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(*key, r[0], least[root(i)]) for i, r in enumerate(rows)]


def chunk_components(words: DataFrame, page: list[str]) -> DataFrame:
    """page..., word_id, chunk_id (its least word_id) of the words with a letter or digit.

    A page is one group, as large as its words; boxes with a null are left out.
    """
    kept = words.where(F.col("text").rlike("[A-Za-z0-9]")).dropna(subset=["word_id", "x0", "x1", "y0", "y1", "sz"])
    kept = kept.select(*page, F.col("word_id").cast("bigint").alias("word_id"), *[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "y0", "y1", "sz")])
    fields = ", ".join(f"{k} {kept.schema[k].dataType.simpleString()}" for k in page)
    return map_runs(kept, page, ["word_id", "x0", "x1", "y0", "y1", "sz"], _components, f"{fields}, word_id bigint, chunk_id bigint")


def chunk_boxes(words: DataFrame, chunks: DataFrame, page: list[str]) -> DataFrame:
    """Box and area of each chunk."""
    box = words.join(chunks, [*page, "word_id"]).groupBy(*page, "chunk_id").agg(
        F.min("x0").alias("cx0"), F.max("x1").alias("cx1"), F.min("y0").alias("cy0"), F.max("y1").alias("cy1")
    )
    return box.withColumn("area", (F.col("cx1") - F.col("cx0")) * (F.col("cy1") - F.col("cy0")))


def words_in_chunks(words: DataFrame, boxes: DataFrame, page: list[str]) -> DataFrame:
    """Each word with the largest chunk box that holds it wholly (ties kept)."""
    inside = words.join(boxes, page).where(
        (F.col("x0") >= F.col("cx0")) & (F.col("x1") <= F.col("cx1")) & (F.col("y0") >= F.col("cy0")) & (F.col("y1") <= F.col("cy1"))
    )
    w = Window.partitionBy(*page, "word_id")
    return inside.withColumn("_m", F.max("area").over(w)).where("area = _m").drop("_m")


def ambiguous_words(placed: DataFrame, page: list[str]) -> DataFrame:
    """page..., word_id, n of the words in more than one chunk."""
    return placed.groupBy(*page, "word_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
