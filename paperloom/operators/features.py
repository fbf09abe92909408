"""Line features for section labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import bins, qgrams
from paperloom.operators.rules import LINE_PATTERNS, SECTION_NAMES
from paperloom.tables import spread

LINE = ["docid", "docpg", "line_id"]


def pattern_features(lines: DataFrame) -> DataFrame:
    """LINE and one 0/1 column per line pattern, null for a null text. A pattern needs a
    non-word character or an end on both sides; alternatives inside it share the sides unevenly,
    as the wrapping is textual."""
    return spread(lines).select(*LINE, *[F.col("text").rlike(rf"(?U)(\W|^){p}(\W|$)").cast("int").alias(n) for n, p in LINE_PATTERNS.items()])


def shape_features(lines: DataFrame) -> DataFrame:
    """LINE, x1 and bins of position, gap and digits, marks, capitals, first and last word."""
    w = Window.partitionBy("docid", "docpg").orderBy("line_id")
    text = F.col("text")
    y = [0.0, 0.5, 1.0, 1.5, 9.5, 10.0, None]
    capitals = F.regexp_count(text, F.lit("[A-Z]")) / F.nullif(F.length(text), F.lit(0))
    word = lambda p: F.trim(F.nullif(F.regexp_extract(text, p, 0), F.lit("")))
    return lines.select(
        *LINE, "x1",
        bins(F.col("y0"), y).alias("y0_bin"), bins(F.col("y1"), y).alias("y1_bin"), bins(F.col("x0"), [0.0, 0.5, 1.0, 3.0, 5.0, None]).alias("x0_bin"),
        text.contains("?").alias("has_qmark"), text.contains(":").alias("has_colon"), text.contains("#").alias("has_octo"),
        (capitals > 0.25).alias("has_caps"),
        word(r"(?U)^\w+(\W|$)").alias("word_1"), word(r"(?U)\w+$").alias("word_n"),
        bins(F.regexp_count(text, F.lit("[0-9]")), [0, 1, 5, None]).alias("has_digits"),
        bins(F.col("y0") - F.lag("y1").over(w), [None, 0.0, 0.1, 0.2, 0.3, None]).alias("has_gap"),
    )


def nearest_section(texts: DataFrame) -> DataFrame:
    """text, section_name, distance: the section heading nearest to each distinct text by cosine
    of 4-grams, if under .7; ties go to the first name.

    The gram counts of the distinct texts meet those of the 17 headings by gram; a heading
    without a shared gram is at distance 1 and needs no row.
    """
    spark = texts.sparkSession
    counts: dict[tuple[str, str], int] = {}
    for name, heading in SECTION_NAMES.items():
        for i in range(len(heading) - 3):
            counts[name, heading[i : i + 4]] = counts.get((name, heading[i : i + 4]), 0) + 1
    norms = {name: sum(n * n for (m, _), n in counts.items() if m == name) for name in SECTION_NAMES}
    headings = spark.createDataFrame([(n, g, float(c), float(norms[n])) for (n, g), c in counts.items()], "name string, gram string, hc double, hn double")
    grams = texts.select("text").where(F.col("text").isNotNull()).distinct().select("text", F.explode(qgrams(F.col("text"), 4)).alias("gram"))
    per = grams.groupBy("text", "gram").agg(F.count(F.lit(1)).cast("double").alias("tc"))
    per = per.withColumn("tn", F.sum(F.col("tc") * F.col("tc")).over(Window.partitionBy("text")))
    met = per.join(F.broadcast(headings), "gram").groupBy("text", "name").agg((1 - F.sum(F.col("tc") * F.col("hc")) / F.sqrt(F.max("tn") * F.max("hn"))).alias("d"))
    best = met.where("d < 0.7").groupBy("text").agg(F.min(F.struct(F.round("d", 9).alias("d"), "name")).alias("b"))
    return best.select("text", F.col("b.name").alias("section_name"), (F.col("b.d") + 0.0).alias("distance"))


def margin_sections(lines: DataFrame) -> DataFrame:
    """LINE and section_name of the lines wholly inside the band of a heading in the left margin.

    Bands that hold a band of another name are dropped (two equal bands drop each other).
    """
    margin = lines.where(F.col("x1") < 0.5)
    bands = margin.join(nearest_section(margin), "text").select("docid", "docpg", "section_name", "y0", "y1")
    a, b = bands.alias("a"), bands.alias("b")
    holds = (
        (F.col("a.docid") == F.col("b.docid")) & (F.col("a.docpg") == F.col("b.docpg")) & (F.col("b.y0") >= F.col("a.y0"))
        & (F.col("b.y1") <= F.col("a.y1")) & (F.col("a.section_name") != F.col("b.section_name"))
    )
    kept = a.join(b, holds, "left_anti").select("docid", "docpg", "section_name", F.col("y0").alias("b0"), F.col("y1").alias("b1"))
    return (
        lines.join(kept, ["docid", "docpg"]).where(F.col("b0").isNull() | ((F.col("y0") >= F.col("b0")) & (F.col("y1") <= F.col("b1"))))
        .select(*LINE, "section_name").distinct()
    )


def over_matched(sections: DataFrame) -> DataFrame:
    """LINE and n of the lines in more than one section (none, if all is well)."""
    return sections.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def collected_features(shapes: DataFrame, patterns: DataFrame, margins: DataFrame) -> DataFrame:
    """All features of the lines right of the margin, with those of the line before (prv_) and
    after (nxt_), and identifiers of page and line."""
    feats = (
        shapes.join(patterns, LINE, "left").join(margins.select(*LINE, F.col("section_name").alias("margin")), LINE, "left")
        .where(F.col("x1") > 0.5).drop("x1")
    )
    names = [c for c in feats.columns if c not in LINE]
    w = Window.partitionBy("docid", "docpg").orderBy("line_id")
    return feats.select(
        F.concat_ws(".", "docid", "docpg").alias("pg_identifier"), F.concat_ws(".", *LINE).alias("ln_identifier"), *LINE, *names,
        *[F.lag(n).over(w).alias(f"prv_{n}") for n in names], *[F.lead(n).over(w).alias(f"nxt_{n}") for n in names],
    )


def feature_strings(feats: DataFrame, keys: list[str]) -> DataFrame:
    """keys and features: sorted name=value strings of the non-null columns."""
    names = [c for c in feats.columns if c not in keys]
    pairs = F.array(*[F.when(F.col(n).isNotNull(), F.concat(F.lit(n + "="), F.col(n).cast("string"))) for n in names])
    return feats.select(*keys, F.array_sort(F.filter(pairs, lambda p: p.isNotNull())).alias("features"))
