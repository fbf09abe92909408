"""Trigram near-duplicates within a log."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import round_even, set_similarity, trigrams
from paperloom.session import written


def with_trigrams(narratives: DataFrame) -> DataFrame:
    return narratives.withColumn("grams", trigrams(F.col("text"))).withColumn("n_grams", F.size("grams"))


def similarity_histogram(narratives: DataFrame) -> DataFrame:
    """sim_bracket and pairs over pairs of one log, section and column on different pages, both
    orders counted.

    Rows of one key with the same set of trigrams are one class with a count of rows per page; only
    classes meet and their pairs are weighed, so copies, however many, are measured once. A key's
    classes are spread over the cells of a grid (class_blocks), so no task holds a hot log.
    """
    keys = ["cr_id", "section_name", "column_name"]
    g = with_trigrams(narratives).select(*keys, "page_id", F.array_sort("grams").alias("grams")).where("cr_id is not null and section_name is not null and column_name is not null and page_id is not null")
    g = g.withColumn("cls", F.xxhash64("grams", F.reverse("grams")))
    pages = written(g.groupBy(*keys, "cls", "page_id").agg(F.count(F.lit(1)).alias("n"), F.first("grams").alias("grams")))
    classes = pages.groupBy(*keys, "cls").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.first("grams").alias("grams"))
    # pairs on one page count for nothing: rows of two classes that share a page
    a, b = pages.alias("a"), pages.alias("b")
    own = [*keys, "page_id"]
    shared = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in own] + [F.col("a.cls") < F.col("b.cls")]).groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.cls").alias("ca"), F.col("b.cls").alias("cb")).agg(F.sum(F.col("a.n") * F.col("b.n")).alias("shared"))
    blocked = class_blocks(classes, keys, "cls")
    a, b = blocked.alias("a"), blocked.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "lo", "hi"]] + [F.col("a.cls") < F.col("b.cls"), (F.col("a.lo") == F.col("a.hi")) | (F.col("a.own") != F.col("b.own"))]
    sim = round_even(set_similarity(F.col("a.grams"), F.col("b.grams")))
    met = a.join(b, on).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.cls").alias("ca"), F.col("b.cls").alias("cb"), sim.alias("sim_bracket"), (F.col("a.n") * F.col("b.n")).alias("all"))
    pairs = met.join(shared, [*keys, "ca", "cb"], "left").select("sim_bracket", (2 * (F.col("all") - F.coalesce("shared", F.lit(0)))).alias("pairs"))
    alike = classes.select(F.when(F.size("grams") > 0, 1.0).otherwise(0.0).alias("sim_bracket"), (F.col("n") * F.col("n") - F.col("same")).alias("pairs"))
    return pairs.unionByName(alike).where("pairs > 0").groupBy("sim_bracket").agg(F.sum("pairs").alias("pairs"))


#: Members from which a key's classes are cut into blocks that are compared pair of blocks by pair.
BLOCK = 256


def class_blocks(classes: DataFrame, keys: list[str], member: str) -> DataFrame:
    """``classes`` with own, lo and hi: each member stands in one group (lo, hi) for every block of its
    key, so that any two members of a key meet in one group and no group holds a whole hot key."""
    sizes = classes.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = classes.join(sizes, keys).withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("blocks", "other")


#: Trigrams over blanks, letters and digits: the most that can differ.
MOST_TRIGRAMS = 37**3


def _rare_first(grams: DataFrame, above: float):
    """A function of (grams) giving the rarest trigrams of a text, as many as two texts above the
    similarity must share one of. The counts of all trigrams (bounded by the alphabet) are shared."""
    counts = grams.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    rank = {r["g"]: (r["n"], r["g"]) for r in counts.limit(MOST_TRIGRAMS + 1).collect()}
    if len(rank) > MOST_TRIGRAMS:
        raise ValueError("more trigrams than the alphabet has")
    shared = grams.sparkSession.sparkContext.broadcast(rank)

    @F.pandas_udf("array<string>")
    def rarest(column: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([
            None if g is None else sorted(g, key=lambda x: known.get(x, (0, x)))[: len(g) - math.ceil(above * len(g) - 1e-9) + 1] for g in column
        ])

    return rarest


def near_duplicate_pairs(narratives: DataFrame, key: str = "cr_id", order: str = "summary_data_id", above: float = 0.95) -> DataFrame:
    """first, later: rows of one key with rounded trigram similarity above, by ``order`` (unique).

    Candidates share one of their rarest trigrams, so neither all pairs of a key nor a frequent
    trigram's rows meet; only those whose counts allow the similarity are measured.
    """
    least = above + 0.005
    g = with_trigrams(narratives.where(F.col(key).isNotNull() & F.col("text").isNotNull())).select(F.col(order).alias("o"), F.col(key).alias("k"), "grams", "n_grams")
    rarest = _rare_first(g, least)
    p = g.where("n_grams > 0").select("o", "k", "n_grams", F.explode(rarest("grams")).alias("g"))
    a, b = p.alias("a"), p.alias("b")
    on = (
        (F.col("a.k") == F.col("b.k")) & (F.col("a.g") == F.col("b.g")) & (F.col("a.o") < F.col("b.o"))
        & (F.least("a.n_grams", "b.n_grams") >= F.greatest("a.n_grams", "b.n_grams") * least)
    )
    pairs = a.join(b, on).select(F.col("a.o").alias("first"), F.col("b.o").alias("later")).distinct()
    ga, gb = g.select(F.col("o").alias("first"), F.col("grams").alias("ga")), g.select(F.col("o").alias("later"), F.col("grams").alias("gb"))
    return pairs.join(ga, "first").join(gb, "later").where(round_even(set_similarity(F.col("ga"), F.col("gb"))) > above).select("first", "later")


def drop_near_duplicates(narratives: DataFrame, key: str = "cr_id", order: str = "summary_data_id", above: float = 0.95) -> DataFrame:
    """Rows without an earlier row of the same key whose rounded trigram similarity is above.

    Pairwise, not transitive: the earlier row may itself be dropped; null keys never match.
    """
    later = near_duplicate_pairs(narratives, key, order, above).select(F.col("later").alias(order)).distinct()
    return narratives.join(later, order, "left_anti").select(*narratives.columns)
