import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as tx
from paperloom.functions.geometry import gap, overlap_of_longer, overlap_of_shorter
from paperloom.functions.readings import canonical_reading
from paperloom.functions.stats import median_counting_nulls


def one(spark, column, **values):
    types = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()) or "x int"
    row = tuple(float(v) if isinstance(v, (int, float)) else v for v in values.values()) or (1,)
    return spark.createDataFrame([row], types).select(column.alias("r")).first()["r"]


def test_trigram_similarity_by_hand(spark):
    sim = tx.set_similarity(tx.trigrams(F.col("a")), tx.trigrams(F.col("b")))
    assert one(spark, sim, a="word", b="two words") == pytest.approx(4 / 11)
    assert one(spark, sim, a="", b="") == 0.0
    assert one(spark, tx.trigrams(F.col("a")), a=None) is None


def test_normalized_levenshtein(spark):
    d = tx.normalized_levenshtein(F.col("a"), F.col("b"))
    assert one(spark, d, a="", b="") == 0.0
    assert one(spark, d, a="é", b="e") == 1.0
    assert one(spark, d, a="abcd", b="abc") == 0.25
    assert one(spark, d, a=None, b="abc") is None


def test_osa_against_levenshtein(spark):
    rng = random.Random(1)
    pairs = [("ca", "abc"), ("ab", "ba"), ("", "x"), ("same", "same"), ("incident", "incidnet")]
    pairs += [("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.levenshtein("a", "b").alias("lev"), tx.osa_below(F.col("a"), F.col("b"), 3).alias("near")).collect()
    assert tx.osa("ca", "abc") == 3 and tx.osa("ab", "ba") == 1 and tx.osa(None, "a") is None
    for r in rows:
        d = tx.osa(r["a"], r["b"])
        assert (r["lev"] + 1) // 2 <= d <= r["lev"]
        assert r["near"] == (d < 3)


def test_qgram_distances_and_short_texts(spark):
    assert one(spark, tx.qgram_jaccard_distance(F.col("a"), F.col("b"), 8), a="abc", b="abcdefghij") == 1.0
    assert one(spark, tx.qgram_cosine_distance(F.col("a"), F.col("b"), 4), a="NARRATIVE", b="NARRATIVE") == 0.0
    assert one(spark, tx.qgram_cosine_distance(F.col("a"), F.col("b"), 2), a="abab", b="ab") == pytest.approx(1 - 2 / 5**0.5)


def test_round_even_and_bins(spark):
    assert one(spark, tx.round_even(F.col("v")), v=0.125) == 0.12
    label = tx.bins(F.col("v"), [0, 0.5, 1, None])
    assert [one(spark, label, v=v) for v in (0, 0.5, 0.6, 7, -1)] == ["[0,0.5]", "[0,0.5]", "(0.5,1]", "(1,Inf]", None]


def test_file_names(spark):
    stem, first, last = tx.page_tail(F.col("f"))
    assert one(spark, stem, f="LOG_123-0003-0004.pdf") == "LOG_123.pdf"
    assert (one(spark, first, f="LOG_123-0003-0004.pdf"), one(spark, last, f="LOG_123-0003-0004.pdf")) == (3, 4)
    assert one(spark, first, f="short") is None


def test_intervals(spark):
    a = [F.lit(float(v)) for v in (0, 10, 5, 25)]
    assert one(spark, overlap_of_shorter(*a)) == 0.5 and one(spark, overlap_of_longer(*a)) == 0.25 and one(spark, gap(*a)) == 0
    assert one(spark, gap(F.lit(0.0), F.lit(1.0), F.lit(4.0), F.lit(5.0))) == 3


def test_median_counts_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, None), (2, None), (3, 4)], "g int, v int")
    got = dict(df.groupBy("g").agg(median_counting_nulls(F.col("v")).alias("m")).collect())
    assert got == {1: 2.5, 2: None, 3: 4.0}


@pytest.mark.parametrize("text,kind,value", [
    (" 1,234 ", "int", "1234"), ("#12 pp.", "int", "12"), ("999999", "int", "999999"), ("12a4", "int", None), ("--", "string", None), ("see narrative", "int", None),
    ("02/31/2014", "date", None), ("13/27/2014", "date", None), ("00/00/0000", "date", None), ("17-MAR-2015", "date", "2015-03-17"), ("Jul 9, 2015", "date", "2015-07-09"),
    ("9 Oct 2015", "date", "2015-10-09"), ("2015-02-03", "date", "2015-02-03"), ("3/4/2015 1310 hrs", "timestamp", "2015-03-04 13:10:00"),
    ("Dec 12, 2014 12:05 AM", "timestamp", "2014-12-12 00:05:00"), ("31-NOV-2014", "timestamp", None), ("3/4/2015", "timestamp", "2015-03-04 00:00:00"),
    ("Y", "boolean", "true"), ("FALSE", "boolean", "false"), ("maybe", "boolean", None), (None, "string", None), (". .", "string", None), (" Photo ", "string", "Photo"),
])
def test_readings(spark, text, kind, value):
    assert one(spark, canonical_reading(F.col("t"), F.col("k")), t=text, k=kind) == value


def test_pixels(spark):
    import numpy as np

    from paperloom.functions import pixels

    assert pixels.luminance((1, 1, 1)) == pytest.approx(0.8718)
    assert pixels.brightened(np.array([[0, 127, 255]]), 30, 30).tolist() == [[0, 157, 255]]
    dark, light = pixels.text_and_background(np.array([[[0, 0, 0], [250, 250, 250], [2, 2, 2], [254, 254, 254]]]))
    assert dark.tolist() == [1, 1, 1] and light.tolist() == [252, 252, 252]
    page = np.full((100, 120), 255, np.uint8)
    page[10:30, 20:60] = 0
    page[50:52, 5:115] = 0
    page[60:70, 100:110] = 0
    df = spark.createDataFrame([(1, bytearray(page.tobytes()), 120, 100), (2, bytearray(b"x"), 5, 5), (3, None, 1, 1)], "page_num int, content binary, width int, height int")
    assert [tuple(r) for r in pixels.redaction_blocks(df).collect()] == [(1, "20,10,40,20")]
