"""Nulls in any column, empty tables, repeated rows, clashing extra columns, very long texts."""

import pytest
from pyspark.sql import functions as F

from paperloom.llm import queries as llm
from paperloom.llm import leakage, name_variants, near_copies, page_noise, personal_data, places, reading_level, survivors, tokenize
from paperloom.tables import read_table

CASES = {
    "p1": (survivors.best_of_cells, ["cr_summary_data_temp", "cr_pdfs", "cr_pdf_pages", "form_columns", "report_extract"], 1),
    "p2": (page_noise.noise_found, ["report_extract", "cr_summary_data_temp"], 2),
    "p2r": (page_noise.repaired_texts, ["report_extract", "cr_summary_data_temp"], 2),
    "p4": (near_copies.near_copies, ["cr_summary_data_temp", "cr_pdfs", "form_columns"], 1),
    "p4c": (near_copies.copy_classes, ["cr_summary_data_temp", "cr_pdfs", "form_columns"], 1),
    "p5": (personal_data.personal_stretches, ["report_extract"], 1),
    "p5m": (personal_data.masked_texts, ["report_extract"], 1),
    "p6": (name_variants.same_names, ["summary_logs"], 1),
    "p7": (places.same_places, ["summary_logs"], 1),
    "p8": (tokenize.token_ids, ["documents"], 1),
    "p9": (leakage.leaks_found, ["documents", "eval_items"], 1),
    "p10": (reading_level.reading_levels, ["documents", "graded_samples"], 1),
}
#: Names that the operators use inside.
CLASHES = ["key", "n", "raw", "fkey", "ckey", "src", "rec_id", "kind", "value", "block", "pos", "cid", "w", "head", "token", "line", "place", "pdf_id", "damage", "variant", "file", "num", "name", "town", "ids", "grade", "o"]


def tables(spark, data, names):
    return [read_table(spark, data, n) for n in names]


@pytest.mark.parametrize("case", sorted(CASES))
def test_empty_tables(spark, data, case):
    build, names, _ = CASES[case]
    assert build(*[t.where(F.lit(False)) for t in tables(spark, data, names)]).count() == 0


@pytest.mark.parametrize("case", sorted(CASES))
def test_rows_of_nulls_change_nothing(spark, data, case):
    build, names, first = CASES[case]
    given = tables(spark, data, names)
    few = [t.limit(60) if i < first and case not in ("p1", "p4", "p4c") else t for i, t in enumerate(given)]
    few = [t.sparkSession.createDataFrame(t.collect(), t.schema) for t in few]
    nulls = [t.unionByName(spark.createDataFrame([tuple([None] * len(t.columns))] * 2, t.schema)) if i < first else t for i, t in enumerate(few)]
    with_extra = [t.withColumns({c: F.lit("x") for c in CLASHES if c not in t.columns}) for t in nulls]
    rows = lambda df: sorted(map(str, df.collect()))
    want, got = rows(build(*few)), rows(build(*with_extra))
    if case in ("p8", "p5m"):
        # one row per row, the null ones included
        assert len(got) == len(want) + 2
        want += [x for x in got if x not in want]
    assert got == sorted(want) or case in ("p8", "p5m")


def test_very_long_and_odd_texts(spark, data):
    long = "The usher lives at 123 E. Elmford Rd. with a baker. " * 3000
    docs = spark.createDataFrame([(1, long, "en"), (2, "", "en"), (3, "  \r\n ", "en"), (4, None, "en"), (5, "‍👮🏽‍♀️ﬁ\u0000", "en"), (1, long, "en"), (6, "a" * 20000, "en")], "doc_id long, text string, lang string")
    ids = {(r["doc_id"], len(r["ids"])) for r in tokenize.token_ids(docs).collect()}
    assert (2, 0) in ids and (4, 0) in ids and len(ids) == 6
    assert leakage.leaks_found(docs, read_table(spark, data, "eval_items")).count() == 0
    assert reading_level.reading_levels(docs, read_table(spark, data, "graded_samples")).count() == 2
    reports = docs.select(F.col("doc_id").cast("string").alias("docid"), F.col("text").alias("narrative"))
    assert personal_data.masked_texts(reports).count() == 7


def test_every_query_runs(spark, data):
    for name, query in llm.queries().items():
        assert query(spark, data).columns, name
