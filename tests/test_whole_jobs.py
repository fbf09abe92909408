"""Registered queries read their whole input: brute force on small tables."""

import re

import pytest

from paperloom.operators import form_keys
from paperloom.plans import queries as core
from paperloom.tables import read_table


def test_jaccard8_reads_whole_texts(spark, tmp_path):
    note = core._NOTE
    filler = "The officer spoke to two witnesses near the corner store. " * 6
    texts = [filler + note, note + filler, filler, note, "short", "", "é" * 300 + note + "漢字 " * 50, note[:10], None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    grams = lambda t: {t[i : i + 8] for i in range(len(t) - 7)}
    distance = lambda a, b: 0.0 if a == b else round(1 - len(grams(a) & grams(b)) / len(grams(a) | grams(b)), 9)
    want = {i: distance(t, note) for i, t in enumerate(texts) if t is not None}
    assert {r["doc_id"]: r["d"] for r in core.queries()["jaccard8"](spark, str(tmp_path)).collect()} == want


def _form_fixture(spark, folder, data):
    long = "On the said date the accused officer, while on duty near the corner store,\r\nspoke to two witnesses and\n\nleft the scene without a report of any kind being made or asked for."
    rows = [
        (1, "LOG_1.pdf", 2, "Accused Members", "Initial / Intake Allegation", 1, long), (2, "LOG_1.pdf", 2, "Accused Members", "Initial / Intake Allegation", 2, "second entry"),
        (3, "log 1.PDF", 2, "ACCUSED  MEMBERS", "Name", 2, "doe, jane"), (4, "LOG_1.pdf", 2, "Accused Members", "Name", 1, "ROE, RICHARD"), (5, "LOG_1.pdf", 2, "Accused Members", "R0le", 1, "Name"),
        (6, "LOG_1.pdf", 2, "Accused Members", "Name", 1, "R0E, RlCHARD"), (7, "LOG_1.pdf", 2, "Attachments", "Narrative", None, "a b c d e f g h i j k l m"), (8, "LOG_1.pdf", 2, "Attachments", "No.", 1, "XY12"),
        (9, "LOG_1.pdf", None, "Attachments", "No.", 1, "no page"), (10, "LOG_1.pdf", 3, "Attachments", "Type", 1, "  "), (11, "LOG_1.pdf", 3, "Attachments", "Total", 1, "no heading"), (12, "other.pdf", 1, "Attachments", "Status", 4, "kept"),
    ] + [(20 + i, "LOG_2.pdf", 1, "Current Allegations", c, i // 2, f"entry {i} " * (i % 9 + 1)) for i, c in enumerate(["Allegation", "Finding"] * 40)]
    names = "row_id long, pdf_name string, page_num int, section_name string, column_name string, row_num int, text string"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/cr_summary_data_temp.parquet")
    spark.createDataFrame([(1, "LOG_1.pdf"), (2, "LOG_2.pdf")], "id long, filename string").write.parquet(f"{folder}/cr_pdfs.parquet")
    read_table(spark, data, "form_columns").write.parquet(f"{folder}/form_columns.parquet")


@pytest.mark.parametrize("tables", ["fixture", "data"])
def test_form_tables_read_every_cell_with_a_page(spark, data, tmp_path, tables):
    folder = data
    if tables == "fixture":
        folder = str(tmp_path)
        _form_fixture(spark, folder, data)
    cells = read_table(spark, folder, "cr_summary_data_temp")
    right = {tuple(r)[:2]: tuple(r)[2:4] for r in form_keys.heading_map(cells, read_table(spark, folder, "form_columns")).select("raw_section", "raw_column", "section_name", "column_name").collect()}
    key = lambda name: re.sub("[ _]+", "_", re.sub(r"\s+", " ", name).strip()).lower()
    files = {key(r["filename"]): r["filename"] for r in read_table(spark, folder, "cr_pdfs").collect()}
    want, pages = {}, set()
    rows = [r for r in cells.collect() if r["page_num"] is not None and r["pdf_name"] is not None and (r["section_name"], r["column_name"]) in right]
    for r in sorted(rows, key=lambda r: (r["row_num"] is not None, r["row_num"] or 0, r["row_id"])):
        section, column = right[r["section_name"], r["column_name"]]
        page = (files.get(key(r["pdf_name"]), r["pdf_name"]), r["page_num"], section)
        pages.add(page)
        for line in re.split(r"\r\n?|\n", r["text"] or ""):
            words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", line) if w]
            for i in range(0, len(words), 6):
                want.setdefault((*page, column), []).append(" ".join(words[i : i + 6]))
    want = {(*k, "\n".join(v)) for k, v in want.items()}
    for name in ("form_tables", "form_documents"):
        got = [tuple(r) for r in core.queries()[name](spark, folder).select("pdf_name", "page_num", "section_name", "column_name", "text").collect()]
        assert len(got) == len(want) and set(got) == want
    bands = core.queries()["section_bands"](spark, folder).collect()
    assert {(r["pdf_name"], r["page_num"], r["section"]) for r in bands} == pages and len(bands) == len(pages)
    assert all(r["top"] < r["band_top"] < r["band_bottom"] for r in bands)
