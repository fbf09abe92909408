import json
import os

from pyspark.sql import functions as F

from paperloom.sources import files, hocr, sinks
from paperloom.streaming.ingest import ingest_pages


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_token_files(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    put(f"{tmp_path}/a.pdf/a.pdf.3.tsv", head + '5\t1\t1\t1\t1\t2\t9\t0\t5\t5\t90\tq"uote\n5\t1\t1\t1\t1\t1\t0\t0\t5\t5\t96.5\tbad\n5\t1\t1\t1\t1\t1\t0\t0\t5\t5\t90\t\n')
    tokens, rejects = files.read_tokens(spark, f"{tmp_path}/a.pdf/*.tsv")
    assert [(r["pdf_name"], r["page"], r["seq"], r["text"]) for r in tokens.orderBy("seq").collect()] == [("a.pdf", 3, 1, ""), ("a.pdf", 3, 2, 'q"uote')]
    assert rejects.count() == 1


def test_texts_lists_hashes_and_resume(spark, tmp_path):
    put(f"{tmp_path}/t/a.pdf.1.txt", "one\ntwo")
    assert files.read_page_texts(spark, f"{tmp_path}/t").collect()[0]["text"] == "one\ntwo"
    put(f"{tmp_path}/batches.txt", " /x/y \n\n/z\n")
    assert {r[0] for r in files.read_batch_list(spark, f"{tmp_path}/batches.txt").collect()} == {"/x/y", "/z"}
    put(f"{tmp_path}/h/x.bin", "abc")
    assert files.hashed_files(spark, f"{tmp_path}/h", 7).collect()[0]["id"] == "a9993e3"
    put(f"{tmp_path}/p/b.pdf", "%PDF-1.4 /Type /Page /Type /Pages /Type/Page >>")
    put(f"{tmp_path}/p/c.pdf", "junk")
    assert {r["path"][-5:]: r["page_count"] for r in files.pdf_page_counts(spark, f"{tmp_path}/p").collect()} == {"b.pdf": 2, "c.pdf": None}
    assert files.listed_pdfs(spark, f"{tmp_path}/p").count() == 2
    listing = spark.createDataFrame([("a", 1, "tsv"), ("a", 1, "txt"), ("a", 1, "png"), ("b", 1, "tsv")], "filename string, page int, kind string")
    pdfs = spark.createDataFrame([("a", 1), ("b", 1), ("c", None)], "filename string, page_count int")
    assert dict(files.finished_pages(listing, pdfs).collect()) == {"b": 2}


def test_csv_and_json(spark, tmp_path):
    put(f"{tmp_path}/one.csv", "A1,A9,x.pdf\n")
    put(f"{tmp_path}/two.csv", "B1,LOG_5\n")
    got = files.read_batch_data(spark, [(f"{tmp_path}/one.csv", ["prod_begin", "prod_end", "filename"]), (f"{tmp_path}/two.csv", ["prod_begin", "log_number"])])
    assert {(r["prod_begin"], r["filename"], r["log_number"]) for r in got.collect()} == {("A1", "x.pdf", None), ("B1", None, "LOG_5")}
    put(f"{tmp_path}/forms.json", json.dumps([{"pdf_name": "a", "page_num": 1, "sections": [{"section_name": "S", "columns": [{"col_name": "C", "col_text": "t"}]}, {"section_name": "E", "columns": []}]}]))
    from paperloom.operators.forms import flattened_forms

    assert [tuple(r) for r in flattened_forms(files.read_form_documents(spark, f"{tmp_path}/forms.json"), ["pdf_name"]).collect()] == [("a", "S", "C", "t")]
    df = spark.createDataFrame([(1, "a|b")], "x int, y string")
    sinks.write_sheets({"s": df}, f"{tmp_path}/out")
    assert files.read_delimited(spark, f"{tmp_path}/out/s", "x int, y string").collect()[0]["y"] == "a|b"
    assert json.loads(sinks.as_one_array(df).first()["json"]) == [{"x": 1, "y": "a|b"}]
    assert sinks.upload_tables({"a": df, "b": df.where("false")}, lambda n, d: None) == ["a"]


def test_hocr_words(spark):
    page = (
        "<div class='ocr_page' id='page_3'><div class='ocr_carea' id='block_1_1'><p class='ocr_par' id='par_1_2'><span class='ocr_line' id='line_1_4'>"
        "<span class='ocrx_word' id='word_1_7' title='bbox 10 20 30 40; x_wconf 95; x_size 12.5'><strong>Hello</strong></span> "
        "<span class='ocrx_word' id='word_1_8' title='bbox 10 20 30000 40'>wide</span><br></span></p></div></div>"
    )
    df = spark.createDataFrame([("d", 1, page), ("d", 2, "<span class='ocrx_word' id='word_9' title='bbox 1 2 3 4'>open"), ("d", 3, None)], "docid string, docpg int, xml string")
    got = {(r["docpg"], r["word_id"]): r for r in hocr.hocr_words(df, ["docid", "docpg"]).collect()}
    a, b, c = got[1, 7], got[1, 8], got[2, 9]
    assert (a["text"], a["x0"], a["y1"], a["conf"], a["sz"], a["page_id"], a["block_id"], a["paragraph_id"], a["line_id"]) == ("Hello", 10, 40, 95.0, 12.5, 3, 1, 2, 4)
    assert b["x0"] is None and b["conf"] is None and (c["x1"], c["text"], c["line_id"]) == (3, "open", None)
    assert hocr.in_inches(hocr.hocr_words(df, ["docid", "docpg"])).where("word_id = 7").first()["x1"] == 0.1


def test_pages_are_ingested_once(spark, tmp_path):
    put(f"{tmp_path}/in/a.pdf.1.txt", "MEDIATION AGREEMENT\nof two parties")
    run = lambda: ingest_pages(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck")
    run()
    put(f"{tmp_path}/in/a.pdf.2.txt", "nothing known here\nat all")
    run()
    got = {r["page"]: r["page_classification"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: "Mediation Agreement", 2: None} and spark.read.parquet(f"{tmp_path}/out").where(F.col("page") == 1).count() == 1


def test_files_are_written_copied_and_listed(spark, tmp_path):
    rows = spark.createDataFrame([("a b+c.pdf/a b+c.pdf.1.txt", "one"), ("d%20e.pdf/d%20e.pdf.2.txt", "two"), (None, "x"), ("y", None)], "name string, content string")
    assert sinks.write_files(rows, f"{tmp_path}/f") == 2 and sinks.write_files(rows, f"file://{tmp_path}/f") == 2
    assert {(r["pdf_name"], r["page"], r["text"]) for r in files.read_page_texts(spark, f"{tmp_path}/f/*/*.txt").collect()} == {("a b+c.pdf", 1, "one"), ("d%20e.pdf", 2, "two")}
    assert {tuple(r) for r in files.page_files(spark, f"{tmp_path}/f").collect()} == {("a b+c.pdf", 1, "txt"), ("d%20e.pdf", 2, "txt")}
    assert not [n for _, _, names in os.walk(f"{tmp_path}/f") for n in names if n.startswith(".") and not n.endswith(".crc")]
    have = spark.createDataFrame([("p.pdf",)], "name string")
    new = spark.createDataFrame([("p.pdf", "other"), ("q.pdf", "new")], "name string, content string")
    assert sinks.copy_missing(new, have, f"{tmp_path}/c") == 1 and os.listdir(f"{tmp_path}/c") == ["q.pdf"]
    assert sinks.write_files(rows.where("false"), f"{tmp_path}/none") == 0


def test_workbook_has_a_sheet_per_table(spark, tmp_path):
    import zipfile
    from xml.etree import ElementTree

    sinks.write_workbook({"one & two": spark.createDataFrame([(1, "a<b", 2.5, None), (2, None, -1.0, True)], "x int, y string, z double, w boolean"), "none": spark.createDataFrame([], "q string")}, f"{tmp_path}/r.xlsx")
    with zipfile.ZipFile(f"{tmp_path}/r.xlsx") as book:
        space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
        assert [s.get("name") for s in ElementTree.fromstring(book.read("xl/workbook.xml")).findall(".//m:sheet", space)] == ["one & two", "none"]
        cells = [["".join(c.itertext()) for c in row] for row in ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml")).findall(".//m:row", space)]
        assert cells == [["x", "y", "z", "w"], ["1", "a<b", "2.5", ""], ["2", "", "-1.0", "True"]]
        assert {"[Content_Types].xml", "_rels/.rels", "xl/_rels/workbook.xml.rels", "xl/worksheets/sheet2.xml"} <= set(book.namelist())


def test_database_columns_are_read_once_each(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string").write.format("jdbc").options(url=url, dbtable="listed", driver=driver).mode("overwrite").save()
    assert {tuple(r) for r in files.read_database(spark, url, "listed", ["k"], driver=driver).collect()} == {(1,), (2,)}


def test_written_tables_are_released(spark, tmp_path):
    from paperloom.session import release, shared_folder, written

    df = written(spark.range(5))
    assert df.count() == 5
    home = f"{shared_folder(spark)}/paperloom-tables-{spark.sparkContext.applicationId}"
    assert os.path.isdir(home)
    release(spark)
    assert not os.path.isdir(home) and written(spark.range(2)).count() == 2


def _page_tables(spark, folder, pages):
    spark.range(1, pages + 1).selectExpr("id", "id AS pdf_id", "2 AS page_num", "'Face Sheet' AS page_classification").write.parquet(f"{folder}/cr_pdf_pages.parquet")
    spark.range(1, pages + 1).selectExpr("id", "concat(if(id = 1, '_', ''), 'LOG_', id, ' a+b%20.pdf') AS filename").write.parquet(f"{folder}/cr_pdfs.parquet")


def test_hocr_files_are_no_names_in_the_driver(spark, tmp_path):
    from paperloom.plans import queries as core

    _page_tables(spark, tmp_path, 300)
    got = core.queries()["hocr_files"](spark, str(tmp_path))
    assert got.inputFiles() == []
    assert {(r["pdf_name"], r["page"], r["word_id"]) for r in got.collect()} == {(f"{'_' * (i == 1)}LOG_{i} a+b%20.pdf", 2, w) for i in range(1, 301) for w in (1, 2)}


def test_page_texts_of_patterns_folders_and_files(spark, tmp_path):
    import gzip

    import pytest
    from paperloom.plans import queries as core

    _page_tables(spark, f"{tmp_path}/tables", 3)
    got = core.queries()["page_text_files"](spark, f"{tmp_path}/tables")
    assert got.inputFiles() == []
    assert {tuple(r) for r in got.collect()} == {(f"{'_' * (i == 1)}LOG_{i} a+b%20.pdf", 2, f"Face Sheet\n{'_' * (i == 1)}LOG_{i} a+b%20.pdf\n") for i in (1, 2, 3)}
    for i in range(600):
        put(f"{tmp_path}/in/one.pdf/one.pdf.{i}.txt", f"text {i}")
    put(f"{tmp_path}/in/two [x].pdf/two [x].pdf.1.txt", "")
    put(f"{tmp_path}/in/two [x].pdf/.hidden.txt", "x")
    put(f"{tmp_path}/in/two [x].pdf/_SUCCESS", "x")
    put(f"{tmp_path}/in/loose.txt", "x")
    with open(f"{tmp_path}/in/two [x].pdf/two [x].pdf.2.tsv", "wb") as f:
        f.write(b"\xe4\r\n")
    read = lambda path: {tuple(r) for r in files.read_page_texts(spark, path).collect()}
    ones = {("one.pdf", i, f"text {i}") for i in range(600)}
    assert read(f"{tmp_path}/in/*/*.txt") == ones | {("two [x].pdf", 1, "")} == read(f"file://{tmp_path}/in/*.pdf/*.{{txt,jpg}}")
    assert read(f"{tmp_path}/in/o*") == ones and read(f"{tmp_path}/in/two \\[x].pdf/*.[0-1].???") == {("two [x].pdf", 1, "")} == read(f"{tmp_path}/in/two \\[x\\].pdf/two \\[x\\].pdf.1.txt")
    assert files.read_page_texts(spark, f"{tmp_path}/in/two \\[x\\].pdf").count() == 2 and read(f"{tmp_path}/none/*/*.txt") == set()
    with gzip.open(f"{tmp_path}/z.txt.gz", "wt") as f:
        f.write("zipped")
    assert read(f"{tmp_path}/z.txt.gz") == {("", None, "zipped")}
    with pytest.raises(Exception, match="FileNotFoundError"):
        read(f"{tmp_path}/none")


def test_token_lines_as_the_csv_reader_has_them(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    row = lambda w, text: f"5\t1\t1\t1\t1\t{w}\t0\t0\t5\t5\t90{text}"
    put(f"{tmp_path}/a.pdf/a.pdf.1.tsv", " \n\t\n" + head + "\r\n" + row(1, "\t tail ") + "\r\n\r\n   \n" + row(2, "\ta\tmore") + "\r" + row(3, "") + "\n5\t1\n" + row("x", "\tbad") + "\n" + row(4, "\té"))
    put(f"{tmp_path}/_b.pdf/_b.pdf.2.tsv", head)
    put(f"{tmp_path}/c.pdf/c.pdf.3.tsv", "")
    put(f"{tmp_path}/d.pdf/d.pdf.4.tsv", "\n".join([head, *[row(1, f"\tword {i % 7}") for i in (5, 3, 6, 1, 0, 4, 2)]]))
    tokens, rejects = files.read_tokens(spark, f"{tmp_path}/*/*.tsv")
    assert tokens.inputFiles() == [] == rejects.inputFiles()
    got = tokens.orderBy("pdf_name", "seq").collect()
    assert [(r["page"], r["seq"], r["word_num"], r["text"]) for r in got[:4]] == [(1, 1, 1, " tail "), (1, 2, 2, "a"), (1, 3, 3, ""), (1, 4, 4, "é")]
    assert [(r["page"], r["seq"], r["text"]) for r in got[4:]] == [(4, i + 1, f"word {i}") for i in range(7)]
    assert sorted((r["level"], r["word_num"] or "", r["text"] or "") for r in rejects.collect()) == [("5", "", ""), ("5", "x", "bad")]


def test_token_queries_over_odd_names(spark, tmp_path):
    from paperloom.plans import queries as core

    _page_tables(spark, tmp_path, 21)
    got = core.queries()["token_files"](spark, str(tmp_path))
    assert got.inputFiles() == []
    want = {(f"{'_' * (i == 1)}LOG_{i} a+b%20.pdf", s) for i in range(1, 22) for s in (1, 2, 3)}
    rows = got.collect()
    assert {(r["pdf_name"], r["text"]) for r in rows if r["line_num"] == 2} == {(n, n) for n, _ in want} and len(rows) == 63


def test_tokens_without_heads_read_the_files_once(spark, tmp_path):
    from paperloom.plans import queries as core

    _page_tables(spark, tmp_path, 8)
    spark.range(1, 9).selectExpr("id", "id AS pdf_id", "2 AS page_num", "if(id % 2 = 0, 'Face Sheet', null) AS page_classification").write.mode("overwrite").parquet(f"{tmp_path}/cr_pdf_pages.parquet")
    got = core.queries()["tokens_without_heads"](spark, str(tmp_path))
    assert got.inputFiles() and all(f.endswith(".parquet") for f in got.inputFiles())
    name = lambda i: f"{'_' * (i == 1)}LOG_{i} a+b%20.pdf"
    want = {(name(i), 3 if i % 2 == 0 else 6, name(i)) for i in range(1, 9)} | {(name(i), s, w) for i in (2, 4, 6, 8) for s, w in ((1, "Face"), (2, "Sheet"))}
    assert {(r["pdf_name"], r["seq"] - 1, r["text"]) for r in got.collect()} == want


def test_token_rejects_of_all_files(spark, tmp_path):
    from paperloom.plans import queries as core

    _page_tables(spark, tmp_path, 70)
    got = core.queries()["token_rejects"](spark, str(tmp_path))
    assert got.inputFiles() == []
    assert sorted(tuple(r) for r in got.collect()) == sorted((f"LOG_{i} a+b%20.pdf", 2, "much", "unsure") for i in range(7, 71, 7))


def test_token_lines_are_split_once(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    put(f"{tmp_path}/a.pdf/a.pdf.3.tsv", head + "5\t1\t1\t1\t1\t1\t9\t0\t5\t5\t90\tgood\n5\t1\t1\t1\t1\t2\t0\t0\t5\t5\tmuch\tbad\n5\t1\n")
    tokens, rejects = files.read_tokens(spark, f"{tmp_path}/a.pdf/*.tsv")
    assert [df._jdf.queryExecution().optimizedPlan().toString().count(", \t, -1)") for df in (tokens, rejects)] == [1, 1]
    assert [(r["conf"], r["text"]) for r in tokens.collect()] == [(90, "good")]
    assert sorted((r["level"], r["conf"] or "", r["text"] or "") for r in rejects.collect()) == [("5", "", ""), ("5", "much", "bad")]
