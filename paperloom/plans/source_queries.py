"""Queries that write files of the kinds the sources read, from whole tables, and read them back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import pixels
from paperloom.operators import lines, reports
from paperloom.session import scratch_folder, written
from paperloom.sources import files, hocr, sinks
from paperloom.tables import read_table

_TABBED = "level page_num block_num par_num line_num word_num left top width height conf text".split()


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filename, page, label and words of every page of a file: three lines of up to some words each."""
    pages = read_table(spark, sf_dir, "cr_pdf_pages").join(read_table(spark, sf_dir, "cr_pdfs").select(F.col("id").alias("pdf_id"), "filename"), "pdf_id")
    return pages.select("id", "filename", F.col("page_num").alias("page"), F.coalesce("page_classification", F.lit("AUTO CR - LOG SUMMARY")).alias("label"))


_PAGES_SQL = "SELECT g.id, p.filename, g.page_num AS page, coalesce(g.page_classification, 'AUTO CR - LOG SUMMARY') AS label FROM cr_pdf_pages g JOIN cr_pdfs p ON p.id = g.pdf_id"


def _file(kind: str):
    return F.concat("filename", F.lit("/"), "filename", F.lit("."), F.col("page").cast("string"), F.lit(f".{kind}")).alias("name")


def _token_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, content of token files: the page itself, its label as words of line 1, its file name as line 2,
    and on every seventh page a word whose confidence is no number."""
    words = F.concat(F.split("label", " "), F.array("filename"))
    size = F.size(F.split("label", " "))
    row = lambda w, i: F.concat_ws("\t", F.lit("5"), F.lit("1"), F.lit("1"), F.lit("1"), F.when(i < size, "1").otherwise("2"), (i + 1).cast("string"), (i * 60).cast("string"), F.when(i < size, "40").otherwise("80"), F.lit("50"), F.lit("20"), ((F.col("id") + i) % 100).cast("string"), w)
    bad = F.when(F.col("id") % 7 == 0, F.lit("5\t1\t1\t1\t3\t1\t0\t120\t50\t20\tmuch\tunsure"))
    content = F.concat_ws("\n", F.lit("\t".join(_TABBED)), F.lit("1\t1\t0\t0\t0\t0\t0\t0\t2550\t3300\t-1\t"), F.array_join(F.transform(words, row), "\n"), bad)
    return _pages(spark, sf_dir).select(_file("tsv"), content.alias("content"))


def _tokens(spark: SparkSession, sf_dir: str):
    folder = scratch_folder(spark)
    sinks.write_files(_token_pages(spark, sf_dir), folder)
    return files.read_tokens(spark, f"{folder}/*/*.tsv")


_TOKENS_SQL = f"""
  WITH w AS (SELECT *, string_split(label, ' ') || [filename] ws, len(string_split(label, ' ')) size FROM ({_PAGES_SQL})),
  t AS (SELECT filename AS pdf_name, page, i + 1 AS seq, 5 AS level, CASE WHEN i <= size THEN 1 ELSE 2 END AS line_num, i AS word_num, (i - 1) * 60 AS "left", CASE WHEN i <= size THEN 40 ELSE 80 END AS top, (id + i - 1) % 100 AS conf, ws[i] AS text
    FROM (SELECT *, unnest(range(1, len(ws) + 1)) i FROM w))
"""


def _token_files(spark, sf_dir):
    return _tokens(spark, sf_dir)[0].where("level = 5").select("pdf_name", "page", "seq", "line_num", "word_num", "left", "top", "conf", "text")


def _token_rejects(spark, sf_dir):
    return _tokens(spark, sf_dir)[1].select("pdf_name", "page", "conf", "text")


_PAGE = ["pdf_name", "page"]


def _lines_of_tokens(spark, sf_dir):
    return lines.token_lines(_tokens(spark, sf_dir)[0], _PAGE).select(*_PAGE, "line_num", "text", "left", "top", "right", "bottom")


def _kept_tokens(spark, sf_dir):
    tokens = written(_tokens(spark, sf_dir)[0])  # once for the page heads, once for the words
    return lines.without_page_heads(tokens, _PAGE).where("level = 5").select(*_PAGE, "seq", "text")


def _page_texts(spark, sf_dir):
    folder = scratch_folder(spark)
    pages = _pages(spark, sf_dir)
    sinks.write_files(pages.select(_file("txt"), F.concat("label", F.lit("\n"), "filename", F.lit("\n")).alias("content")), folder)
    return files.read_page_texts(spark, f"{folder}/*/*.txt")


def _finished(spark, sf_dir):
    """Token files of all pages, texts of all but every fifth, images of all but every ninth."""
    folder = scratch_folder(spark)
    pages = _pages(spark, sf_dir)
    for kind, left_out in (("tsv", "false"), ("txt", "id % 5 = 0"), ("png", "id % 9 = 0")):
        sinks.write_files(pages.where(f"not ({left_out})").select(_file(kind), F.lit("x").alias("content")), folder)
    return files.finished_pages(files.page_files(spark, folder), read_table(spark, sf_dir, "cr_pdfs"))


_FINISHED_SQL = f"""
  WITH g AS ({_PAGES_SQL}), have AS (SELECT filename, page, 'tsv' kind FROM g UNION SELECT filename, page, 'txt' FROM g WHERE id % 5 <> 0 UNION SELECT filename, page, 'png' FROM g WHERE id % 9 <> 0),
  want AS (SELECT filename, page, unnest(['tsv', 'txt', 'png']) kind FROM (SELECT filename, unnest(range(1, CAST(page_count AS BIGINT) + 1)) AS page FROM cr_pdfs WHERE page_count >= 1))
  SELECT filename, count(*) AS missing FROM want ANTI JOIN have USING (filename, page, kind) GROUP BY filename"""


def _hocr(spark, sf_dir):
    """Words of hOCR files: one a word of the label, every fourth without confidence, every sixth too wide for its box."""
    folder = scratch_folder(spark)
    x1 = lambda i: F.when((F.col("id") + i) % 6 == 0, F.lit("12345")).otherwise((i * 60 + 50).cast("string"))
    word = lambda w, i: F.concat(
        F.lit("<span class='ocrx_word' id='word_1_"), (i + 1).cast("string"), F.lit("' title='bbox "), (i * 60).cast("string"), F.lit(" 40 "), x1(i), F.lit(" 60"),
        F.when((F.col("id") + i) % 4 == 0, "").otherwise(F.concat(F.lit("; x_wconf "), ((F.col("id") + i) % 100).cast("string"))), F.lit("; x_size 12.5'><em>"), w, F.lit("</em></span>"),
    )
    xml = F.concat(
        F.lit("<html><body><div class='ocr_page' id='page_"), F.col("page").cast("string"), F.lit("'><div class='ocr_carea' id='block_1_1'><p class='ocr_par' id='par_1_2'><span class='ocr_line' id='line_1_3'>"),
        F.array_join(F.transform(F.split("label", " "), word), " "), F.lit("<br></span></p></div></div></body></html>"),
    )
    sinks.write_files(_pages(spark, sf_dir).select(_file("hocr"), xml.alias("content")), folder)
    pages = files.read_page_texts(spark, f"{folder}/*/*.hocr").withColumnRenamed("text", "xml")
    return hocr.hocr_words(pages, _PAGE)


_HOCR_SQL = f"""
  SELECT filename AS pdf_name, page, page AS page_id, 1 AS block_id, 2 AS paragraph_id, 3 AS line_id, i AS word_id, ws[i] AS text,
    CASE WHEN fits THEN (i - 1) * 60 END AS x0, CASE WHEN fits THEN 40 END AS y0, CASE WHEN fits THEN (i - 1) * 60 + 50 END AS x1, CASE WHEN fits THEN 60 END AS y1,
    CASE WHEN (id + i - 1) % 4 <> 0 THEN CAST((id + i - 1) % 100 AS DOUBLE) END AS conf, 12.5::DOUBLE AS sz
  FROM (SELECT *, (id + i - 1) % 6 <> 0 AS fits FROM (SELECT *, string_split(label, ' ') ws, unnest(range(1, len(string_split(label, ' ')) + 1)) i FROM ({_PAGES_SQL})))"""


def _batch_list(spark, sf_dir):
    folder = scratch_folder(spark)
    rows = read_table(spark, sf_dir, "cr_batch").select(F.lit("batches.txt").alias("name"), F.concat(F.lit("  "), "dropbox_path", F.lit(" ")).alias("line"), "id")
    text = rows.groupBy("name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), "\n\n").alias("content"))
    sinks.write_files(text, folder)
    return files.read_batch_list(spark, f"{folder}/batches.txt")


def _pdf_files(spark, sf_dir) -> str:
    """Plain PDF files with page_count page objects each; without a count, bytes that are no PDF."""
    folder = scratch_folder(spark)
    body = F.when(F.col("page_count") >= 1, F.concat(F.lit("%PDF-1.4 /Type /Pages "), F.repeat(F.lit("<< /Type /Page >> "), F.col("page_count")))).otherwise(F.concat(F.lit("none "), F.col("id").cast("string")))
    sinks.write_files(read_table(spark, sf_dir, "cr_pdfs").select(F.col("filename").alias("name"), body.alias("content")), folder)
    return folder


def _listed(spark, sf_dir):
    return files.listed_pdfs(spark, _pdf_files(spark, sf_dir)).select("name", "length")


def _counted(spark, sf_dir):
    counts = files.pdf_page_counts(spark, _pdf_files(spark, sf_dir))
    return counts.select(files.file_name(F.replace("path", F.lit("%"), F.lit("%25"))).alias("name"), "page_count")


def _hashed(spark, sf_dir):
    rows = files.hashed_files(spark, _pdf_files(spark, sf_dir))
    return rows.select(files.file_name(F.replace("path", F.lit("%"), F.lit("%25"))).alias("name"), "sha1", "id")


_BODY = "CASE WHEN page_count >= 1 THEN '%PDF-1.4 /Type /Pages ' || repeat('<< /Type /Page >> ', CAST(page_count AS BIGINT)) ELSE 'none ' || id END"


def _copied(spark, sf_dir):
    """Every third file is there already; the others are fetched, and all are listed."""
    folder = scratch_folder(spark)
    pdfs = read_table(spark, sf_dir, "cr_pdfs").select(F.col("filename").alias("name"), F.lit("new").alias("content"), "id")
    sinks.write_files(pdfs.where("id % 3 = 0").select("name", F.lit("had before").alias("content")), folder)
    sinks.copy_missing(pdfs.drop("id"), files.listed_pdfs(spark, folder), folder)
    return files.listed_pdfs(spark, folder).select("name", "length")


def _report_csv(spark, sf_dir):
    folder = scratch_folder(spark)
    sinks.write_report(reports.pages_per_batch(read_table(spark, sf_dir, "cr_batch"), read_table(spark, sf_dir, "cr_pdfs")), folder)
    return files.read_delimited(spark, folder, "dropbox_path string, median double, `min` bigint, `max` bigint, `avg` double, `sum` bigint")


def _batch_data(spark, sf_dir):
    """Three headless files with column lists of their own."""
    folder = scratch_folder(spark)
    pdfs = read_table(spark, sf_dir, "cr_pdfs").select(F.col("id").cast("string").alias("id"), "filename", F.col("cr_id").cast("string").alias("cr_id"), (F.col("id") % 3).alias("k"))
    lists = [["prod_begin", "filename"], ["prod_begin", "log_number"], ["prod_begin", "prod_end", "filename", "log_number"]]
    cells = [["id", "filename"], ["id", "cr_id"], ["id", "id", "filename", "cr_id"]]
    for k in range(3):
        pdfs.where(F.col("k") == k).select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cells[k])]).write.mode("overwrite").csv(f"{folder}/{k}")
    return files.read_batch_data(spark, [(f"{folder}/{k}", lists[k]) for k in range(3)]).select("prod_begin", "prod_end", "filename", "log_number")


def _feather(spark, sf_dir):
    """The batches as Feather files, one each."""
    folder = scratch_folder(spark)

    def packed(batches):
        import pyarrow as pa
        from pyarrow import feather

        for batch in batches:
            out = []
            for i in range(len(batch)):
                sink = pa.BufferOutputStream()
                feather.write_feather(pa.table({"id": pa.array([int(batch["id"].iloc[i])], pa.int64()), "dropbox_path": pa.array([batch["dropbox_path"].iloc[i]], pa.string())}), sink)
                out.append((f"{batch['id'].iloc[i]}.feather", sink.getvalue().to_pybytes()))
            yield pd.DataFrame(out, columns=["name", "content"])

    sinks.write_files(read_table(spark, sf_dir, "cr_batch").select("id", "dropbox_path").mapInPandas(packed, "name string, content binary"), folder)
    return files.read_feather(spark, folder, "id bigint, dropbox_path string")


def _redactions(spark, sf_dir):
    """Gray rasters of every page, 120 by 90, with a dark box set off by the page's id and a speck."""

    def drawn(batches):
        import numpy as np

        for batch in batches:
            out = []
            for i in batch["id"].tolist():
                gray = np.full((90, 120), 255, np.uint8)
                x, y = i % 60, i % 40
                gray[y : y + 20 + i % 10, x : x + 30] = 10
                gray[88, 118] = 0
                out.append((i, gray.tobytes(), 120, 90))
            yield pd.DataFrame(out, columns=["page_num", "content", "width", "height"])

    pages = read_table(spark, sf_dir, "cr_pdf_pages").select("id").mapInPandas(drawn, "page_num int, content binary, width int, height int")
    return pixels.redaction_blocks(pages)


def queries() -> dict:
    return {
        "token_files": _token_files, "token_rejects": _token_rejects, "token_lines": _lines_of_tokens, "tokens_without_heads": _kept_tokens, "page_text_files": _page_texts,
        "finished_pages": _finished, "hocr_files": _hocr, "batch_list_file": _batch_list, "listed_pdfs": _listed, "pdf_page_counts": _counted, "hashed_files": _hashed,
        "copied_files": _copied, "report_csv": _report_csv, "batch_data_files": _batch_data, "feather_files": _feather, "redaction_blocks": _redactions,
    }


def oracle_sql(pages_per_batch: str) -> dict[str, str]:
    return {
        "token_files": _TOKENS_SQL + 'SELECT pdf_name, page, seq, line_num, word_num, "left", top, conf, text FROM t',
        "token_rejects": f"SELECT filename AS pdf_name, page, 'much' AS conf, 'unsure' AS text FROM ({_PAGES_SQL}) WHERE id % 7 = 0",
        "token_lines": _TOKENS_SQL + """SELECT pdf_name, page, line_num, string_agg(text, ' ' ORDER BY word_num) AS text, min("left") AS "left", min(top) AS top, max("left") + 50 AS "right", max(top) + 20 AS bottom FROM t GROUP BY pdf_name, page, line_num""",
        "tokens_without_heads": _TOKENS_SQL + "SELECT pdf_name, page, seq, text FROM t WHERE (pdf_name, page, line_num) NOT IN (SELECT filename, page, 1 FROM (" + _PAGES_SQL + ") WHERE label LIKE 'AUTO CR - LOG SUMMARY%')",
        "page_text_files": f"SELECT filename AS pdf_name, page, label || chr(10) || filename || chr(10) AS text FROM ({_PAGES_SQL})",
        "finished_pages": _FINISHED_SQL,
        "hocr_files": _HOCR_SQL,
        "batch_list_file": "SELECT trim(dropbox_path) AS dropbox_path FROM cr_batch WHERE trim(dropbox_path) <> ''",
        "listed_pdfs": f"SELECT filename AS name, length({_BODY}) AS length FROM cr_pdfs",
        "pdf_page_counts": "SELECT filename AS name, CASE WHEN page_count >= 1 THEN page_count END AS page_count FROM cr_pdfs",
        "hashed_files": f"SELECT filename AS name, sha1({_BODY}) AS sha1, left(sha1({_BODY}), 8) AS id FROM cr_pdfs",
        "copied_files": "SELECT filename AS name, CASE WHEN id % 3 = 0 THEN 10 ELSE 3 END AS length FROM cr_pdfs",
        "report_csv": pages_per_batch,
        "batch_data_files": """SELECT CAST(id AS VARCHAR) AS prod_begin, CASE WHEN id % 3 = 2 THEN CAST(id AS VARCHAR) END AS prod_end, CASE WHEN id % 3 <> 1 THEN filename END AS filename,
          CASE WHEN id % 3 <> 0 THEN CAST(cr_id AS VARCHAR) END AS log_number FROM cr_pdfs""",
        "feather_files": "SELECT id, dropbox_path FROM cr_batch",
        "redaction_blocks": "SELECT id AS page_num, (id % 60) || ',' || (id % 40) || ',30,' || (20 + id % 10) AS coords FROM cr_pdf_pages",
    }
