"""Inputs of the registered queries, derived from the test tables by plain arithmetic.

The word boxes and page texts that the operators take are not among the test tables; these
frames give every row of a table a place on a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.operators.form_keys import file_key, heading_map
from paperloom.operators.rules import HEAD_RULES, LEFT_RULES, SECTIONS, TAIL_RULES
from paperloom.plans.cells_sql import HEADINGS, SAME_FILE
from paperloom.session import written
from paperloom.tables import read_table


def document_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents: docid, docpg, line_id, text, x0, x1, y0, y1 (inches)."""
    docs = read_table(spark, sf_dir, "documents").where("text is not null")
    rows = docs.select("doc_id", F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("pos", "text"))
    line = F.col("pos").cast("bigint") + 1
    rows = rows.select("doc_id", line.alias("line_id"), "text", F.pmod(F.col("doc_id") * 3 + line * 7, F.lit(40)).alias("m"))
    x0, y0 = F.col("m") / 10.0, (F.col("line_id") % 33) * 0.35
    return rows.select(
        F.col("doc_id").cast("string").alias("docid"), (F.lit(1) + F.floor((F.col("line_id") - 1) / 33)).cast("bigint").alias("docpg"), "line_id", "text",
        x0.alias("x0"), (x0 + F.col("m") * 0.25).alias("x1"), y0.alias("y0"), (y0 + 0.2 + (F.col("m") % 4) * 0.1).alias("y1"),
    )


LINES_SQL = """
  SELECT CAST(doc_id AS VARCHAR) docid, 1 + (line_id - 1) // 33 docpg, line_id, text, m / 10.0::DOUBLE x0, m / 10.0::DOUBLE + m * 0.25::DOUBLE x1,
    (line_id % 33) * 0.35::DOUBLE y0, (line_id % 33) * 0.35::DOUBLE + 0.2::DOUBLE + (m % 4) * 0.1::DOUBLE y1
  FROM (SELECT doc_id, line_id, text, (doc_id * 3 + line_id * 7) % 40 m FROM (
    SELECT doc_id, unnest(lines) AS text, generate_subscripts(lines, 1) AS line_id
    FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) lines FROM documents WHERE text IS NOT NULL)))
"""


def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell rows as lines with their section name in capitals, a third of them in the left margin."""
    cells = read_table(spark, sf_dir, "cr_summary_data_temp").where("section_name is not null and page_num is not null")
    y0 = F.col("row_num") * 0.5 + (F.col("row_id") % 5) * 0.01
    return cells.select(
        F.col("pdf_name").alias("docid"), F.col("page_num").alias("docpg"), F.col("row_id").alias("line_id"), F.upper("section_name").alias("text"),
        F.lit(0.1).alias("x0"), F.when(F.col("row_id") % 3 == 0, 0.4).otherwise(3.0).alias("x1"), y0.alias("y0"), (y0 + 0.1 + (F.col("row_id") % 7) * 0.02).alias("y1"),
    )


HEADING_SQL = """
  SELECT pdf_name docid, page_num docpg, row_id line_id, upper(section_name) AS text, 0.1::DOUBLE x0,
    CASE WHEN row_id % 3 = 0 THEN 0.4::DOUBLE ELSE 3.0::DOUBLE END x1,
    row_num * 0.5::DOUBLE + (row_id % 5) * 0.01::DOUBLE y0,
    row_num * 0.5::DOUBLE + (row_id % 5) * 0.01::DOUBLE + 0.1::DOUBLE + (row_id % 7) * 0.02::DOUBLE y1
  FROM cr_summary_data_temp WHERE section_name IS NOT NULL AND page_num IS NOT NULL
"""


def cell_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell rows as page texts: section, column and text on lines of their own."""
    cells = read_table(spark, sf_dir, "cr_summary_data_temp")
    return cells.select("row_id", F.concat_ws("\n", "section_name", "column_name", "text").alias("text"))


PAGES_SQL = "SELECT row_id, concat_ws(chr(10), section_name, column_name, text) AS text FROM cr_summary_data_temp"


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents as boxes in pixels: docid, docpg, line_id, word_id, text, x0, y0, x1,
    y1, conf, sz, section, section_conf. Eight words a line, twelve lines a page."""
    docs = read_table(spark, sf_dir, "documents").where("text is not null")
    words = F.split(F.trim(F.regexp_replace("text", "[ \t\r\n]+", " ")), " ")
    rows = docs.select("doc_id", F.posexplode(words).alias("pos", "text")).where("text <> ''")
    p, n = F.col("pos").cast("bigint"), F.length("text").cast("bigint")
    line = F.floor(p / 8)
    x0, y0 = (p % 8) * 90 + (F.col("doc_id") + p * 5) % 37, (line % 12) * 30 + (p * 7) % 11
    part = F.floor(line / 3) % 3
    return rows.select(
        F.col("doc_id").cast("string").alias("docid"), (1 + F.floor(p / 96)).alias("docpg"), line.alias("line_id"), p.alias("word_id"), "text",
        x0.alias("x0"), y0.alias("y0"), (x0 + 20 + (n * 4) % 60).alias("x1"), (y0 + 14 + p % 3).alias("y1"),
        (30 + (p * 13) % 70).alias("conf"), (14 + p % 9).alias("sz"),
        F.when(part == 0, "narrative").when(part == 1, "incident").otherwise("other").alias("section"), ((p * 17) % 100 / 100.0).alias("section_conf"),
    )


WORDS_SQL = """
  SELECT CAST(doc_id AS VARCHAR) docid, 1 + p // 96 docpg, p // 8 line_id, p word_id, text,
    (p % 8) * 90 + (doc_id + p * 5) % 37 x0, ((p // 8) % 12) * 30 + (p * 7) % 11 y0,
    (p % 8) * 90 + (doc_id + p * 5) % 37 + 20 + (n * 4) % 60 x1, ((p // 8) % 12) * 30 + (p * 7) % 11 + 14 + p % 3 y1,
    30 + (p * 13) % 70 conf, 14 + p % 9 sz,
    CASE ((p // 8) // 3) % 3 WHEN 0 THEN 'narrative' WHEN 1 THEN 'incident' ELSE 'other' END section, ((p * 17) % 100) / 100.0::DOUBLE section_conf
  FROM (SELECT doc_id, w AS text, k - 1 p, length(w) n FROM (
    SELECT doc_id, unnest(ws) w, generate_subscripts(ws, 1) k
    FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '[ ' || chr(9) || chr(13) || chr(10) || ']+', ' ', 'g')), ' ') ws FROM documents WHERE text IS NOT NULL))
    WHERE w <> '')
"""


#: Words on a printed line of a form column; pixels from one line to the next.
LINE_WORDS, LINE_STEP = 6, 24

_PRINTED_SQL = f"""
  WITH {HEADINGS},
  f AS (SELECT t.row_id, coalesce(p.filename, t.pdf_name) pdf_name, t.page_num, c3.section_name, c3.column_name, t.row_num,
      string_split(replace(replace(coalesce(t.text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) ls
    FROM cr_summary_data_temp t JOIN c3 ON t.section_name = c3.rs AND t.column_name = c3.rc LEFT JOIN cr_pdfs p ON {SAME_FILE} WHERE t.page_num IS NOT NULL AND t.pdf_name IS NOT NULL),
  l AS (SELECT *, list_filter(regexp_split_to_array(x, '[ \\t\\x0b\\f]+'), lambda w: w <> '') ws FROM (SELECT * EXCLUDE ls, unnest(ls) x, generate_subscripts(ls, 1) i FROM f)),
  h AS (SELECT *, CAST(ceil(len(ws) / {LINE_WORDS}.0) AS INTEGER) n FROM l)"""
#: What a form parser must read again: the lines of every cell with a page, entries and loads below one another.
FORM_SQL = f"""{_PRINTED_SQL}
  SELECT pdf_name, page_num, section_name, column_name, string_agg(array_to_string(ws[k * {LINE_WORDS} + 1:k * {LINE_WORDS} + {LINE_WORDS}], ' '), chr(10) ORDER BY row_num NULLS FIRST, row_id, i, k) AS text
  FROM (SELECT *, unnest(range(n)) k FROM h) GROUP BY ALL"""
BANDS_SQL = f"""{_PRINTED_SQL},
  e AS (SELECT pdf_name, page_num, section_name, row_num, max(n) n FROM (SELECT pdf_name, page_num, section_name, column_name, row_num, sum(n) n FROM h GROUP BY ALL) GROUP BY ALL),
  s AS (SELECT pdf_name, page_num, section_name, CAST(200 + {LINE_STEP} * sum(n) AS INTEGER) height FROM e GROUP BY ALL),
  t AS (SELECT *, CAST(300 + sum(height) OVER (PARTITION BY pdf_name, page_num ORDER BY section_name) - height AS INTEGER) AS top FROM s)
  SELECT pdf_name, page_num, section_name AS section, top, top + 20 AS band_top,
    coalesce(lead(top) OVER (PARTITION BY pdf_name, page_num ORDER BY top), CAST(300 + sum(height) OVER (PARTITION BY pdf_name, page_num) AS INTEGER)) AS band_bottom, 6000 AS page_width FROM t"""


def form_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with a page and a heading of the form, with its place in its section: pdf_name,
    page_num, section_name, ordinal_no, lines (arrays of at most LINE_WORDS words), line (that of
    its first), section_lines. Entries (row_num) of a section stand below one another, and so do
    the loads of a cell, by row_id. Files and headings are put right; an unknown file keeps its name."""
    printed = [(section, i, header) for section, headers in SECTIONS for i, header in enumerate(headers, 1) if header]
    form = spark.createDataFrame(printed, "section_name string, ordinal_no int, column_name string")
    cells = read_table(spark, sf_dir, "cr_summary_data_temp").where("page_num is not null and pdf_name is not null")
    headings = heading_map(cells, read_table(spark, sf_dir, "form_columns")).join(form, ["section_name", "column_name"]).drop("attribute", "value_type")
    files = read_table(spark, sf_dir, "cr_pdfs").groupBy(file_key(F.col("filename")).alias("fkey")).agg(F.min("filename").alias("right_name"))
    words = lambda line: F.filter(F.split(line, r"\s+"), lambda w: w != "")
    wrapped = lambda ws: F.when(
        F.size(ws) > 0, F.transform(F.sequence(F.lit(1), F.size(ws), F.lit(LINE_WORDS)), lambda i: F.slice(ws, i, LINE_WORDS))
    ).otherwise(F.expr("cast(array() as array<array<string>>)"))
    rows = cells.select(
        "row_id", "page_num", "row_num", F.col("pdf_name").alias("raw_name"), file_key(F.col("pdf_name")).alias("fkey"), F.col("section_name").alias("raw_section"),
        F.col("column_name").alias("raw_column"), F.flatten(F.transform(F.split(F.coalesce("text", F.lit("")), r"\r\n?|\n"), lambda line: wrapped(words(line)))).alias("lines"),
    )
    rows = rows.join(headings, ["raw_section", "raw_column"]).join(files, "fkey", "left").withColumn("pdf_name", F.coalesce("right_name", "raw_name"))
    section = ["pdf_name", "page_num", "section_name"]
    entry = Window.partitionBy(*section, "row_num")
    cell = Window.partitionBy(*section, "row_num", "ordinal_no")
    rows = rows.withColumns({
        "above": F.coalesce(F.sum(F.size("lines")).over(cell.orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "height": F.sum(F.size("lines")).over(cell),
    })
    rows = rows.withColumns({"height": F.max("height").over(entry), "first": F.row_number().over(entry.orderBy("ordinal_no", "row_id")) == 1})
    own = F.when(F.col("first"), F.col("height")).otherwise(0)
    rows = rows.withColumns({"through": F.sum(own).over(Window.partitionBy(*section).orderBy("row_num").rangeBetween(Window.unboundedPreceding, 0)), "section_lines": F.sum(own).over(Window.partitionBy(*section))})
    return rows.select(*section, "ordinal_no", "lines", (F.col("through") - F.col("height") + F.col("above")).alias("line"), "section_lines")


def form_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """form_cells printed as form pages: pdf_name, page_num, seq, block_num, par_num, line_num, text
    and a box in pixels. Every header of a section is printed."""
    printed = [(section, i, header) for section, headers in SECTIONS for i, header in enumerate(headers, 1) if header]
    form = spark.createDataFrame(printed, "section_name string, ordinal_no int, column_name string")
    cells = written(form_cells(spark, sf_dir))
    page = ["pdf_name", "page_num"]
    by = Window.partitionBy(*page).orderBy("section_name")
    height = 200 + F.col("section_lines") * LINE_STEP
    sections = cells.select(*page, "section_name", "section_lines").distinct().withColumns({"k": F.row_number().over(by).cast("int"), "top": 300 + F.sum(height).over(by) - height})
    sections = sections.withColumn("page_height", F.sum(height).over(Window.partitionBy(*page)) + 300)
    k, w, top = F.col("k"), F.col("w"), F.col("top")

    def box(kind: int, par, line, at) -> list:
        seq = ((k * 3 + kind).cast("bigint") * 100 + par) * 1_000_000_000 + line * 100 + w
        return [
            *page, seq.alias("seq"), (k * 3 + kind).cast("int").alias("block_num"), par.cast("int").alias("par_num"), (line + 1).cast("int").alias("line_num"), F.col("t").alias("text"),
            (50 + F.when(F.lit(kind > 0), par * 400).otherwise(0) + w * 60).cast("int").alias("left"), at.cast("int").alias("top"), F.lit(50).alias("width"), F.lit(20).alias("height"),
        ]

    labels = sections.select(*page, "k", "top", F.posexplode(F.split("section_name", " ")).alias("w", "t")).select(*box(0, F.lit(1), F.lit(0), top))
    headers = sections.join(form, "section_name").select(*page, "k", "top", "ordinal_no", F.posexplode(F.split("column_name", " ")).alias("w", "t"))
    headers = headers.select(*box(1, F.col("ordinal_no"), F.lit(0), top + 60))
    body = cells.join(sections.drop("section_lines"), [*page, "section_name"]).select(*page, "k", "top", "ordinal_no", "line", F.posexplode("lines").alias("i", "words"))
    body = body.select(*page, "k", "top", "ordinal_no", (F.col("line") + F.col("i")).alias("line"), F.posexplode("words").alias("w", "t"))
    body = body.select(*box(2, F.col("ordinal_no"), F.col("line"), top + 120 + F.col("line") * LINE_STEP))
    sheet = sections.select(*page, "page_height").distinct().select(
        *page, F.lit(0).cast("bigint").alias("seq"), *[F.lit(0).alias(c) for c in ("block_num", "par_num", "line_num")], F.lit("").alias("text"),
        F.lit(0).alias("left"), F.lit(0).alias("top"), F.lit(6000).alias("width"), F.col("page_height").cast("int").alias("height"),
    )
    return sheet.unionByName(labels).unionByName(headers).unionByName(body)


def report_words(spark: SparkSession, sf_dir: str, page=None) -> DataFrame:
    """Labelled words of one report per file of summary_logs, in pixels: its date and a code for each
    incident place, the listed persons as a table, and the narratives of the file."""
    logs = read_table(spark, sf_dir, "summary_logs").where("pdf_name is not null").withColumn("docpg", F.lit(1).cast("bigint") if page is None else page)
    own = ["pdf_name", "docpg"]

    def placed(rows: DataFrame, section: str, line, cells: list[tuple[int, object]]) -> DataFrame:
        each = rows.select(*own, line.alias("l"), F.inline(F.array(*[F.struct(F.lit(c).alias("c"), t.alias("t")) for c, t in cells])))
        l, c = F.col("l"), F.col("c")
        box = [(l * 50 + c, "word_id"), (c * 150, "x0"), (l * 20, "y0"), (c * 150 + 60, "x1"), (l * 20 + 12, "y1")]
        return each.select(F.col("pdf_name").alias("docid"), "docpg", l.cast("bigint").alias("line_id"), F.col("t").alias("text"), *[v.cast("bigint").alias(n) for v, n in box], F.lit(section).alias("section"), F.lit(0.8).alias("section_conf"))

    day = F.date_format(F.min("loaded_at"), "dd-MM-yyyy")
    dates = placed(logs.groupBy(*own).agg(day.alias("day")), "incident", F.lit(0), [(1, F.lit("Occurrence")), (2, F.lit("Date")), (3, F.coalesce("day", F.lit("unknown"))), (4, F.lit("#12"))])
    numbered = lambda which: logs.where(which).withColumn("i", F.row_number().over(Window.partitionBy(*own).orderBy("sl_id")))
    code = F.lpad((F.col("sl_id") % 10000).cast("string"), 4, "0")
    codes = placed(numbered("address_of_incident is not null"), "incident", F.col("i"), [(1, F.lit("IUCR")), (2, code), (3, F.lit("-")), (4, F.coalesce("beat", F.lit("NONE")))])
    heads = placed(logs.select(*own).distinct(), "personnel", F.lit(10), [(2, F.lit("StarNo")), (3, F.lit("Name")), (4, F.lit("Beat"))])
    body = placed(numbered("party_name is not null"), "personnel", F.col("i") + 10, [(c, F.coalesce(F.col(n), F.lit("-"))) for c, n in ((0, "party_role"), (2, "star_no"), (3, "party_name"), (4, "beat"))])
    told = read_table(spark, sf_dir, "report_extract").where("narrative is not null").select(F.col("orig_filename").alias("pdf_name"), "narrative").distinct()
    told = told.withColumn("k", F.row_number().over(Window.partitionBy("pdf_name").orderBy("narrative"))).join(logs.select(*own).distinct(), "pdf_name")
    told = told.select(*own, "k", F.posexplode(F.filter(F.split("narrative", r"\s+"), lambda w: w != "")).alias("w", "text"))
    line, at = F.col("k") * 10000 + F.floor(F.col("w") / 8), F.col("w") % 8
    told = told.select(
        F.col("pdf_name").alias("docid"), "docpg", line.cast("bigint").alias("line_id"), "text",
        *[v.cast("bigint").alias(n) for v, n in ((line * 50 + at, "word_id"), (at * 150, "x0"), (line * 20, "y0"), (at * 150 + 60, "x1"), (line * 20 + 12, "y1"))],
        F.lit("narrative").alias("section"), F.lit(0.8).alias("section_conf"),
    )
    return dates.unionByName(codes).unionByName(heads).unionByName(body).unionByName(told)


INCIDENTS_SQL = """
  SELECT pdf_name AS docid, 'Occurrence Date ' || day AS incident_date, CAST(row_number() OVER (PARTITION BY pdf_name ORDER BY sl_id) AS BIGINT) AS iucr_id, 'IUCR ' || lpad(CAST(sl_id % 10000 AS VARCHAR), 4, '0') || ' - ' || coalesce(beat, 'NONE') AS iucr
  FROM summary_logs JOIN (SELECT pdf_name, coalesce(strftime(min(loaded_at), '%d-%m-%Y'), 'unknown') AS day FROM summary_logs GROUP BY pdf_name) USING (pdf_name) WHERE address_of_incident IS NOT NULL
"""
ISSUES_SQL = """
  SELECT docid, string_agg(DISTINCT issue, '; ' ORDER BY issue) AS suspected_issues FROM (
    SELECT pdf_name AS docid, 'multiple OCIC reports concatenated' AS issue FROM summary_logs WHERE pdf_name IS NOT NULL GROUP BY pdf_name HAVING count(DISTINCT page_num) > 1
    UNION ALL SELECT pdf_name, 'unknown page types' FROM summary_logs WHERE pdf_name IS NOT NULL AND party_name IS NOT NULL GROUP BY pdf_name HAVING count(DISTINCT page_num) > 1) GROUP BY docid
"""
PERSONNEL_SQL = """
  SELECT pdf_name AS docid, CAST(row_number() OVER (PARTITION BY pdf_name ORDER BY sl_id) AS DOUBLE) AS "row", coalesce(party_role, '-') AS role, coalesce(star_no, '-') AS star_no, party_name AS name,
    NULL::VARCHAR AS "date", NULL::VARCHAR AS unit, coalesce(beat, '-') AS beat FROM summary_logs WHERE party_name IS NOT NULL
"""


def _laid_out(lines: DataFrame, indent: float) -> DataFrame:
    """fileid, filename, page_no, line_id, word_id, text, x0..y1 in inches, conf of text lines."""
    rows = lines.select("fileid", "filename", F.posexplode("lines").alias("i", "line")).select("fileid", "filename", "i", F.posexplode(F.split("line", " +")).alias("w", "text"))
    rows = rows.where("text <> ''")
    x0, y0 = F.lit(indent) + F.col("w") * 0.1, 0.6 + F.pmod(F.col("i"), F.lit(40)) * 0.24
    return rows.select(
        "fileid", "filename", (1 + F.floor(F.col("i") / 40)).cast("int").alias("page_no"), F.pmod(F.col("i"), F.lit(40)).alias("line_id"), F.col("w").alias("word_id"), "text",
        x0.alias("x0"), y0.alias("y0"), (x0 + 0.08).alias("x1"), (y0 + 0.18).alias("y1"), F.lit(90).alias("conf"),
    )


def _narrative_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each different narrative of each report as a file of its own."""
    keys = ["docid", "orig_filename", "orig_pg_start", "orig_pg_end", "narrative"]
    rows = read_table(spark, sf_dir, "report_extract").where("narrative is not null").select(*keys).distinct()
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("docid").orderBy(*keys[1:])))
    name = F.concat(F.regexp_replace("orig_filename", r"\.pdf$", ""), F.format_string("-%04d-%04d.pdf", "orig_pg_start", "orig_pg_end"))
    return rows.select(F.concat_ws("-", "docid", "n").alias("fileid"), name.alias("filename"), F.split(F.replace("narrative", F.lit("\r"), F.lit("")), "\n").alias("body"))


_NARRATIVES_SQL = """
  SELECT docid || '-' || row_number() OVER (PARTITION BY docid ORDER BY orig_filename, orig_pg_start, orig_pg_end, narrative) AS fileid,
    regexp_replace(orig_filename, '\\.pdf$', '') || printf('-%04d-%04d.pdf', orig_pg_start, orig_pg_end) AS filename, string_split(replace(narrative, chr(13), ''), chr(10)) AS body
  FROM (SELECT DISTINCT docid, orig_filename, orig_pg_start, orig_pg_end, narrative FROM report_extract WHERE narrative IS NOT NULL)
"""
#: The digest pages of digest_words put together again: the box is on the first page, forty lines; a line left out parts paragraphs.
DIGESTS_SQL = f"""
  WITH l AS (SELECT fileid, filename, i, array_to_string(list_filter(regexp_split_to_array(line, ' +'), lambda w: w <> ''), ' ') t
    FROM (SELECT fileid, filename, unnest(body) line, generate_subscripts(body, 1) i FROM ({_NARRATIVES_SQL}))),
  k AS (SELECT *, lag(i) OVER (PARTITION BY fileid ORDER BY i) p FROM l WHERE i < 40 AND len(regexp_extract_all(t, '[A-Za-z0-9]')) > 2 AND NOT regexp_matches(t, '^CPD [0-9]+$|^CPD.+Page [0-9]+|^\\(Rev\\.|SEE ATTACHED')),
  r AS (SELECT *, sum(CASE WHEN p = i - 1 THEN 0 ELSE 1 END) OVER (PARTITION BY fileid ORDER BY i) g FROM k),
  q AS (SELECT fileid, filename, g, trim(regexp_replace(string_agg(t, ' ' ORDER BY i), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) t FROM r GROUP BY fileid, filename, g)
  SELECT fileid, nullif(regexp_extract(filename, '^LOG_([0-9]+)-', 1), '') AS cr_id, filename, string_agg(t, chr(10) || chr(10) ORDER BY g) AS text, 1 AS pass_no FROM q GROUP BY fileid, filename"""


def digest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives as digest pages: the allegation box, then a summary."""
    rows = _narrative_lines(spark, sf_dir)
    return _laid_out(rows.select("fileid", "filename", F.concat(F.array(F.lit("ALLEGATIONS")), "body", F.array(F.lit("SUMMARY"), F.lit("Nothing further."))).alias("lines")), 0.6)


def complaint_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives as web complaints: between the information and the location label."""
    rows = _narrative_lines(spark, sf_dir)
    return _laid_out(rows.select("fileid", "filename", F.concat(F.array(F.lit("WEB Complaint"), F.lit("INFORMATION ABOUT THE INCIDENT")), "body", F.array(F.lit("Location of the incident"), F.lit("unknown"))).alias("lines")), 2.6)


def rule_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text: pages as the head, tail and left-margin rules expect them, each rule in turn, with a letter
    changed on two of three pages. For every row of cr_pdf_pages."""
    pages = read_table(spark, sf_dir, "cr_pdf_pages").select("id")
    pattern = F.get(F.array(*[F.lit(t) for t in _RULE_TEXTS]), (F.col("id") % len(_RULE_TEXTS)).cast("int"))
    at = (F.col("id") % 11).cast("int") + 2
    slipped = F.concat(F.substring("p", F.lit(1), at - 1), F.lit("q"), F.substring("p", at + 1, F.length("p")))
    changed = F.when(F.col("id") % 3 == 0, F.col("p")).otherwise(slipped)
    return pages.select("id", pattern.alias("p")).select("id", changed.alias("text"))


def _rule_texts() -> list[str]:
    """The text of a page for each rule; prose stands around it where the rule allows."""
    plain = ["Zzyzx wug blicket dax", "Wug dax zzyzx"]
    heads = ["\n".join([p, *plain, plain[0]]) for p, _ in HEAD_RULES]
    tails = ["\n".join([*plain, p]) for p, _ in TAIL_RULES]
    lefts = ["\n".join([*plain, *[f"{p} {plain[1]}" for p in patterns], *plain]) for patterns, _ in LEFT_RULES]
    return heads + tails + lefts


_RULE_TEXTS = _rule_texts()
_TEXTS_SQL = "[" + ", ".join("'" + t.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for t in _RULE_TEXTS) + "]"
RULE_PAGES_SQL = f"""
  SELECT id, CASE WHEN id % 3 = 0 THEN p ELSE substring(p, 1, id % 11 + 1) || 'q' || substring(p, id % 11 + 3, length(p)) END AS text
  FROM (SELECT id, ({_TEXTS_SQL})[CAST(id % {len(_RULE_TEXTS)} + 1 AS BIGINT)] AS p FROM cr_pdf_pages)"""
