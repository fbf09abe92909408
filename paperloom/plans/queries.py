"""Registered queries of the core, over whole tables, each with its DuckDB equivalent beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions import text as tx
from paperloom.functions.stats import average_rank, distinct_sorted_concat, median_counting_nulls
from paperloom.operators import attributes, classify, dedupe, features, forms, layout, lines, narratives, records, relational, reports, sequence_model
from paperloom.operators.rules import HEAD_RULES, LEFT_RULES, LINE_PATTERNS, SECTION_NAMES, SECTIONS, TAIL_RULES
from paperloom.plans import cells_sql, frames, source_queries
from paperloom.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def _add(name: str, build: Query, sql: str | None = None) -> None:
    _QUERIES[name] = build
    if sql:
        _ORACLE[name] = sql


def _on(*tables: str):
    """A builder over tables instead of a session."""
    return lambda build: lambda spark, sf_dir: build(*[read_table(spark, sf_dir, t) for t in tables])


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# attribute-value rows into wide tables


def _entries(spark, sf_dir):
    return attributes.form_entries(*[read_table(spark, sf_dir, t) for t in ("cr_summary_data_temp", "cr_pdfs", "form_columns")])


_add("p3_found", lambda s, d: attributes.readable_attributes(_entries(s, d), attributes.ENTRY), cells_sql.READABLE)
_add("p3_entries", _entries)

# batch reports

_FIVE = (
    "list_avg(list_filter(list_slice(list_sort(list({0}), 'ASC', 'NULLS LAST'), CAST(ceil(count(*) / 2.0) AS BIGINT), CAST(ceil(count(*) / 2.0) AS BIGINT) + 1 - count(*) % 2), lambda x: x IS NOT NULL)) AS median, "
    'CAST(min({0}) AS BIGINT) AS "min", CAST(max({0}) AS BIGINT) AS "max", round(avg({0}), 6) AS "avg", CAST(sum({0}) AS BIGINT) AS "sum"'
)
_add("pdfs_per_batch", _on("cr_batch", "cr_pdfs")(reports.pdfs_per_batch), """
  SELECT count(*) AS "count", dropbox_path FROM cr_batch b JOIN cr_pdfs p ON p.batch_id = b.id GROUP BY dropbox_path, b.id
  UNION SELECT count(*), 'all' FROM cr_pdfs""")
_add("crids_per_batch", _on("cr_batch", "cr_pdfs")(reports.crids_per_batch), f"""
  SELECT dropbox_path, {_FIVE.format('n')} FROM (SELECT dropbox_path, cr_id, count(cr_id) n FROM cr_pdfs p JOIN cr_batch b ON b.id = p.batch_id GROUP BY ALL) GROUP BY dropbox_path
  UNION SELECT 'combined', {_FIVE.format('n')} FROM (SELECT count(cr_id) n FROM cr_pdfs GROUP BY cr_id)""")
_add("pages_per_batch", _on("cr_batch", "cr_pdfs")(reports.pages_per_batch), f"""
  SELECT dropbox_path, {_FIVE.format('page_count')} FROM cr_pdfs p JOIN cr_batch b ON b.id = p.batch_id GROUP BY dropbox_path
  UNION SELECT 'combined', {_FIVE.format('page_count')} FROM cr_pdfs""")
_add("count_histogram", _on("cr_pdfs")(reports.count_histogram), """
  SELECT "count", count("count") AS count_of_count FROM (SELECT count(cr_id) AS "count" FROM cr_pdfs GROUP BY cr_id) GROUP BY "count" """)
_add("count_histogram_per_batch", _on("cr_batch", "cr_pdfs")(reports.count_histogram_per_batch), """
  SELECT "count", count("count") AS count_of_count, dropbox_path FROM (SELECT count(cr_id) AS "count", batch_id FROM cr_pdfs GROUP BY cr_id, batch_id) q
  JOIN cr_batch b ON q.batch_id = b.id GROUP BY "count", dropbox_path""")
_add("ordered_histogram", _on("cr_pdfs")(reports.ordered_histogram), """
  SELECT "count", count_of_count, row_number() OVER (ORDER BY count_of_count DESC, "count") AS position FROM (
    SELECT "count", count("count") AS count_of_count FROM (SELECT count(cr_id) AS "count" FROM cr_pdfs GROUP BY cr_id) GROUP BY "count")""")
_add("median_with_nulls", _on("cr_pdfs")(
    lambda p: p.groupBy("batch_id").agg(median_counting_nulls(F.col("cr_id")).alias("median"), F.median("cr_id").alias("plain_median"))), """
  SELECT batch_id, list_avg(list_filter(list_slice(list_sort(list(cr_id), 'ASC', 'NULLS LAST'), CAST(ceil(count(*) / 2.0) AS BIGINT),
    CAST(ceil(count(*) / 2.0) AS BIGINT) + 1 - count(*) % 2), lambda x: x IS NOT NULL)) AS median, median(cr_id) AS plain_median FROM cr_pdfs GROUP BY batch_id""")

# joins, updates, sets

_VIEW_SQL = """
  SELECT p.cr_id, p.filename AS pdf_name, p.id AS pdf_id, pp.id AS page_id, sd.row_id AS summary_data_id, pp.page_num, sd.section_name, sd.column_name, sd.text, p.doccloud_url
  FROM cr_summary_data_temp sd JOIN cr_pdfs p ON sd.pdf_name = p.filename JOIN cr_pdf_pages pp ON pp.pdf_id = p.id AND pp.page_num = sd.page_num
  WHERE sd.text IS NOT NULL AND ((section_name = 'Accused Members' AND column_name = 'Initial / Intake Allegation')
    OR (section_name = 'Incident Finding / Overall Case Finding' AND column_name = 'Finding') OR (section_name = 'Current Allegations' AND column_name = 'Allegation') {0})
"""
_view = _on("cr_summary_data_temp", "cr_pdfs", "cr_pdf_pages")(relational.narratives_view)
_add("narratives_view", _view, _VIEW_SQL.format(""))
_add("narratives_view_with_remarks", _on("cr_summary_data_temp", "cr_pdfs", "cr_pdf_pages")(lambda c, p, g: relational.narratives_view(c, p, g, True)),
     _VIEW_SQL.format("OR (section_name = 'Review Incident' AND column_name = 'Remarks')"))
_add("narrative_counts", lambda s, d: _view(s, d).groupBy("section_name", "column_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length("text")), 6).alias("avg_length"), F.median(F.length("text")).alias("median_length")),
     f"SELECT section_name, column_name, count(*) AS n, round(avg(length(text)), 6) AS avg_length, median(length(text)) AS median_length FROM ({_VIEW_SQL.format('')}) GROUP BY section_name, column_name")
_add("cr_id_update", _on("cr_pdfs")(lambda p: relational.update_log_numbers(p).select("id", "filename", "cr_id")), """
  SELECT id, filename, coalesce(CASE WHEN filename LIKE 'LOG_%' THEN TRY_CAST(list_extract(regexp_split_to_array(filename, '[_ .]'), 2) AS INTEGER) END, cr_id) AS cr_id FROM cr_pdfs""")
_add("cr_id_update_from_batches", _on("cr_pdfs", "report_extract")(
    lambda p, r: relational.update_log_numbers(p, r.select(
        F.split_part("orig_filename", F.lit("."), F.lit(1)).alias("prod_begin"), F.concat(F.lit("LOG_"), F.col("cr_id").cast("string"), F.lit("_x")).alias("log_number"), F.lit(None).cast("string").alias("filename")
    ).distinct()).select("id", "filename", "cr_id")), """
  WITH bd AS (SELECT split_part(orig_filename, '.', 1) || '.pdf' AS f, min(cr_id) AS a FROM report_extract GROUP BY 1)
  SELECT p.id, p.filename, coalesce(CASE WHEN filename LIKE 'LOG_%' THEN TRY_CAST(list_extract(regexp_split_to_array(filename, '[_ .]'), 2) AS INTEGER) END, bd.a, p.cr_id) AS cr_id
  FROM cr_pdfs p LEFT JOIN bd ON bd.f = p.filename""")
_add("page_class_update", _on("cr_pdf_pages")(lambda g: relational.update_page_class(
    g, g.where("page_classification is null").select("pdf_id", "page_num", F.concat(F.lit("Page "), F.col("page_num").cast("string")).alias("page_classification")))), """
  SELECT id, pdf_id, page_num, coalesce(page_classification, 'Page ' || page_num) AS page_classification FROM cr_pdf_pages""")
_add("pending_uploads", _on("cr_batch", "cr_pdfs")(relational.pending_uploads), """
  SELECT dropbox_path, filename, cr_id FROM cr_batch b JOIN cr_pdfs p ON b.id = p.batch_id WHERE doccloud_url IS NULL""")
_add("pending_titles", _on("cr_pdfs", "report_extract")(lambda p, r: relational.pending_titles(p, r.select(F.regexp_replace("orig_filename", r"\.pdf$", "").alias("title")))), """
  SELECT filename FROM cr_pdfs WHERE lower(regexp_replace(filename, '\\.pdf$', '')) NOT IN (SELECT lower(regexp_replace(orig_filename, '\\.pdf$', '')) FROM report_extract WHERE orig_filename IS NOT NULL)""")
_add("first_per_title", _on("report_extract")(lambda r: relational.keep_first(r, ["orig_filename"], ["extracted_at", "docid", "orig_pg_start"]).select("orig_filename", "docid", "orig_pg_start")), """
  SELECT orig_filename, docid, orig_pg_start FROM (SELECT *, row_number() OVER (PARTITION BY orig_filename ORDER BY extracted_at, docid, orig_pg_start) n FROM report_extract) WHERE n = 1""")
_add("insert_ignore", _on("cr_batch", "cr_pdfs")(lambda b, p: relational.insert_ignore(
    b.select("id", "dropbox_path"), p.select(F.concat(F.lit("/intake/production_"), F.lpad(F.pmod(F.col("id"), F.lit(40)).cast("string"), 2, "0"), F.lit("/pdf")).alias("dropbox_path")), ["dropbox_path"])), """
  WITH new AS (SELECT DISTINCT '/intake/production_' || lpad(CAST(id % 40 AS VARCHAR), 2, '0') || '/pdf' AS dropbox_path FROM cr_pdfs)
  SELECT id, dropbox_path FROM cr_batch UNION ALL
  SELECT (SELECT max(id) FROM cr_batch) + row_number() OVER (ORDER BY dropbox_path), dropbox_path FROM new WHERE dropbox_path NOT IN (SELECT dropbox_path FROM cr_batch)""")
_add("missing_pages", _on("cr_pdfs", "cr_pdf_pages")(lambda p, g: relational.missing_pages(p, g.where("page_classification is not null")).withColumn("missing", F.array_join("missing", ","))), """
  SELECT filename, CAST(page_count AS BIGINT) AS expected, page_count - count(*) FILTER (have IS NULL) AS present, string_agg(CASE WHEN have IS NULL THEN CAST(n AS VARCHAR) END, ',' ORDER BY n) AS missing
  FROM (SELECT p.id, p.filename, p.page_count, g.n, h.page_num AS have FROM cr_pdfs p, LATERAL (SELECT unnest(range(1, CAST(p.page_count AS BIGINT) + 1)) AS n) g
    LEFT JOIN (SELECT DISTINCT pdf_id, page_num FROM cr_pdf_pages WHERE page_classification IS NOT NULL) h ON h.pdf_id = p.id AND h.page_num = g.n WHERE p.page_count >= 1)
  GROUP BY id, filename, page_count HAVING count(*) FILTER (have IS NULL) > 0""")
_add("missing_numbers", _on("cr_pdfs")(lambda p: relational.missing_numbers(p.where("batch_id is not null"), "batch_id", "id")), """
  WITH r AS (SELECT batch_id, min(id) a, max(id) b FROM cr_pdfs WHERE batch_id IS NOT NULL GROUP BY batch_id)
  SELECT batch_id, n AS missing FROM (SELECT batch_id, unnest(range(a, b + 1)) AS n FROM r) ANTI JOIN (SELECT batch_id, id AS n FROM cr_pdfs) USING (batch_id, n)""")
_add("page_ranges", _on("cr_pdfs", "cr_pdf_pages")(lambda p, g: relational.page_ranges(
    g.where("page_classification is not null").join(p.select(F.col("id").alias("pdf_id"), "filename", "page_count"), "pdf_id"), "Log Digest", ["filename"])), """
  WITH e AS (SELECT filename, page_num, page_classification, coalesce(lead(page_num) OVER (PARTITION BY filename ORDER BY page_num) - 1, page_count) AS page_to
    FROM cr_pdf_pages g JOIN cr_pdfs p ON p.id = g.pdf_id WHERE page_classification IS NOT NULL)
  SELECT filename, page_num AS page_from, page_to, rank() OVER (PARTITION BY filename ORDER BY page_num) + (count(*) OVER (PARTITION BY filename, page_num) - 1) / 2.0 AS rpt_num
  FROM e WHERE page_classification = 'Log Digest'""")
_add("join_problems", _on("report_extract", "cr_pdfs")(lambda r, p: relational.checked_left_join(
    r.select(F.col("orig_filename").alias("filename"), "docid", "cr_id"), p.select("filename", F.col("cr_id").alias("ref_crid")), ["filename"], ("cr_id", "ref_crid"))[1]), """
  SELECT r.orig_filename AS filename, 'disagrees' AS problem, count(*) AS "rows" FROM report_extract r JOIN cr_pdfs p ON p.filename = r.orig_filename
  WHERE p.cr_id IS NOT NULL AND (r.cr_id IS NULL OR r.cr_id <> p.cr_id) GROUP BY 1""")
_add("labels_of_batches", _on("cr_pdfs", "cr_pdf_pages")(lambda p, g: g.join(p.select(F.col("id").alias("pdf_id"), "batch_id"), "pdf_id").groupBy("batch_id").agg(
    distinct_sorted_concat(F.col("page_classification")).alias("classes"), F.count_distinct("page_classification").alias("n"))), """
  SELECT batch_id, coalesce(string_agg(DISTINCT page_classification, '; ' ORDER BY page_classification), '') AS classes, count(DISTINCT page_classification) AS n
  FROM cr_pdf_pages g JOIN cr_pdfs p ON p.id = g.pdf_id GROUP BY batch_id""")
_add("union_by_name", _on("cr_pdfs", "report_extract")(lambda p, r: relational.union_by_name(
    p.select("filename", "page_count"), r.select(F.col("orig_filename").alias("filename"), "docid"))), """
  SELECT filename, page_count, NULL::VARCHAR AS docid FROM cr_pdfs UNION ALL SELECT orig_filename, NULL, docid FROM report_extract""")
_add("files_without_reports", _on("cr_pdfs", "report_extract")(lambda p, r: p.select("filename").subtract(r.select("orig_filename"))), """
  SELECT DISTINCT filename FROM cr_pdfs EXCEPT SELECT orig_filename FROM report_extract""")

# near-duplicates by trigrams

_GRAMS = ("list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), "
          "lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))")
_SIM = "coalesce(len(list_intersect({0}, {1})) / nullif(len({0}) + len({1}) - len(list_intersect({0}, {1})), 0)::DOUBLE, 0.0)"
_add("trigram_histogram", lambda s, d: dedupe.similarity_histogram(_view(s, d)), f"""
  WITH v AS (SELECT *, {_GRAMS.format('text')} AS g FROM ({_VIEW_SQL.format('')}))
  SELECT round_even({_SIM.format('a.g', 'b.g')} * 100, 0) / 100 AS sim_bracket, count(*) AS pairs FROM v a JOIN v b ON a.cr_id = b.cr_id AND a.section_name = b.section_name
    AND a.column_name = b.column_name AND a.page_id <> b.page_id GROUP BY 1""")
_add("trigram_dedupe", lambda s, d: dedupe.drop_near_duplicates(_view(s, d)).select("summary_data_id", "cr_id", "section_name"), f"""
  WITH v AS (SELECT *, {_GRAMS.format('text')} AS g FROM ({_VIEW_SQL.format('')}))
  SELECT summary_data_id, cr_id, section_name FROM v b WHERE NOT EXISTS (SELECT 1 FROM v a WHERE a.cr_id = b.cr_id AND a.summary_data_id < b.summary_data_id
    AND round_even({_SIM.format('a.g', 'b.g')} * 100, 0) / 100 > 0.95)""")

# page classes

_LINES = ("list_filter(list_transform(range(1, len(string_split({0}, chr(10))) + 1), lambda i: string_split({0}, chr(10))[i] || CASE WHEN i < len(string_split({0}, chr(10))) THEN chr(10) ELSE '' END), "
          "lambda l: regexp_matches(l, '[a-zA-Z]{{3,}}') AND l <> 'CITY OF CHICAGO')")


def _first_rule_sql(lines_sql: str, rules) -> str:
    hit = "len(list_filter({0}, lambda l: levenshtein(lower(substring(l, 1, {1})), {2}) < 0.15 * {1})) > 0"
    whens = " ".join(f"WHEN {hit.format(lines_sql, len(p), _text(p.lower()))} THEN {_text(c)}" for p, c in rules)
    return f"CASE {whens} END"


def _left_rule_sql(lines_sql: str) -> str:
    whens = []
    for patterns, name in LEFT_RULES:
        need = patterns[:-1]
        arms = " ".join(f"WHEN i = '{k}' AND levenshtein(substring(l, 1, {len(p)}), {_text(p)}) <= 0.125 * {len(p)} THEN '{k + 1}'" for k, p in enumerate(need))
        whens.append(f"WHEN list_reduce({lines_sql}, lambda i, l: CASE {arms} ELSE i END, '0') = '{len(need)}' THEN {_text(name)}")
    return "CASE " + " ".join(whens) + " END"


def _classes_sql(pages: str, key: str) -> str:
    return f"""
  WITH p AS (SELECT {key}, {_LINES.format('text')} AS ls FROM ({pages})),
  c AS (SELECT {key}, {_first_rule_sql('list_slice(ls, 1, 2)', HEAD_RULES)} AS head, {_first_rule_sql('list_slice(ls, greatest(len(ls) - 1, 1), len(ls))', TAIL_RULES)} AS tail,
    {_left_rule_sql('ls')} AS left_margin FROM p)
  SELECT {key}, head, tail, left_margin, coalesce(head, tail, left_margin) AS page_class FROM c"""


_add("page_classes", lambda s, d: classify.classified_pages(frames.cell_pages(s, d)).drop("text"), _classes_sql(frames.PAGES_SQL, "row_id"))
_add("rule_page_classes", lambda s, d: classify.classified_pages(frames.rule_pages(s, d)).drop("text"), _classes_sql(frames.RULE_PAGES_SQL, "id"))
_add("control_numbers", _on("cr_summary_data_temp")(lambda c: c.select("row_id", classify.control_number(
    F.concat(F.coalesce("text", F.lit("")), F.lit("\n x CPD"), F.repeat(F.lit(" "), F.col("row_id") % 3), F.lit("00"), (F.col("row_id") % 4).cast("string"), F.lpad((F.col("row_id") * 37 % 100000).cast("string"), 5, "0"), F.lit(" end\nlast"))).alias("control_number"))), """
  SELECT row_id, 'CPD ' AS control_number FROM cr_summary_data_temp WHERE false UNION ALL
  SELECT row_id, list_aggregate(list_slice(regexp_split_to_array(regexp_replace(list_last(list_filter(list_transform(string_split(t, chr(10)), lambda l: trim(l)),
    lambda l: regexp_matches(l, 'CPD {0,2}00[0-3][0-9]{4,6}'))), '^.*CPD 00', 'CPD 00'), '[^CPD0-9]'), 1, 2), 'string_agg', ' ') AS control_number
  FROM (SELECT row_id, coalesce(text, '') || chr(10) || ' x CPD' || repeat(' ', row_id % 3) || '00' || (row_id % 4) || lpad(CAST(row_id * 37 % 100000 AS VARCHAR), 5, '0') || ' end' || chr(10) || 'last' AS t FROM cr_summary_data_temp)""")

# lines, windows, boxes

_add("document_lines", lambda s, d: lines.document_lines(lines.confident_words(frames.document_words(s, d)), ["docid", "docpg", "line_id"], ["word_id"]), f"""
  SELECT docid, docpg, line_id, string_agg(text, ' ' ORDER BY word_id) AS text, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1
  FROM ({frames.WORDS_SQL}) WHERE conf > 50 AND trim(text) <> '' GROUP BY docid, docpg, line_id""")
_add("same_line_groups", lambda s, d: lines.same_line_groups(frames.document_words(s, d), ["docid", "docpg"]).groupBy("docid", "docpg").agg(F.max("line_no").alias("lines"), F.count(F.lit(1)).alias("words")), f"""
  SELECT docid, docpg, CAST(sum(CASE WHEN y0 <= m THEN 0 ELSE 1 END) AS BIGINT) AS lines, count(*) AS words
  FROM (SELECT *, lag((y0 + y1) / 2) OVER (PARTITION BY docid, docpg ORDER BY y0, word_id) m FROM ({frames.WORDS_SQL})) GROUP BY docid, docpg""")
_add("break_groups", lambda s, d: lines.break_groups(frames.document_page_lines(s, d), ["docid", "docpg"], ["line_id"], F.col("y0") > F.lag("y1").over(Window.partitionBy("docid", "docpg").orderBy("line_id")) + 0.1).select("docid", "docpg", "line_id", "pid"), f"""
  SELECT docid, docpg, line_id, CAST(sum(CASE WHEN coalesce(y0 > p + 0.1::DOUBLE, true) THEN 1 ELSE 0 END) OVER (PARTITION BY docid, docpg ORDER BY line_id) AS BIGINT) AS pid
  FROM (SELECT *, lag(y1) OVER (PARTITION BY docid, docpg ORDER BY line_id) p FROM ({frames.LINES_SQL}))""")
_add("fill_down", _on("cr_pdf_pages")(lambda g: lines.fill_down(g, ["pdf_id"], ["page_num"], "page_classification").select("id", "page_classification")), """
  SELECT id, last_value(page_classification IGNORE NULLS) OVER (PARTITION BY pdf_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page_classification FROM cr_pdf_pages""")
_add("average_rank", _on("cr_pdfs")(lambda p: p.select("id", average_rank(F.asc_nulls_last("page_count"), Window.partitionBy("batch_id"), Window.partitionBy("batch_id", "page_count")).alias("r"))), """
  SELECT id, rank() OVER (PARTITION BY batch_id ORDER BY page_count NULLS LAST) + (count(*) OVER (PARTITION BY batch_id, page_count) - 1) / 2.0 AS r FROM cr_pdfs""")
_add("group_filters", _on("cr_pdf_pages")(lambda g: g.withColumn("m", F.max("page_num").over(Window.partitionBy("pdf_id"))).withColumn("k", F.size(F.collect_set("page_classification").over(Window.partitionBy("pdf_id"))))
     .where("page_num = m and k = 1").select("id", "pdf_id", "page_num")), """
  SELECT id, pdf_id, page_num FROM cr_pdf_pages WHERE pdf_id IN (SELECT pdf_id FROM cr_pdf_pages GROUP BY pdf_id HAVING count(DISTINCT page_classification) = 1)
    AND (pdf_id, page_num) IN (SELECT pdf_id, max(page_num) FROM cr_pdf_pages GROUP BY pdf_id)""")
_add("column_islands", lambda s, d: layout.column_islands(frames.document_words(s, d), ["docid", "docpg"], 12).groupBy("docid", "docpg", "column_id").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count(F.lit(1)).alias("words")), f"""
  SELECT docid, docpg, column_id, min(x0) AS x0, max(x1) AS x1, count(*) AS words FROM (
    SELECT *, CAST(sum(CASE WHEN reach IS NULL OR x0 - reach >= 12 THEN 1 ELSE 0 END) OVER (PARTITION BY docid, docpg ORDER BY x0, x1, word_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS column_id FROM (
      SELECT *, max(x1) OVER (PARTITION BY docid, docpg ORDER BY x0, x1, word_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({frames.WORDS_SQL})))
  GROUP BY docid, docpg, column_id""")


def _chunks(spark, sf_dir):
    words = frames.document_words(spark, sf_dir)
    chunks = layout.chunk_components(words, ["docid", "docpg"])
    boxes = layout.chunk_boxes(words, chunks, ["docid", "docpg"])
    return layout.words_in_chunks(words, boxes, ["docid", "docpg"]).select("docid", "docpg", "word_id", "chunk_id", "area")


_add("words_in_chunks", _chunks)
_BANDS = "SELECT docid, docpg, section, min(x0) cx0, max(x1) cx1, min(y0) cy0, max(y1) cy1, (max(x1) - min(x0)) * (max(y1) - min(y0)) AS area FROM w GROUP BY docid, docpg, section"


def _containment(spark, sf_dir):
    words = frames.document_words(spark, sf_dir)
    page = ["docid", "docpg"]
    boxes = layout.chunk_boxes(words, words.select(*page, "word_id", F.col("section").alias("chunk_id")), page)
    return layout.words_in_chunks(words, boxes, page).select(*page, "word_id", F.col("chunk_id").alias("section"), "area")


_add("containment_join", _containment, f"""
  WITH w AS ({frames.WORDS_SQL}), b AS ({_BANDS})
  SELECT docid, docpg, word_id, section, area FROM (SELECT w.docid, w.docpg, w.word_id, b.section, b.area, max(b.area) OVER (PARTITION BY w.docid, w.docpg, w.word_id) m
    FROM w JOIN b ON w.docid = b.docid AND w.docpg = b.docpg AND x0 >= cx0 AND x1 <= cx1 AND y0 >= cy0 AND y1 <= cy1) WHERE area = m""")

# features

_SIDE = r"[^\p{L}\p{M}\p{Nd}\p{Pc}]"
_PATTERNS_SQL = ", ".join(f"CAST(regexp_matches(text, {_text(f'({_SIDE}|^){p}({_SIDE}|$)')}) AS INTEGER) AS {n}" for n, p in LINE_PATTERNS.items())
_CAPITALS = "array_to_string(list_transform(string_split(lower(text), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_add("pattern_features", lambda s, d: features.pattern_features(frames.heading_lines(s, d).withColumn("text", F.initcap("text"))), f"SELECT docid, docpg, line_id, {_PATTERNS_SQL} FROM (SELECT * REPLACE ({_CAPITALS} AS text) FROM ({frames.HEADING_SQL}))")
_add("document_patterns", lambda s, d: features.pattern_features(frames.document_page_lines(s, d)), f"SELECT docid, docpg, line_id, {_PATTERNS_SQL} FROM ({frames.LINES_SQL})")


def _bin_sql(value: str, edges: list) -> str:
    show = lambda e: "Inf" if e is None else f"{e:g}"
    arms = []
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        first = i == 0 and a is not None
        low = "true" if a is None else f"{value} {'>=' if first else '>'} {a}::DOUBLE"
        high = "true" if b is None else f"{value} <= {b}::DOUBLE"
        arms.append(f"WHEN {value} IS NOT NULL AND {low} AND {high} THEN '{'[' if first else '('}{'-Inf' if a is None else show(a)},{show(b)}]'")
    return "CASE " + " ".join(arms) + " END"


_Y = [0.0, 0.5, 1.0, 1.5, 9.5, 10.0, None]
_WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
_SHAPES_SQL = f"""
  SELECT docid, docpg, line_id, x1, {_bin_sql('y0', _Y)} AS y0_bin, {_bin_sql('y1', _Y)} AS y1_bin, {_bin_sql('x0', [0.0, 0.5, 1.0, 3.0, 5.0, None])} AS x0_bin,
    contains(text, '?') AS has_qmark, contains(text, ':') AS has_colon, contains(text, '#') AS has_octo,
    len(regexp_extract_all(text, '[A-Z]')) / nullif(length(text), 0)::DOUBLE > 0.25 AS has_caps,
    trim(nullif(regexp_extract(text, '^{_WORD}+({_SIDE}|$)'), '')) AS word_1, trim(nullif(regexp_extract(text, '{_WORD}+$'), '')) AS word_n,
    {_bin_sql("len(regexp_extract_all(text, '[0-9]'))", [0, 1, 5, None])} AS has_digits, {_bin_sql('(y0 - p)', [None, 0.0, 0.1, 0.2, 0.3, None])} AS has_gap
  FROM (SELECT *, lag(y1) OVER (PARTITION BY docid, docpg ORDER BY line_id) p FROM ({frames.LINES_SQL}))"""
_add("shape_features", lambda s, d: features.shape_features(frames.document_page_lines(s, d)), _SHAPES_SQL)
_Q4 = "list_transform(range(1, length({0}) - 2), lambda i: substring({0}, i, 4))"


def _cosine_sql(a: str, b: str) -> str:
    count = "len(list_filter({0}, lambda h: h = g))::DOUBLE"
    dot = f"list_sum(list_transform(list_intersect({a}, {b}), lambda g: {count.format(a)} * {count.format(b)}))"
    norm = lambda x: f"sqrt(list_sum(list_transform(list_distinct({x}), lambda g: {count.format(x)} * {count.format(x)})))"
    return f"1 - coalesce({dot} / nullif({norm(a)} * {norm(b)}, 0), 0.0)"


_NAMES_SQL = " UNION ALL ".join(f"SELECT {_text(n)} AS name, {_text(h)} AS heading" for n, h in SECTION_NAMES.items())
_NEAREST_SQL = f"""
  SELECT text, name AS section_name, round(d, 9) + 0.0 AS distance FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY round(d, 9), name) n FROM (
    SELECT text, name, CASE WHEN text = heading THEN 0.0 ELSE {_cosine_sql('q', 'r')} END AS d FROM (SELECT text, {_Q4.format('text')} AS q FROM (SELECT DISTINCT text FROM ({frames.HEADING_SQL})))
    CROSS JOIN (SELECT name, heading, {_Q4.format('heading')} AS r FROM ({_NAMES_SQL}))) WHERE d < 0.7) WHERE n = 1"""
_add("nearest_section", lambda s, d: features.nearest_section(frames.heading_lines(s, d)), _NEAREST_SQL)
_MARGIN_SQL = f"""
  WITH l AS ({frames.HEADING_SQL}), x AS ({_NEAREST_SQL}), b AS (SELECT docid, docpg, section_name, y0, y1 FROM l JOIN x USING (text) WHERE x1 < 0.5),
  k AS (SELECT * FROM b a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.docid = a.docid AND b.docpg = a.docpg AND b.y0 >= a.y0 AND b.y1 <= a.y1 AND b.section_name <> a.section_name))
  SELECT DISTINCT l.docid, l.docpg, l.line_id, k.section_name FROM l JOIN k ON l.docid = k.docid AND l.docpg = k.docpg AND l.y0 >= k.y0 AND l.y1 <= k.y1"""
_add("margin_sections", lambda s, d: features.margin_sections(frames.heading_lines(s, d)), _MARGIN_SQL)


def _collected(spark, sf_dir):
    page_lines = frames.document_page_lines(spark, sf_dir)
    none = features.margin_sections(frames.heading_lines(spark, sf_dir)).withColumns({"docid": F.col("docid"), "docpg": F.col("docpg").cast("bigint")})
    return features.collected_features(features.shape_features(page_lines), features.pattern_features(page_lines), none)


_add("lag_lead_features", lambda s, d: _collected(s, d).select("ln_identifier", "has_caps", "prv_word_1", "nxt_y0_bin", "prv_re_beat", "nxt_has_digits"), f"""
  WITH f AS (SELECT s.*, p.re_beat FROM ({_SHAPES_SQL}) s JOIN (SELECT docid, docpg, line_id, {_PATTERNS_SQL} FROM ({frames.LINES_SQL})) p USING (docid, docpg, line_id) WHERE x1 > 0.5)
  SELECT docid || '.' || docpg || '.' || line_id AS ln_identifier, has_caps, lag(word_1) OVER w AS prv_word_1, lead(y0_bin) OVER w AS nxt_y0_bin, lag(re_beat) OVER w AS prv_re_beat, lead(has_digits) OVER w AS nxt_has_digits
  FROM f WINDOW w AS (PARTITION BY docid, docpg ORDER BY line_id)""")
_add("feature_strings", lambda s, d: features.feature_strings(features.shape_features(frames.document_page_lines(s, d)).select(*features.LINE, "y0_bin", "has_colon", "has_digits"), features.LINE).withColumn("features", F.array_join("features", " ")), f"""
  SELECT docid, docpg, line_id, concat_ws(' ', 'has_colon=' || CAST(has_colon AS VARCHAR), 'has_digits=' || has_digits, 'y0_bin=' || y0_bin) AS features FROM ({_SHAPES_SQL})""")

# strings

_Q8 = "list_distinct(list_transform(range(1, length({0}) - 6), lambda i: substring({0}, i, 8)))"
_NOTE = "Complaint type classified as"
_add("jaccard8", _on("documents")(lambda x: x.where("text is not null").select("doc_id", F.round(tx.qgram_jaccard_distance(F.col("text"), F.lit(_NOTE), 8), 9).alias("d"))), f"""
  SELECT doc_id, round(CASE WHEN t = '{_NOTE}' THEN 0.0 ELSE 1 - coalesce(len(list_intersect(a, b)) / nullif(len(a) + len(b) - len(list_intersect(a, b)), 0)::DOUBLE, 0.0) END, 9) AS d
  FROM (SELECT doc_id, t, {_Q8.format('t')} AS a, {_Q8.format(f"'{_NOTE}'")} AS b FROM (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL))""")
_add("file_name_parts", _on("cr_pdfs")(lambda p: p.select(
    "id", tx.page_tail(F.col("filename"))[0].alias("stem"), tx.page_tail(F.col("filename"))[1].alias("page_from"), tx.page_tail(F.col("filename"))[2].alias("page_to"),
    tx.first_group(F.col("filename"), r"^LOG[_ ]([0-9]+)\-").alias("log"), tx.padded(F.col("id"), 6).alias("padded"), tx.line_key(F.col("id") % 100, (F.col("id") % 977) / 7.0).alias("line_key"))), """
  SELECT id, substring(filename, 1, greatest(length(filename) - 14, 0)) || '.pdf' AS stem, TRY_CAST(substring(filename, -13, 4) AS INTEGER) AS page_from, TRY_CAST(substring(filename, -8, 4) AS INTEGER) AS page_to,
    nullif(regexp_extract(filename, '^LOG[_ ]([0-9]+)\\-', 1), '') AS log, lpad(CAST(id AS VARCHAR), 6, '0') AS padded, lpad(CAST(id % 100 AS VARCHAR), 4, '0') || '-' || printf('%06.2f', (id % 977) / 7.0::DOUBLE) AS line_key FROM cr_pdfs""")
_add("normalized_levenshtein", _on("cr_summary_data_temp")(lambda c: c.where("section_name is not null").select("section_name").distinct().select(
    "section_name", F.round(tx.normalized_levenshtein(F.col("section_name"), F.lit("Accused Members")), 9).alias("d"))), """
  SELECT DISTINCT section_name, round(levenshtein(section_name, 'Accused Members') / greatest(length(section_name), 15)::DOUBLE, 9) AS d FROM cr_summary_data_temp WHERE section_name IS NOT NULL""")
_add("osa_matches", _on("cr_summary_data_temp")(lambda c: c.where("section_name is not null").select("section_name").distinct().where(
    tx.osa_below(F.col("section_name"), F.lit("Current Allegations"), 3))), """
  SELECT DISTINCT section_name FROM cr_summary_data_temp WHERE damerau_levenshtein(section_name, 'Current Allegations') < 3""")

# reports and narratives

_add("report_narratives", lambda s, d: records.report_narratives(frames.document_words(s, d)), f"""
  SELECT docid, round(sum(section_conf) / count(*), 9) AS narrative_conf, string_agg(text, ' ' ORDER BY docpg, line_id, word_id) AS narrative FROM ({frames.WORDS_SQL}) WHERE section = 'narrative' GROUP BY docid""")


def _faces(spark, sf_dir):
    v = _view(spark, sf_dir)
    reports_ = read_table(spark, sf_dir, "report_extract")
    files = reports_.select("cr_id", F.concat(F.regexp_replace("orig_filename", r"\.pdf$", ""), F.format_string("-%04d-%04d.pdf", "orig_pg_start", "orig_pg_end")).alias("filename"), F.col("narrative").alias("text"))
    return narratives.merged_narratives(v, files.where("cr_id % 2 = 0"), files.where("cr_id % 2 = 1"), read_table(spark, sf_dir, "cr_pdfs"))


_add("merged_narratives", _faces, f"""
  SELECT DISTINCT CAST(cr_id AS VARCHAR) AS cr_id, pdf_name AS filename, section_name || ' ' || column_name AS rpt_type, page_num AS rpt_page_from, page_num AS rpt_page_to, doccloud_url, text
  FROM ({_VIEW_SQL.format('')}) WHERE column_name IN ('Initial / Intake Allegation', 'Allegation')
  UNION ALL SELECT CAST(r.cr_id AS VARCHAR), r.orig_filename, CASE WHEN r.cr_id % 2 = 0 THEN 'log_summary_digest' ELSE 'web_complaint_detail' END, r.orig_pg_start, r.orig_pg_end, p.doccloud_url, r.narrative
  FROM report_extract r LEFT JOIN cr_pdfs p ON p.filename = r.orig_filename WHERE r.cr_id IS NOT NULL""")
_MATTER = lambda: F.when(F.col("doc_id") % 4 == 0, " It is on - going.").when(F.col("doc_id") % 4 == 1, " She was HARASSED.").when(F.col("doc_id") % 4 == 2, " He went on, going home.").otherwise("")
_add("topical_texts", _on("documents")(lambda x: narratives.topical_texts(x.withColumn("text", F.concat("text", _MATTER()))).select("doc_id", F.length("text").cast("bigint").alias("n"))), r"""
  SELECT doc_id, length(text) AS n FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' It is on - going.' WHEN 1 THEN ' She was HARASSED.' WHEN 2 THEN ' He went on, going home.' ELSE '' END AS text FROM documents) WHERE length(text) < 30000 AND regexp_matches(lower(text), '(on[\-\s]*going)|(harass)')""")
_add("stratified_sample", _on("documents")(lambda x: narratives.stratified_sample(x.select("doc_id", "rpt_type"), "rpt_type", ["doc_id"], 35)), """
  SELECT doc_id, rpt_type, place FROM (SELECT doc_id, rpt_type, CAST(row_number() OVER (PARTITION BY rpt_type ORDER BY md5(doc_id || '|0'), doc_id) AS INTEGER) AS place FROM documents) WHERE place <= 35""")
_add("short_strata", _on("documents")(lambda x: narratives.short_strata(x, "rpt_type", 60)), """
  SELECT rpt_type, count(*) AS "rows" FROM documents GROUP BY rpt_type HAVING count(*) < 60""")
_add("nested_round_trip", _on("cr_summary_data_temp")(lambda c: c.where("text is not null").groupBy("pdf_name", "page_num", "section_name").agg(F.collect_list(F.struct("row_id", "column_name", "text")).alias("columns"))
     .select("pdf_name", "page_num", "section_name", F.inline("columns"))), """
  SELECT pdf_name, page_num, section_name, row_id, column_name, text FROM cr_summary_data_temp WHERE text IS NOT NULL""")
_HEADERS = sorted({h for _, headers in SECTIONS for h in headers if h}, key=str.lower)
_add("pivot_cells", _on("cr_summary_data_temp")(lambda c: c.groupBy("pdf_name", "section_name", "row_num").pivot("column_name", _HEADERS).agg(F.min("text"))),
     "SELECT pdf_name, section_name, row_num, " + ", ".join(f"min(text) FILTER (column_name = {_text(h)}) AS \"{h}\"" for h in _HEADERS) + " FROM cr_summary_data_temp GROUP BY pdf_name, section_name, row_num")


# forms, records and narratives over derived pages (no SQL form: sequential searches, nested JSON)

_PAGE = ["pdf_name", "page_num"]
_add("form_tables", lambda s, d: forms.form_tables(frames.form_tokens(s, d), _PAGE).drop("column_no"), frames.FORM_SQL)
_add("section_bands", lambda s, d: forms.section_bands(frames.form_tokens(s, d), _PAGE), frames.BANDS_SQL)
_add("form_documents", lambda s, d: forms.flattened_forms(forms.form_documents(forms.form_tables(frames.form_tokens(s, d), _PAGE), _PAGE), _PAGE), frames.FORM_SQL)
_add("report_personnel", lambda s, d: records.report_personnel(records.personnel_cells(frames.report_words(s, d))), frames.PERSONNEL_SQL)
_add("report_incidents", lambda s, d: records.report_incidents(records.incident_lines(frames.report_words(s, d))), frames.INCIDENTS_SQL)
_add("report_records", lambda s, d: records.report_records(frames.report_words(s, d)), None)
_add("report_issues", lambda s, d: records.report_issues(frames.report_words(s, d, F.col("page_num").cast("bigint"))), frames.ISSUES_SQL)
_add("digest_narratives", lambda s, d: narratives.digest_narratives(frames.digest_words(s, d)), frames.DIGESTS_SQL)
_add("complaint_narratives", lambda s, d: narratives.complaint_narratives(frames.complaint_words(s, d)), None)


def _labelled(spark, sf_dir):
    feats = features.feature_strings(features.shape_features(frames.document_page_lines(spark, sf_dir)).select(*features.LINE, "y0_bin", "has_colon", "has_digits", "has_caps"), features.LINE)
    state = spark.createDataFrame([("has_caps=true", "heading", 2.0), ("has_caps=false", "body", 1.0), ("has_digits=[0,1]", "body", 0.5), ("y0_bin=[0,0.5]", "heading", 1.0)], "feature string, label string, weight double")
    step = spark.createDataFrame([("heading", "body", 0.7), ("body", "body", 0.4), ("heading", "heading", -0.5)], "label_from string, label_to string, weight double")
    return sequence_model.label_lines(feats, ["docid", "docpg"], "line_id", state, step)


_add("labelled_lines", _labelled, None)

# files written from the tables and read back

for _name, _build in source_queries.queries().items():
    _add(_name, _build, source_queries.oracle_sql(_ORACLE["pages_per_batch"])[_name])
