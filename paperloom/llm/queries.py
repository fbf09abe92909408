"""Registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import leakage, name_variants, near_copies, page_noise, personal_data, places, reading_level, survivors, tokenize
from paperloom.plans.cells_sql import CELLS
from paperloom.tables import read_table


def _tables(*names: str):
    def wrap(build):
        return lambda spark, sf_dir: build(*[read_table(spark, sf_dir, n) for n in names])

    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _tables("cr_summary_data_temp", "cr_pdfs", "cr_pdf_pages", "form_columns", "report_extract")(survivors.best_of_cells),
        "p2_found": _tables("report_extract", "cr_summary_data_temp")(page_noise.noise_found),
        "p2_repaired": _tables("report_extract", "cr_summary_data_temp")(page_noise.repaired_texts),
        "p4_found": _tables("cr_summary_data_temp", "cr_pdfs", "form_columns")(near_copies.near_copies),
        "p4_classes": _tables("cr_summary_data_temp", "cr_pdfs", "form_columns")(near_copies.copy_classes),
        "p5_found": _tables("report_extract")(personal_data.personal_stretches),
        "p5_masked": _tables("report_extract")(personal_data.masked_texts),
        "p6_found": _tables("summary_logs")(name_variants.same_names),
        "p6_classes": _tables("summary_logs")(name_variants.name_classes),
        "p7_found": _tables("summary_logs")(places.same_places),
        "p7_classes": _tables("summary_logs")(places.place_classes),
        "p8_ids": _tables("documents")(tokenize.token_ids),
        "p9_found": _tables("documents", "eval_items")(leakage.leaks_found),
        "p9_changed": _tables("documents", "eval_items")(leakage.leaked_windows),
        "p10_found": _tables("documents", "graded_samples")(reading_level.reading_levels),
    }


_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
_STATEMENTS = f"""
  WITH {CELLS},
  st AS (SELECT row_id, pdf_name, {_WORDS} w FROM cells WHERE text IS NOT NULL AND (section_name, column_name) IN (('Accused Members', 'Initial / Intake Allegation'), ('Current Allegations', 'Allegation'),
    ('Incident Finding / Overall Case Finding', 'Description of Incident'))),
  long AS (SELECT * FROM st WHERE len(w) >= 32)"""
_NEAR_COPIES = f"""{_STATEMENTS},
  tri AS (SELECT row_id, pdf_name, len(w) n, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] t FROM (SELECT *, unnest(range(1, len(w) - 1)) i FROM long)),
  one AS (SELECT DISTINCT row_id, pdf_name, n, t FROM tri),
  hit AS (SELECT a.row_id a, b.row_id b, count(*) / (any_value(a.n) - 2)::DOUBLE share FROM tri a JOIN one b ON a.t = b.t AND a.row_id <> b.row_id AND a.pdf_name <> b.pdf_name AND a.n >= b.n GROUP BY a.row_id, b.row_id)
  SELECT DISTINCT least(a, b) AS row_id_a, greatest(a, b) AS row_id_b FROM hit WHERE share >= 0.7
"""
_COPY_CLASSES = f"""{_STATEMENTS},
  cls AS (SELECT min(row_id) cid, w FROM long GROUP BY w),
  tri AS (SELECT cid, len(w) n, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] t FROM (SELECT *, unnest(range(1, len(w) - 1)) i FROM cls)),
  one AS (SELECT DISTINCT cid, n, t FROM tri),
  hit AS (SELECT a.cid a, b.cid b FROM tri a JOIN one b ON a.t = b.t AND a.cid <> b.cid AND a.n >= b.n GROUP BY a.cid, b.cid HAVING count(*) / (any_value(a.n) - 2)::DOUBLE >= 0.7),
  ends AS (SELECT x, count(DISTINCT y) links FROM (SELECT a x, b y FROM hit UNION SELECT b, a FROM hit) GROUP BY x)
  SELECT row_id, cid AS class_id, coalesce(links, 0) AS links FROM long JOIN cls USING (w) LEFT JOIN ends ON x = cid
"""


def _runs(key: str, table: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + 11], ' ') k FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) i FROM (SELECT {key}, {_WORDS} w FROM {table}))"


_LEAKS = f"WITH a AS ({_runs('doc_id', 'documents')}), b AS ({_runs('item_id', 'eval_items')}) SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (k)"


_UNITS = ", ".join(f"'{u}'" for u in sorted(leakage.UNITS))
_TEMPLATE = f"list_transform(w, lambda x: CASE WHEN regexp_matches(x, '\\p{{Nd}}') THEN '#num' WHEN x IN ({_UNITS}) THEN '#unit' WHEN list_contains(ns, x) THEN '#name' ELSE x END)"


def _windows(key: str, table: str) -> str:
    return f"SELECT {key}, array_to_string(t[i:i + 11], ' ') k, w[i:i + 11] v FROM (SELECT {key}, w, t, unnest(range(1, len(w) - 10)) i FROM (SELECT {key}, w, {_TEMPLATE} t FROM (SELECT {key}, {_WORDS} w, ns FROM {table}, (SELECT list(x) ns FROM names) WHERE {key} IS NOT NULL)))"


_CHANGED = f"""
  WITH raw AS (SELECT unnest(r) x, generate_subscripts(r, 1) i FROM (SELECT regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') r FROM eval_items)),
  names AS (SELECT lower(x) x FROM raw GROUP BY 1 HAVING bool_and(i > 1 AND left(x, 1) <> lower(left(x, 1)))),
  a AS ({_windows('doc_id', 'documents')}), b AS ({_windows('item_id', 'eval_items')}),
  m AS (SELECT doc_id, item_id, a.v = b.v exact, list_zip(a.v, b.v) z, a.v av, b.v bv FROM a JOIN b USING (k)),
  c AS (SELECT doc_id, item_id, exact, NOT exact AND len(list_distinct(z)) = len(list_distinct(av)) AND len(list_distinct(av)) = len(list_distinct(bv)) AS changed FROM m)
  SELECT doc_id, item_id, CAST(count(*) FILTER (exact) AS INTEGER) AS exact_windows, CAST(count(*) FILTER (changed) AS INTEGER) AS changed_windows FROM c WHERE exact OR changed GROUP BY doc_id, item_id"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it; the others are held against brute force in tests/llm."""
    return {"p4_found": _NEAR_COPIES, "p4_classes": _COPY_CLASSES, "p9_found": _LEAKS, "p9_changed": _CHANGED}
