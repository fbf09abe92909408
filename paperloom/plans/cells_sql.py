"""DuckDB form of the resolved form cells and of their readable values."""

from __future__ import annotations

from paperloom.functions.readings import MONTHS, NO_VALUE

_KEY = "regexp_replace(translate(lower({0}), '01', 'ol'), '[^a-z]', '', 'g')"
_NEAREST = "(d = 0 OR (d = 1 AND length(rk) >= 3))"

#: CTEs ending in ``c3``: the right section and column of each written pair of headings of the form.
HEADINGS = f"""
  raw AS (SELECT DISTINCT section_name rs, column_name rc FROM cr_summary_data_temp WHERE section_name IS NOT NULL AND column_name IS NOT NULL),
  s1 AS (SELECT rs, section_name, levenshtein({_KEY.format('rs')}, {_KEY.format('section_name')}) d, {_KEY.format('section_name')} rk FROM (SELECT DISTINCT rs FROM raw), (SELECT DISTINCT section_name FROM form_columns)),
  s2 AS (SELECT *, min(d) OVER (PARTITION BY rs) m FROM s1 WHERE {_NEAREST}),
  s3 AS (SELECT rs, min(section_name) section_name FROM s2 WHERE d = m GROUP BY rs HAVING count(*) = 1),
  c1 AS (SELECT rs, rc, f.section_name, f.column_name, levenshtein({_KEY.format('rc')}, {_KEY.format('f.column_name')}) d, {_KEY.format('f.column_name')} rk FROM raw JOIN s3 USING (rs) JOIN form_columns f ON f.section_name = s3.section_name),
  c2 AS (SELECT *, min(d) OVER (PARTITION BY rs, rc) m FROM c1 WHERE {_NEAREST}),
  c3 AS (SELECT rs, rc, min(section_name) section_name, min(column_name) column_name FROM c2 WHERE d = m GROUP BY rs, rc HAVING count(*) = 1)"""
#: t (cr_summary_data_temp) names the file p (cr_pdfs).
SAME_FILE = r"regexp_replace(lower(trim(regexp_replace(t.pdf_name, '\s+', ' ', 'g'))), '[ _]+', '_', 'g') = regexp_replace(lower(trim(p.filename)), '[ _]+', '_', 'g')"
#: CTEs ending in ``cells``: the rows of cr_summary_data_temp that belong to a cell.
CELLS = f"""{HEADINGS},
  cells AS (SELECT t.row_id, p.filename pdf_name, p.id pdf_id, c3.section_name, c3.column_name, t.row_num, t.page_num, t.text, t.loaded_at, f.attribute, f.value_type
    FROM cr_summary_data_temp t JOIN c3 ON t.section_name = c3.rs AND t.column_name = c3.rc JOIN form_columns f ON f.section_name = c3.section_name AND f.column_name = c3.column_name
    JOIN cr_pdfs p ON {SAME_FILE})
"""

_MARKS = ", ".join(f"'{m}'" for m in NO_VALUE)
_MONTH = "CASE " + " ".join(f"WHEN lower(m) = '{name}' THEN '{i:02d}'" for i, name in enumerate(MONTHS, 1)) + " WHEN regexp_matches(m, '^\\d+$') THEN lpad(m, 2, '0') END"
_CLOCK = r"(?:[ T]+(?:(\d{1,2}):(\d{2})(?::\d{2})?\s*([AaPp][Mm])?|(\d{2})(\d{2})\s*(?:hrs|hours)))?$"
_DATE = r"^(\d{4})-(\d{1,2}|[A-Za-z]{3})-(\d{1,2})"

READABLE = f"""
  WITH {CELLS},
  v AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') t FROM cells WHERE text IS NOT NULL),
  w AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t, '^(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}})', '\\3-\\1-\\2'), '^(\\d{{1,2}})[- ]([A-Za-z]{{3}})[a-z]*[- ](\\d{{4}})', '\\3-\\2-\\1'),
    '^([A-Za-z]{{3}})[a-z]*\\.? (\\d{{1,2}}), ?(\\d{{4}})', '\\3-\\1-\\2') y FROM v WHERE regexp_matches(t, '[\\p{{L}}\\p{{N}}]') AND lower(t) NOT IN ({_MARKS})),
  x AS (SELECT *, regexp_extract(y, '{_DATE}', 2) m, regexp_matches(y, '{_DATE}{_CLOCK}') whole, regexp_extract(y, '{_DATE}{_CLOCK}', 4) h, regexp_extract(y, '{_DATE}{_CLOCK}', 5) mi, lower(regexp_extract(y, '{_DATE}{_CLOCK}', 6)) ap,
    regexp_extract(y, '{_DATE}{_CLOCK}', 7) h4, regexp_extract(y, '{_DATE}{_CLOCK}', 8) m4 FROM w),
  z AS (SELECT *, CASE WHEN whole THEN regexp_extract(y, '{_DATE}', 1) || '-' || ({_MONTH}) || '-' || lpad(regexp_extract(y, '{_DATE}', 3), 2, '0') END iso,
    CASE WHEN h <> '' THEN lpad(CAST(CASE ap WHEN 'pm' THEN CAST(h AS INTEGER) % 12 + 12 WHEN 'am' THEN CAST(h AS INTEGER) % 12 ELSE CAST(h AS INTEGER) END AS VARCHAR), 2, '0') || ':' || mi WHEN h4 <> '' THEN h4 || ':' || m4 ELSE '00:00' END clock FROM x)
  SELECT DISTINCT pdf_name, section_name, row_num, attribute FROM z WHERE CASE value_type WHEN 'string' THEN true
    WHEN 'int' THEN TRY_CAST(replace(regexp_extract(t, '^#?\\s*(\\d{{1,3}}(?:,\\d{{3}})+|\\d+)\\s*[A-Za-z.]*$', 1), ',', '') AS BIGINT) IS NOT NULL
    WHEN 'boolean' THEN lower(t) IN ('yes', 'no', 'y', 'n', 'true', 'false') WHEN 'date' THEN TRY_CAST(iso AS DATE) IS NOT NULL ELSE TRY_CAST(iso || ' ' || clock || ':00' AS TIMESTAMP) IS NOT NULL END
"""
