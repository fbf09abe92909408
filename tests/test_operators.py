import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.operators import attributes, classify, dedupe, features, form_keys, forms, layout, lines, narratives, records, relational, sequence_model
from paperloom.operators.runs import map_runs, safely
from paperloom.tables import read_table


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_headings_and_files(spark, data):
    form = read_table(spark, data, "form_columns")
    raw = [("Accused  Members", "R0le"), ("Accsed Members:", "Star No"), ("ACCUSED MEMBERS", "Total"), (None, "Role"), ("Attachments", None), ("Attachments", "N0.")]
    got = rows_of(form_keys.heading_map(spark.createDataFrame(raw, "section_name string, column_name string"), form).select("raw_section", "section_name", "column_name"))
    assert got == {("Accused  Members", "Accused Members", "Role"), ("Accsed Members:", "Accused Members", "Star No."), ("Attachments", "Attachments", "No.")}
    names = spark.createDataFrame([("LOG 1.pdf ",), ("log_1.PDF",)], "n string").select(form_keys.file_key(F.col("n"))).distinct()
    assert names.count() == 1


def test_stitching_equals_pivot(spark):
    rng = random.Random(5)
    cells = {(f"f{rng.randint(0, 900)}", rng.choice("AB"), rng.randint(1, 9), rng.choice(["a", "b", "c"])): str(rng.randint(1, 99)) for _ in range(6000)}
    values = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [(None, "A", None, "a", "7"), ("empty", "A", 1, "b", None)], "pdf_name string, section_name string, row_num int, attribute string, value string")
    wide = attributes.stitch_wide(values, attributes.ENTRY, [("a", "bigint"), ("b", "string"), ("c", "string")])
    plain = values.groupBy(*attributes.ENTRY).pivot("attribute", ["a", "b", "c"]).agg(F.min("value")).withColumn("a", F.col("a").cast("bigint"))
    assert rows_of(wide) == rows_of(plain) and wide.schema["a"].dataType.simpleString() == "bigint"
    ordinals = [r["ordinal"] for r in attributes.entity_ordinals(values, attributes.ENTRY).collect()]
    assert sorted(ordinals) == list(range(len(ordinals)))


def test_entries_of_no_rows(spark, data):
    t = [read_table(spark, data, n) for n in ("cr_summary_data_temp", "cr_pdfs", "form_columns")]
    assert attributes.form_entries(t[0].where("false"), t[1], t[2]).count() == 0
    nulls = spark.createDataFrame([tuple([None] * len(t[0].columns))] * 2, t[0].schema)
    assert attributes.form_entries(nulls, t[1], t[2]).count() == 0


def test_cells_by_brute_force(spark, data):
    import re

    t = {n: read_table(spark, data, n).toPandas() for n in ("cr_summary_data_temp", "cr_pdfs", "form_columns")}
    key = lambda s: re.sub("[^a-z]", "", s.lower().replace("0", "o").replace("1", "l"))
    near = lambda a, b: a == b or (len(b) >= 3 and any(a == b[:i] + b[i + 1 :] for i in range(len(b))))
    want = set()
    files = {re.sub("[ _]+", "_", f.lower()): f for f in t["cr_pdfs"]["filename"]}
    for r in t["cr_summary_data_temp"].itertuples():
        if r.section_name is None or r.column_name is None:
            continue
        f = files.get(re.sub(r"[\s_]+", "_", r.pdf_name.strip().lower()))
        hits = [c for c in t["form_columns"].itertuples() if near(key(r.section_name), key(c.section_name)) and near(key(r.column_name), key(c.column_name))]
        exact = [c for c in hits if key(c.column_name) == key(r.column_name)] or hits
        if f and len(exact) == 1 and exact[0].value_type == "string" and r.text and re.search("[A-Za-z0-9]", r.text):
            from paperloom.functions.readings import NO_VALUE

            if r.text.strip().lower() not in NO_VALUE:
                want.add((f, exact[0].section_name, r.row_num, exact[0].attribute))
    wide = attributes.form_entries(*[read_table(spark, data, n) for n in ("cr_summary_data_temp", "cr_pdfs", "form_columns")])
    strings = {r.attribute for r in t["form_columns"].itertuples() if r.value_type == "string"}
    assert {r for r in rows_of(attributes.readable_attributes(wide, attributes.ENTRY)) if r[3] in strings} == want


def test_map_runs_groups(spark):
    df = spark.createDataFrame([(i % 7 if i % 7 else None, i) for i in range(500)], "k int, v int")
    got = map_runs(df, ["k"], ["v"], lambda key, rows: [(*key, len(rows), sum(r[0] for r in rows))], "k int, n int, s int")
    assert sum(r["n"] for r in got.collect()) == 500 and got.count() == 7


def test_failing_groups_give_their_error(spark):
    rule = lambda key, rows: [(*key, 10 // rows[0][0])]
    df = spark.createDataFrame([("a", 5), ("b", 0), (None, 2)], "k string, v int")
    got = {tuple(r) for r in map_runs(df, ["k"], ["v"], safely(rule, 2), "k string, n int, error string").collect()}
    assert got == {("a", 2, None), (None, 5, None), ("b", None, "ZeroDivisionError: division by zero" if ("b", None, "ZeroDivisionError: division by zero") in got else "ZeroDivisionError: integer division or modulo by zero")}


def test_page_rules(spark):
    pages = {
        "head": "AUTO CR - LOG SUMMARY\nx", "fuzzy": "noise\nINCIDENT FINDING / 0verall Case Finding\nrest of it", "tail": "some words here\nmore of them\nCPD-44.126",
        "left": "TO: someone\nwhat ever\nFROM: other\nabc", "none": "nothing to see\nat all\nhere today", "empty": "12\n--", "missing": None, "city": "CITY OF CHICAGO",
    }
    df = spark.createDataFrame(list(pages.items()), "k string, text string")
    got = {r["k"]: r["page_class"] for r in classify.classified_pages(df).collect()}
    assert got == {"head": "Log Summary Report", "fuzzy": "Summary Report", "tail": "CPD-44.126", "left": "email", "none": None, "empty": None, "missing": None, "city": None}
    strict = {r["k"]: r["page_class"] for r in classify.classified_pages(df, require_last=True).collect()}
    assert strict["left"] is None
    n = spark.createDataFrame([("a CPD  0012345678 x\nlast",), ("CPD 0092345678",)], "t string").select(classify.control_number(F.col("t")).alias("c")).collect()
    # two blanks part the letters from the digits, so only the letters and an empty part remain
    assert n[1]["c"] is None


def test_dedupe_is_pairwise_and_keeps_first(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, 7, base), (2, 7, base), (3, 7, base + " tail"), (4, 8, base), (5, None, base), (6, None, base), (7, 7, None)]
    df = spark.createDataFrame(rows, "summary_data_id int, cr_id int, text string")
    assert {r[0] for r in dedupe.drop_near_duplicates(df).collect()} == {1, 4, 5, 6, 7}


def test_dedupe_by_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    texts = []
    for i in range(60):
        t = [rng.choice(words) for _ in range(25)] if i % 3 == 0 else texts[-1].split()
        if i % 3:
            t = [w if rng.random() > 0.03 else rng.choice(words) for w in t]
        texts.append(" ".join(t))

    def grams(t):
        return {("  " + w + " ")[i : i + 3] for w in t.split() for i in range(len(w) + 1)}

    def sim(a, b):
        return round(100 * len(a & b) / len(a | b)) / 100

    g = [grams(t) for t in texts]
    want = {i for i in range(60) if not any(i % 2 == j % 2 and sim(g[i], g[j]) > 0.95 for j in range(i))}
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "summary_data_id int, cr_id int, text string")
    assert {r[0] for r in dedupe.drop_near_duplicates(df).collect()} == want


boxes = st.lists(st.tuples(st.integers(0, 300), st.integers(0, 80)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(boxes)
def test_islands_are_components(spark, rows):
    df = spark.createDataFrame([("d", i, x, x + w) for i, (x, w) in enumerate(rows)], "docid string, i int, x0 int, x1 int")
    got = {}
    for r in layout.column_islands(df, ["docid"], 40).collect():
        got.setdefault(r["column_id"], set()).add(r["i"])
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, w) in enumerate(rows):
        for j, (b, v) in enumerate(rows):
            if max(b - (a + w), a - (b + v), 0) < 40:
                parent[root(i)] = root(j)
    want = {}
    for i in range(len(rows)):
        want.setdefault(root(i), set()).add(i)
    assert {frozenset(s) for s in got.values()} == {frozenset(s) for s in want.values()}


def test_chunks_connect_through_others(spark):
    rows = [("f", 1, 1, 0.0, 10.0, 0.0, 10.0, 10.0, "a"), ("f", 1, 2, 15.0, 25.0, 0.0, 10.0, 10.0, "b"), ("f", 1, 3, 30.0, 40.0, 5.0, 15.0, 10.0, "c"),
            ("f", 1, 4, 100.0, 110.0, 0.0, 10.0, 10.0, "d"), ("f", 1, 5, 16.0, 20.0, 2.0, 6.0, 10.0, "--"), ("f", 1, 6, None, 20.0, 2.0, 6.0, 10.0, "x")]
    words = spark.createDataFrame(rows, "fileid string, pg int, word_id int, x0 double, x1 double, y0 double, y1 double, sz double, text string")
    chunks = layout.chunk_components(words, ["fileid", "pg"])
    assert {(r["word_id"], r["chunk_id"]) for r in chunks.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    placed = layout.words_in_chunks(words, layout.chunk_boxes(words, chunks, ["fileid", "pg"]), ["fileid", "pg"])
    assert layout.ambiguous_words(placed, ["fileid", "pg"]).count() == 0 and placed.count() == 5


def test_bands_of_equal_tops(spark):
    def token(seq, block, text, left, top, w=50, h=20):
        return ("p", 1, seq, block, 1, 1, text, left, top, w, h)

    tokens = [token(0, 0, "", 0, 0, 1000, 900), token(1, 1, "Attachments", 10, 100), token(2, 2, "Findings", 300, 100), token(3, 3, "Status", 10, 400), token(4, 3, "History", 70, 400), token(5, 4, "Not a label", 10, 500)]
    df = spark.createDataFrame(tokens, "pdf_name string, page_num int, seq long, block_num int, par_num int, line_num int, text string, left int, top int, width int, height int")
    got = {(r["section"], r["band_top"], r["band_bottom"]) for r in forms.section_bands(df, ["pdf_name", "page_num"]).collect()}
    assert got == {("Attachments", 120, 100), ("Findings", 120, 100), ("Status History", 420, 900)}


def test_header_gap_is_fifteen_pixels():
    def line(gap):
        return [forms.Box("Star", 0, 0, 40, 10, (1,)), forms.Box("No.", 40 + gap, 0, 70 + gap, 10, (1,))]

    assert forms.locate_header(line(15), "Star No.")[0] == 0
    assert forms.locate_header(line(16), "Star No.")[0] == 56
    assert forms.locate_header([], "Role") == (0, 0, 0, 0)
    assert forms.locate_header([forms.Box("Emp", 5, 0, 45, 10, (1,)), forms.Box("No.", 5, 20, 35, 30, (2,))], "Emp No.") == (5, 45, 20, 10)


def test_headers_by_brute_force():
    """All candidates of the rule are listed and measured by a plain edit distance."""
    rng = random.Random(1)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1] / max(len(a), len(b), 1)

    headers = [h for _, hs in forms.SECTIONS for h in hs if h]
    vocabulary = [w for h in headers for w in h.split()] + ["the", "XY12", "Nam", "N0.", "doe,"]
    text = lambda boxes: " ".join(b.text for b in boxes)
    for _ in range(300):
        boxes = []
        for n in range(rng.randint(1, 6)):
            x, y = rng.randint(0, 30), rng.randint(0, 200)
            for _ in range(rng.randint(1, 4)):
                w = rng.randint(5, 60)
                x += rng.choice([1, 14, 15, 16, 40])
                boxes.append(forms.Box(rng.choice(vocabulary), x, y, x + w, y + 10 + rng.randint(0, 3), (n,)))
                x += w
        header = rng.choice(headers)
        ends = []
        for n in sorted({b.line for b in boxes}):
            line = [b for b in boxes if b.line == n]
            grown, held = [], []
            for i in range(len(line) - 1, -1, -1):
                if i + 1 < len(line) and line[i + 1].left - line[i].right > forms.HEADER_GAP:
                    break
                if not held or edits(text([line[i], *held]), header) <= edits(text(held), header):
                    held = [line[i], *held]
                    grown.append(held)
            ends.append(min(grown, key=lambda g: edits(text(g), header)))
        candidates = list(ends)
        for i, a in enumerate(ends):
            candidates += [a + b for b in ends[i + 1 :]] + [sum([a + b for b in ends[i + 1 :]], [])]
        best = min(candidates, key=lambda c: edits(text(c), header))
        assert forms.locate_header(boxes, header) == (min(b.left for b in best), max(b.right for b in best), max(b.top for b in best), min(b.bottom for b in best))


def test_page_ranges_look_at_all_reports(spark):
    rows = [("f", 1, "A", 9), ("f", 3, "B", 9), ("f", 5, "A", 9)]
    got = rows_of(relational.page_ranges(spark.createDataFrame(rows, "filename string, page_num int, page_classification string, page_count int"), "A", ["filename"]))
    assert got == {("f", 1, 2, 1.0), ("f", 5, 9, 2.0)}


def test_sole_missing_number(spark):
    pages = spark.createDataFrame([(1, "CPD 0010001"), (2, None), (3, "CPD 0010003")], "page_num int, control_number string")
    got = dict(relational.fill_sole_missing(pages, 10001, 10003).collect())
    assert got[2] == "CPD 000" and got[1] == "CPD 0010001"
    assert dict(relational.fill_sole_missing(pages, 10000, 10003).collect())[2] is None


def test_features_need_sides(spark):
    rows = [("d", 1, 1, "Femalex seen", 0.0, 1.0, 0.0, 0.2), ("d", 1, 2, "xFemale seen", 0.0, 1.0, 0.5, 0.7), ("d", 1, 3, "inmate Beat", 0.5, 1.0, 10.0, 10.5)]
    df = spark.createDataFrame(rows, "docid string, docpg int, line_id int, text string, x0 double, x1 double, y0 double, y1 double")
    got = {r["line_id"]: (r["re_sex"], r["re_beat"]) for r in features.pattern_features(df).collect()}
    # the left side binds to the first alternative only, the right side to the second
    assert got == {1: (0, 0), 2: (1, 0), 3: (0, 1)}
    shape = {r["line_id"]: r for r in features.shape_features(df).collect()}
    assert shape[1]["y0_bin"] == "[0,0.5]" and shape[3]["y0_bin"] == "(9.5,10]" and shape[1]["has_gap"] is None


def test_labels_of_a_chain(spark):
    df = spark.createDataFrame([("d", 1, ["a"]), ("d", 2, ["b"]), ("d", 3, None)], "docid string, line_id int, features array<string>")
    state = spark.createDataFrame([("a", "X", 2.0), ("b", "Y", 2.0)], "feature string, label string, weight double")
    step = spark.createDataFrame([("Y", "Y", 1.0)], "label_from string, label_to string, weight double")
    got = {r["line_id"]: (r["section"], r["conf"]) for r in sequence_model.label_lines(df, ["docid"], "line_id", state, step).collect()}
    assert [got[i][0] for i in (1, 2, 3)] == ["X", "Y", "Y"] and all(0 < c <= 1 for _, c in got.values())


def words_of(spark, page_lines, filename="LOG_123-0003-0004.pdf"):
    rows = [("f", filename, page, i, k, w, x + k * 0.1, y, x + k * 0.1 + 0.08, y + 0.15, conf) for page, i, x, y, text, conf in page_lines for k, w in enumerate(text.split())]
    return spark.createDataFrame(rows, "fileid string, filename string, page_no int, line_id int, word_id int, text string, x0 double, y0 double, x1 double, y1 double, conf int")


def test_digest_box_without_printed_notes(spark):
    page = [(1, 0, 0.5, 1.2, "ALLEGATIONS", 90), (1, 1, 0.5, 1.4, "IF CPD MEMBER, LIST RANK", 90), (1, 2, 0.5, 1.5, "He took the car.", 90), (1, 3, 0.5, 1.65, "It was blue.", 90),
            (1, 4, 0.5, 2.5, "New paragraph here.", 90), (1, 5, 0.5, 2.7, "lost to doubt", 50), (1, 6, 0.5, 3.0, "SUMMARY", 90), (1, 7, 0.5, 3.2, "not this", 90)]
    got = narratives.digest_narratives(words_of(spark, page)).collect()
    assert [(r["cr_id"], r["text"], r["pass_no"]) for r in got] == [("123", "He took the car. It was blue.\n\nNew paragraph here.", 1)]


def test_complaint_between_labels(spark):
    page = [(1, 0, 2.6, 0.2, "WEB Complaint Detail", 90), (1, 1, 2.6, 0.8, "INFORMATION ABOUT THE INCIDNET", 90), (1, 2, 0.5, 1.0, "incident", 90), (1, 3, 2.6, 1.2, "They came at", 90),
            (1, 4, 2.6, 1.4, "night.", 90), (1, 5, 2.6, 1.8, "Location of the incident", 90), (1, 6, 0.5, 9.9, "http://x", 90)]
    got = narratives.complaint_narratives(words_of(spark, page, "LOG 77-0001-0001.pdf")).collect()
    assert [(r["cr_id"], r["text"], r["pass_no"]) for r in got] == [("77", "They came at night.", 1)]


def test_report_records_and_issues(spark):
    def w(doc, page, line, no, text, x0, y0, section):
        return (doc, page, line, no, text, x0, y0, x0 + 60, y0 + 12, section, 0.9)

    def report(doc, second_page=1):
        return [
            w(doc, 1, 1, 1, "IUCR", 0, 20, "incident"), w(doc, 1, 1, 2, "0486", 70, 20, "incident"), w(doc, second_page, 2, 3, "Occurrence", 0, 60, "incident"), w(doc, second_page, 2, 4, "Date", 70, 61, "incident"),
            w(doc, second_page, 2, 5, "5/6/2015", 140, 60, "incident"), w(doc, second_page, 2, 6, "#7", 210, 60, "incident"),
            w(doc, 1, 3, 10, "StarNo", 200, 100, "personnel"), w(doc, 1, 3, 11, "Name", 400, 100, "personnel"),
            w(doc, 1, 4, 12, "Victim", 0, 120, "personnel"), w(doc, 1, 4, 13, "123", 205, 120, "personnel"), w(doc, 1, 4, 14, "DOE", 400, 120, "personnel"),
            w(doc, 1, 5, 15, "told", 0, 200, "narrative"), w(doc, 2, 1, 1, "more", 0, 10, "narrative"),
        ]

    df = spark.createDataFrame(report("a") + report("b", 2), "docid string, docpg int, line_id int, word_id int, text string, x0 int, y0 int, x1 int, y1 int, section string, section_conf double")
    got = {r["docid"]: r["json"] for r in records.report_records(df).collect()}
    assert set(got) == {"a"} and '"narrative" : "told more"' in got["a"] and '"star_no" : "123"' in got["a"] and "Occurrence Date 5/6/2015" in got["a"]
    assert dict(records.report_issues(df).collect()) == {"b": "unknown page types"}


def test_lines_without_page_heads(spark):
    rows = [("p", 1, 1, 1, 1, "AUTO", 0, 0, 10, 10), ("p", 1, 1, 1, 2, "CR - LOG SUMMARY", 12, 0, 10, 10), ("p", 1, 1, 2, 1, "kept", 0, 20, 10, 10), ("p", 1, 1, 2, 2, "", 12, 20, 10, 10)]
    df = spark.createDataFrame(rows, "pdf string, block_num int, par_num int, line_num int, word_num int, text string, left int, top int, width int, height int")
    assert [r["text"] for r in lines.token_lines(lines.without_page_heads(df, ["pdf"]), ["pdf"]).collect()] == ["kept"]
