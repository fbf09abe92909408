"""Against brute force, exact round trips and held-out rows."""

import base64
import random
import re
from collections import Counter

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperloom.llm import leakage, name_variants, near_copies, page_noise, personal_data, places, reading_level, survivors, tokenize
from paperloom.tables import read_table


def test_ids_equal_a_public_encoder(spark, data):
    import tiktoken

    with open(f"{tokenize.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    public = tiktoken.Encoding("own", pat_str=tokenize.PRETOKEN, mergeable_ranks=ranks, special_tokens={})
    docs = read_table(spark, data, "documents").toPandas().set_index("doc_id")["text"]
    for r in tokenize.token_ids(read_table(spark, data, "documents")).collect():
        assert r["ids"] == public.encode_ordinary(docs[r["doc_id"]] or "")
    mine = tokenize.PrefixEncoder(f"{tokenize.TOKENIZERS}/byte_bpe_50k.tiktoken")
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab cd.éüß漢字😀\n\t'stre12­") for _ in range(rng.randint(0, 80)))
        assert mine.ids(text) == public.encode_ordinary(text)


def test_leaks_by_brute_force(spark, data):
    docs, items = read_table(spark, data, "documents"), read_table(spark, data, "eval_items")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    runs = {}
    for r in items.collect():
        w = words(r["text"])
        for i in range(len(w) - 11):
            runs.setdefault(tuple(w[i : i + 12]), set()).add(r["item_id"])
    want = set()
    for r in docs.collect():
        w = words(r["text"])
        for i in range(len(w) - 11):
            want |= {(r["doc_id"], m) for m in runs.get(tuple(w[i : i + 12]), ())}
    assert {tuple(r) for r in leakage.leaks_found(docs, items).collect()} == want


def test_changed_slots_must_be_consistent(spark):
    items = spark.createDataFrame([(1, "on day 25 the clerk counted 25 boxes and sent 7 of them back to the archive"), (2, "so the baker Vilma met Oskar near the old mill and gave Vilma his coat at ten"), (3, None), (4, "too short")], "item_id long, text string")
    texts = [
        "On day 25, the clerk counted 25 boxes and sent 7 of them back!", "on day 31 the clerk counted 31 boxes and sent 9 of", "on day 31 the clerk counted 32 boxes and sent 9 of", "on day 25 the clerk counted", None, "",
        "so the baker oskar met vilma near the old mill and gave oskar his coat at ten", "so the baker oskar met vilma near the old mill and gave vilma his coat at ten", "so the baker Petra met Oskar near the old mill and gave Petra his coat at ten",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {tuple(r) for r in leakage.leaked_windows(docs, items).collect()}
    # windows of the sixth end in names that aren't changed back; Petra is no name of the items
    assert got == {(0, 1, 3, 0), (1, 1, 0, 1), (6, 2, 0, 6)} | {r for r in got if r[0] == 7}
    assert all(r[2] == 0 and r[3] < 6 for r in got if r[0] == 7)


def test_a_full_map_loses_no_leak(spark, data, monkeypatch):
    docs, items = read_table(spark, data, "documents"), read_table(spark, data, "eval_items")
    want = {tuple(r) for r in leakage.leaked_windows(docs, items).collect()}
    monkeypatch.setattr(leakage, "BITS", 64)
    assert {tuple(r) for r in leakage.leaked_windows(docs, items).collect()} == want and want


def test_levels_of_held_out_samples(spark, data):
    rows = [(r["grade"], r["text"]) for r in read_table(spark, data, "graded_samples").orderBy("sample_id").collect()]
    right = 0
    for fold in range(4):
        model = reading_level.LevelModel([r for i, r in enumerate(rows) if i // 4 % 4 != fold])
        right += sum(model.level(t) == g for i, (g, t) in enumerate(rows) if i // 4 % 4 == fold)
    assert right >= 0.95 * len(rows)
    model = reading_level.LevelModel(rows)
    assert model.level("") == 1 and model.level("zzz qqq") == 1
    docs = spark.createDataFrame([(1, "I saw a red door. " * 10, "en"), (2, "I saw a red door. " * 10, "EN"), (3, "I saw", "en"), (4, None, "en")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in reading_level.reading_levels(docs, read_table(spark, data, "graded_samples")).collect()] == [(1, 1)]


def test_near_copies_by_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = []
    for i in range(120):
        if i % 4 == 0:
            texts.append([rng.choice(vocabulary) for _ in range(rng.randint(28, 70))])
        else:
            base = list(texts[i - i % 4])
            for _ in range(rng.randint(0, 7)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append(base + ["end", "of", "entry"] * rng.randint(0, 1))
    rows = spark.createDataFrame([(i, f"f{i % 50}", " ".join(t), len(t)) for i, t in enumerate(texts) if len(t) >= near_copies.LEAST_WORDS], "row_id long, file string, words string, n_words int")
    members, links = near_copies.class_links(rows)
    cid = {r["row_id"]: r["cid"] for r in members.collect()}
    got = {frozenset((r["cid_a"], r["cid_b"])) for r in links.collect()}
    kept = [i for i, t in enumerate(texts) if len(t) >= near_copies.LEAST_WORDS]
    want = {frozenset((cid[a], cid[b])) for a in kept for b in kept if a < b and cid[a] != cid[b] and near_copies.share_of_longer(texts[a], texts[b]) >= 0.7}
    assert got == want and want


def test_hot_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        t = list(base)
        t[i] = f"x{i}"
        texts.append(" ".join(t))
    rows = spark.createDataFrame([(i, f"f{i}", t, 60) for i, t in enumerate(texts)], "row_id long, file string, words string, n_words int")
    _, links = near_copies.class_links(rows)
    assert links.count() == 40 * 39 // 2


def test_texts_that_repeat_a_stretch_lose_no_partner(spark):
    """A longer text that repeats one shared stretch passes the share at a Jaccard of a fifth."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randint(0, 5000)}"
    texts = []
    for _ in range(25):
        stretch = [word() for _ in range(12)]
        texts.append(stretch * 6 + [word() for _ in range(12)])
        texts.append([word() for _ in range(30)] + stretch + [word() for _ in range(20)])
    rows = spark.createDataFrame([(i, f"f{i}", " ".join(t), len(t)) for i, t in enumerate(texts)], "row_id long, file string, words string, n_words int")
    members, links = near_copies.class_links(rows)
    cid = {r["row_id"]: r["cid"] for r in members.collect()}
    got = {frozenset((r["cid_a"], r["cid_b"])) for r in links.collect()}
    assert got == {frozenset((cid[2 * i], cid[2 * i + 1])) for i in range(25)}


def test_share_counts_the_longer_text_with_repeats():
    a, b = "a b c a b c a b c x".split(), "a b c a b c".split()
    assert near_copies.share_of_longer(a, b) == pytest.approx(7 / 8)


def test_noise_by_hand(spark):
    good = "the accused person followed the witness toward the corner store during the afternoon and the officer recorded it near the station"
    rows = [(f"{i:08x}", f"{good} {i}") for i in range(30)]
    pages = [("a0000001", "the accus€d person fol-\nlowed the witness\nCASE FILE COPY 7\ntoward the comer store\n- 3 -\nduring the off-\nduty after-\nnoon."), ("a0000002", "the officer rec0rded it\nCASE FILE COPY 8\nnear the station"),
             ("a0000003", "the witness\nCASE FILE COPY 9\nrecorded"), ("a0000004", "the person\nCASE FILE COPY 10\nfollowed the off-duty officer"), ("a0000005", None), ("a0000006", " ")]
    extract = spark.createDataFrame(rows + [(f"b{i:07x}", f"copy {i} of an off-duty corner afternoon followed") for i in range(20)] + pages, "docid string, narrative string")
    cells = spark.createDataFrame([(9, "Remarks", "it was re-\r\ncorded"), (10, "Name", "acc€sed")], "row_id long, column_name string, text string")
    got = {tuple(r) for r in page_noise.noise_found(extract, cells).collect()}
    want = {
        ("report_extract", "a0000001", "misread", "accused"), ("report_extract", "a0000001", "misread", "corner"), ("report_extract", "a0000001", "split", "followed"),
        ("report_extract", "a0000001", "split", "off-duty"), ("report_extract", "a0000001", "split", "afternoon"), ("report_extract", "a0000001", "furniture", "- 3 -"),
        ("report_extract", "a0000002", "misread", "recorded"), ("cr_summary_data_temp", "9", "split", "recorded"),
    } | {("report_extract", f"a000000{i}", "furniture", f"CASE FILE COPY {n}") for i, n in ((1, 7), (2, 8), (3, 9), (4, 10))}
    assert got == want
    texts = {r["rec_id"]: r["text"] for r in page_noise.repaired_texts(extract, cells).collect()}
    assert texts["a0000001"] == "the accused person followed the witness toward the corner store during the off-duty afternoon."


def test_words_beside_decide_between_two_frequent_forms(spark):
    rows = [(f"a{i:07x}", f"he stood at the corner store number {i}") for i in range(40)] + [(f"b{i:07x}", f"a late comer {i} was sent away") for i in range(12)]
    rows += [("c0000001", "she waited at the comer store that day"), ("c0000002", "a late comer was let in"), ("c0000003", "one corner was dark")]
    extract = spark.createDataFrame(rows, "docid string, narrative string")
    cells = spark.createDataFrame([], "row_id long, column_name string, text string")
    got = {tuple(r) for r in page_noise.noise_found(extract, cells).collect()}
    assert got == {("report_extract", "c0000001", "misread", "corner")}
    texts = {r["rec_id"]: r["text"] for r in page_noise.repaired_texts(extract, cells).collect()}
    assert texts["c0000001"] == "she waited at the corner store that day" and texts["c0000002"] == "a late comer was let in"


def test_best_of_cells_by_hand(spark, data):
    form = read_table(spark, data, "form_columns")
    pdfs = spark.createDataFrame([(1, "LOG_1.pdf")], "id long, filename string")
    pages = spark.createDataFrame([(1, 1), (1, 2)], "pdf_id long, page_num int")
    t = lambda day: datetime(2020, 1, day)
    cell = ("Accused Members", "Name", 1)
    rows = [
        (5, "LOG_1.pdf", 1, *cell, "DOE, JOHN", t(1)), (3, "log_1.PDF ", 9, *cell, "DOE, JOHN", t(2)), (7, "LOG 1.pdf", 2, *cell, "??", t(3)), (8, "LOG_1.pdf", None, *cell, None, t(4)),
        (20, "LOG_1.pdf", 1, "Accused Members", "Role", 1, "Witness", t(1)), (21, "LOG_1.pdf", None, "Accused Members", "Role", 2, "--", t(1)), (22, "LOG_1.pdf", 7, "Accused Members", "Role", 2, None, t(1)),
        (30, "LOG_1.pdf", 1, "Accused Members", "Total", 1, "x", t(1)), (31, "LOG_1.pdf", 1, "Accused Members", "Total", 1, "x", t(1)),
        (40, "LOG_1.pdf", 1, "Accused Members", "Status", 1, "Active", t(1)), (41, "LOG_1.pdf", 1, "Accused Members", "Status", 1, "Active", t(1)),
    ]
    cells = spark.createDataFrame(rows, "row_id long, pdf_name string, page_num int, section_name string, column_name string, row_num int, text string, loaded_at timestamp_ntz")
    none = spark.createDataFrame([], "docid string, narrative string")
    got = {tuple(r) for r in survivors.best_of_cells(cells, pdfs, pages, form, none).collect()}
    assert got == {(3, 3, 2), (21, None, None), (40, 41, 1)}


def test_layers_are_dominance_depths(spark):
    day = lambda d: datetime(2020, 1, d)
    rows = [(1, 1, 10, day(1), 1, True, 1), (1, 1, 9, day(2), 2, False, 1), (1, 0, 12, day(3), 3, False, 1), (1, 0, 9, day(1), 4, False, 1)]
    # the last load has the best text but no page, the one before a page the file lacks
    rows += [(2, 1, 5, day(1), 11, True, 7), (2, 1, 5, day(2), 12, True, 3), (2, 1, 6, day(4), 13, False, None), (2, 0, 2, day(3), 14, False, 99), (3, 1, 0, day(1), 21, False, None)]
    df = spark.createDataFrame(rows, "g int, trust int, complete int, loaded_at timestamp_ntz, row_id long, page_ok boolean, page_num int")
    got = {r["g"]: r for r in survivors.layered_cells(df, ["g"]).collect()}
    assert {x["entry"]["row_id"]: x["layer"] for x in got[1]["texts"]} == {1: 1, 2: 1, 3: 1, 4: 2}
    assert {x["entry"]["row_id"]: x["layer"] for x in got[2]["pages"]} == {13: 1, 12: 2} and {x["entry"]["row_id"]: x["layer"] for x in got[2]["texts"]} == {13: 1, 14: 2, 12: 2}
    picks = survivors.layered_cells(df, ["g"]).select("g", survivors.survivor(F.col("texts"), "has_text", ["trust", "complete", "loaded_at", "row_id"])["row_id"], survivors.survivor(F.col("pages"), "page_ok", ["loaded_at", "row_id"])["page_num"])
    # the page of the second group comes from its second layer: no plain maximum of the first has it
    assert {tuple(r) for r in picks.collect()} == {(1, 1, 1), (2, 13, 3), (3, None, None)}


def test_name_pairs_by_hand(spark):
    names = ["KORNESOVA, RICHARD", "Dick Kornesova", "R. Kornseova", "Officer Kornesova", "Kornesova, Anna", "Ana B. Torrudath Jr.", "TORRUDATH, ANA, SR", "Torrudath, Ana B Jr", "UNKNOWN", "Unknown ", None,
             "The Redlantern Auto Inc", "Redlantern Auto", "REDLANTERN AUT. INCORPORATED"]
    rows = [(i, "LOG_1000001.pdf", n, None) for i, n in enumerate(names)] + [(50, "BUNDLE.pdf", "Rick Kornesova", "9"), (51, "BUNDLE.pdf", "RICHARD KORNESOVA", "9"), (52, "BUNDLE.pdf", "Zoe Xylander", None)]
    rows += [(60 + i, f"LOG_20000{i:02d}.pdf", n, None) for i, n in enumerate(["Kornesova, Richard", "Richard Kornesova", "TORRUDATH, ANA", "KORNESOVA, ANNA", "Redlantern Auto Co."])]
    df = spark.createDataFrame([(a, b, c, None, d) for a, b, c, d in rows], "sl_id long, pdf_name string, party_name string, accused_name string, star_no string")
    got = {tuple(r) for r in name_variants.same_names(df).collect()}
    assert got == {(a, b) for a in range(4) for b in range(4) if a < b} | {(5, 7), (11, 12), (11, 13), (12, 13), (50, 51)}


def test_address_pairs_by_hand(spark):
    places_ = ["12541 S. Ruskgrove Blvd", "Ruskgrove Boulevard So., 12541, Apt 3", "12541 RUSKGORVE BLVD", "12541 N Ruskgrove Blvd", "12514 S Ruskgrove Blvd", "7048l Fifty-Seventh St", "70481 57th Street, #2", "125XX Ruskgrove Boulevard",
               "Corner of Gorrvale Pl and Elmlow", "ELMLOW / GORRVALE", "UNKNOWN", "", None, "12541 S. Ruskgrove Blvd", "12541 S Ruskgrove Rd"]
    df = spark.createDataFrame([(i, a if i % 2 else None, None if i % 2 else a) for i, a in enumerate(places_)], "sl_id long, address string, address_of_incident string")
    got = {tuple(r) for r in places.same_places(df).collect()}
    assert got == {(0, 1), (0, 2), (1, 2), (1, 13), (2, 13), (5, 6), (8, 9)}


_FULL = ["{t} {g} {s} came to the desk.", "{s}, {g} was heard first.", "Nobody had asked {g} {s} about it.", "A note by {i}. {s} lay on the table."]
_LATER = ["The clerk wrote to {s} again.", "After that {s} went home.", "It was {s} who paid."]
_NEW_LATER = ["Cars followed {s} slowly.", "Where {s} lived nobody could say.", "Some blamed {s} for all of it."]
_OTHER = [
    ("They can be reached at {x} at noon.", "phone", lambda r: r.choice(["({a}) 555-{b}", "{a}-555-{b}", "{a}.555.{b}", "555-{b}"]).format(a=r.randint(200, 989), b=r.randint(1000, 9999))),
    ("The mail went to {x} twice.", "email", lambda r: f"{r.choice('abcdefg')}{r.choice(['lopez', 'novak', 'chen'])}{r.randint(1, 99)}@{r.choice(['post', 'mail'])}.example"),
    ("Her SSN {x} was on the card.", "idnum", lambda r: f"{r.randint(100, 899)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"),
    ("The van stood at {x} all night.", "address", lambda r: f"{r.randint(10, 99999)} {r.choice(['N', 'S.', 'West'])} {_name(r)} {r.choice(['St', 'Ave', 'Blvd'])}"),
    ("The meter read {x} then.", "", lambda r: str(r.randint(100000000, 899999999))), ("They drove from {x} in the rain.", "", lambda r: _name(r)), ("Rain fell on {x} for days.", "", lambda r: _name(r)), ("All of {x} was dark.", "", lambda r: _name(r)), ("Star {x} was seen.", "", lambda r: str(r.randint(1000, 9999))),
]


def _name(r):
    return "".join(r.choice(["bar", "del", "mor", "kes", "vin", "sol", "tra"]) + r.choice(["ak", "en", "is", "ou"]) for _ in range(2)).capitalize()


def _planted(r, later):
    """A text, its planted (kind, stretch)s, and the surnames planted in later sentences."""
    given = ["Anna", "Boris", "Carla", "Dmitri", "Elena", "Frank", "Greta", "Hugo", "Ines", "Jonas"]
    parts, truth, again = [], set(), set()
    for _ in range(2):
        g, s = r.choice(given), _name(r)
        form = r.choice(_FULL)
        parts.append(form.format(t=r.choice(["Officer", "Dr.", "Sgt."]), g=g, s=s, i=g[0]))
        truth.add(("name", f"{s}, {g}" if form.startswith("{s},") else f"{g[0]}. {s}" if "{i}" in form else f"{g} {s}"))
        form, kind, make = r.choice(_OTHER)
        x = make(r)
        parts.append(form.format(x=x))
        if kind:
            truth.add((kind, x))
        parts.append(r.choice(later).format(s=s))
        truth.add(("name", s))
        again.add(("name", s))
    return " ".join(parts), truth, again


def test_planted_stretches_of_held_out_texts():
    """The truth is planted here; names are new in the held-out texts, and so are the sentences
    of later mentions in the second round, where the skip edges have to carry the label."""
    rng = random.Random(11)
    field = personal_data.SkipChain().fit([_planted(rng, _LATER)[0] for _ in range(500)])

    def measured(later):
        texts = [_planted(random.Random(1000 + i), later) for i in range(200)]
        got = [{(k, t[a:b]) for a, b, k in found} for (t, _, _), found in zip(texts, field.stretches([t for t, _, _ in texts]))]
        share = lambda which: sum(len(x[which] & g) for x, g in zip(texts, got)) / sum(len(x[which]) for x in texts)
        return share(1), share(2), sum(len(x[1] & g) for x, g in zip(texts, got)) / sum(map(len, got))

    found, _, right = measured(_LATER)
    assert found >= 0.98 and right >= 0.98, (found, right)
    with_skips = measured(_NEW_LATER)[1]
    field.skip[:] = 0
    without = measured(_NEW_LATER)[1]
    assert with_skips > without + 0.02 and with_skips >= 0.9, (with_skips, without)


def test_stretches_in_sentences_of_other_kinds(spark):
    """Fitted on the test tables, forms and titled or full names are found in any sentence."""
    texts = [t for t in read_table(spark, "/root/testdata/sf0.1", "report_extract").select("narrative").toPandas()["narrative"] if t]
    field = personal_data.SkipChain().fit(texts[: personal_data.MOST_TRAINING])
    told = {
        "The clerk called 312-555-0188 on Monday.": "312-555-0188", "Write to tom.becker@example.org for the file.": "tom.becker@example.org", "Her number 123-45-6789 stood on it.": "123-45-6789",
        "Everyone knew Walter Greene by sight.": "Walter Greene", "The form lists Ms. Dana Whitfield as a contact.": "Dana Whitfield", "GARCIA, Daniel owns the shop.": "GARCIA, Daniel", "She moved to 123 E. Oak Street, Apt 4, Evanston last year.": "123 E. Oak Street, Apt 4, Evanston",
        "We heard that 45 N State St was shut.": "45 N State St", "Driver's license B123-4567-8901 was his.": "B123-4567-8901", "One reaches them by (773) 555-0199 only.": "(773) 555-0199",
    }
    found = [{t[a:b] for a, b, _ in s} for t, s in zip(told, field.stretches(list(told)))]
    missed = [w for w, f in zip(told.values(), found) if w not in f]
    assert len(missed) <= 1, (missed, found)


def test_masking_keeps_the_rest(spark):
    text = "Present were Mr. Walter Korgelski and a baker. Calls to (211) 555-0140 were not answered. Korgelski left."
    many = spark.createDataFrame([(f"{i:08x}", text.replace("0140", f"{1000 + i}")) for i in range(60)] + [("null", None), ("empty", "")], "docid string, narrative string")
    got = {r["docid"]: r["narrative"] for r in personal_data.masked_texts(many).collect()}
    assert got["00000003"] == "Present were Mr. [NAME] and a baker. Calls to [PHONE] were not answered. [NAME] left."
    assert got["null"] is None and got["empty"] == ""
    assert F is not None
