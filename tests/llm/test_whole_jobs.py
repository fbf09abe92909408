"""Operators read their whole input: brute force on small tables."""

import random
from collections import Counter
from itertools import permutations

from paperloom.functions import text as tx
from paperloom.llm import name_variants, page_noise, places
from paperloom.tables import read_table


def test_spellings_of_a_crowded_block_by_brute_force(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 9))) for _ in range(900)})
    counts = {w: rng.randint(1, 40) for w in words}
    up = {}
    for w in words:
        near = [o for o in words if (counts[o], o) > (counts[w], w) and max(len(o), len(w)) >= 5 and abs(len(o) - len(w)) <= 1 and tx.osa(o, w) == 1]
        if near:
            up[w] = max(near, key=lambda o: (counts[o], o))
    want = {}
    for w in words:
        head = w
        for _ in range(3):
            head = up.get(head, head)
        want[w] = head
    names = spark.createDataFrame([(0, w, n) for w, n in counts.items()], "all int, name string, n long")
    assert {r["name"]: r["head"] for r in places.spelling_heads(names, ["all"]).collect()} == want


def test_header_of_one_unit_is_found_among_any_number_of_texts(spark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("bar", "con", "del", "fen", "gor", "hal") for b in ("ton", "mer", "vic", "sal", "dun")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    unit = [(f"a{i:07x}", f"{prose(8)}\nUnit Seven Desk Copy {i}\n{prose(8)}.") for i in range(10)]
    # an opening that copies share, and one that prose wraps behind, are no headers
    opening = [(f"b{i:07x}", f"{prose(8)}\nThe caller added that {rng.choice(vocabulary)} {prose(3)}\n{prose(8)}. The caller added that\n{prose(5)}. {prose(2)} The caller added that {prose(2)}.") for i in range(10)]
    copies = [(f"c{i:07x}", f"Then came the clerk\nShe Saw The Box and the\n{prose(8)}.") for i in range(10)]
    others = [(f"d{i:07x}", f"{prose(6)}\n{prose(6)}.") for i in range(3000)]
    cells = spark.createDataFrame([], "row_id long, column_name string, text string")
    for more in ([], others):
        extract = spark.createDataFrame(unit + opening + copies + more, "docid string, narrative string")
        texts = page_noise.distinct_texts(page_noise.scanned_texts(extract, cells))
        assert [r["mask"] for r in page_noise.furniture_templates(texts).collect()] == ["Unit Seven Desk Copy #"]


def test_organisations_are_compared_on_all_words():
    org = lambda words: {"kind": "o", "rest": words.split(), "suffix": ""}
    long = "harbor quarter velvet lantern copper meadow"
    assert name_variants._fit(org(f"{long} bakery"), org(f"{long} foundry")) is None
    assert name_variants._fit(org(f"{long} bakery"), org(f"bakery {long}")) is not None and name_variants._fit(org(f"{long} bakery"), org(long)) is not None


def test_assignments_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 4)
        costs = [[rng.choice([0.0, 0.1, 0.3, 0.55, 1e6]) for _ in range(rng.randint(n, 5))]]
        costs += [[rng.choice([0.0, 0.1, 0.3, 0.55, 1e6]) for _ in costs[0]] for _ in range(n - 1)]
        chosen = name_variants.optimal_assignment(costs)
        total = lambda at: sum(costs[i][k] for i, k in enumerate(at))
        assert len(set(chosen)) == n and abs(total(chosen) - min(map(total, permutations(range(len(costs[0])), n)))) < 1e-6


def test_crowded_or_short_house_numbers_and_crossings(spark):
    """House numbers of any length, streets of a crossing with their types, towns by the streets they stand behind."""
    streets = ["Alder", "Birch", "Cedar", "Dogwood", "Elder", "Fir"]
    raw = ["12 W Main St", "12 West Main Street", "7 E Oak Ave", "7 e. oak avenue #3", "45 N State St 60601", "45 STATE STREET", "12 57th St", "57 St, 12",
           "Main St & Oak Ave", "Oak St and Main Ave", "corner of Oak Ave and Main St", "MAIN / OAK AVE", "19 Oak, Evanston", "19 Oak", "1234567 Oak St"]
    rows = [(i, r, None) for i, r in enumerate(raw)] + [(100 + i, f"{900 + 3 * i} {s} St, Evanston", None) for i, s in enumerate(streets)]
    df = spark.createDataFrame(rows, "sl_id long, address string, address_of_incident string")
    got = {tuple(r) for r in places.same_places(df).collect()}
    assert got == {(0, 1), (2, 3), (4, 5), (6, 7), (8, 10), (8, 11), (10, 11), (12, 13)}
    # more rows of other towns change no town
    more = spark.createDataFrame([(1000 + i, f"{i} Lake{i % 40}mere Ave, Fairview", None) for i in range(3000)], df.schema)
    assert {tuple(r) for r in places.same_places(df.unionByName(more)).collect() if r["sl_id_a"] < 1000} == got


def test_classes_hold_the_links_of_the_pairs(spark, data):
    logs = read_table(spark, data, "summary_logs")
    pairs = [tuple(r) for r in places.same_places(logs).collect()]
    links = Counter(x for p in pairs for x in p)
    classes = places.place_classes(logs).collect()
    assert {r["sl_id"]: r["links"] for r in classes if r["links"]} == dict(links) and len({r["sl_id"] for r in classes}) == len(classes)
    of = {r["sl_id"]: r["class_id"] for r in classes}
    assert all(of[a] == of[b] for a, b in pairs)
    pairs = [tuple(r) for r in name_variants.same_names(logs).collect()]
    classes = name_variants.name_classes(logs).collect()
    of = {}
    for r in classes:
        of.setdefault(r["sl_id"], set()).add((r["key"], r["class_id"]))
    assert pairs and all(of[a] & of[b] for a, b in pairs)
    assert {r["sl_id"] for r in classes if r["links"]} == {x for p in pairs for x in p}


def _named(spark, names, key="LOG_1000001.pdf"):
    rows = [(i, *(n if isinstance(n, tuple) else (key, n)), None, None) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "sl_id long, pdf_name string, party_name string, accused_name string, star_no string")
    return {tuple(r) for r in name_variants.same_names(df).collect()}


def test_names_of_any_order_length_and_nickname(spark):
    names = ["Smith, Michael", "Smith, Mike", "Garcia, Daniel", "Garcia, Daniela", "Carmen Lopez Maria", "Lopez, Maria del Carmen", "Alpha Beta Gamma Delta Epsilon Zeta Inc", "Alpha Beta Gamma Delta Epsilon Zeta Omega Inc",
             "Smith, B.", "Smith, Robert B", "Smith, Robert C"]
    more = [("LOG_1000002.pdf", n) for n in ("Garcia, Anna", "Smith, Jo", "Lopez, Eva", "Garcia, Mary", "Smith, Ann")]
    got = _named(spark, names + more)
    # Omega is a word more of the same firm; an initial keeps its place
    assert got == {(0, 1), (4, 5), (6, 7)}


def test_short_forms_are_learned_from_meetings(spark):
    names = []
    for k, family in enumerate(["Kornesova", "Belvikski", "Tormorley", "Hanrudeck"]):
        names += [(f"LOG_10000{k:02d}.pdf", f"{family}, Bartolomew"), (f"LOG_10000{k:02d}.pdf", f"{family}, Bato")]
        names += [(f"LOG_20000{k:02d}.pdf", f"{family}, {g}") for g in ("Bartolomew", "Ines", "Ulla", "Petra")[: k + 1]]
    names += [("LOG_3000000.pdf", "Wenmorath, Bartolomew"), ("LOG_3000000.pdf", "Bato Wenmorath"), ("LOG_3000000.pdf", "Wenmorath, Ines")]
    got = _named(spark, names)
    n = len(names)
    assert (n - 3, n - 2) in got and not any(x == n - 1 for p in got for x in p)
