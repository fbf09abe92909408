"""Same postal address written differently.

Addresses are cut into components (number, direction, street, type, town, postal code; or the
two streets of a crossing). Streets of one number are brought together by sorted-neighbourhood
passes in different component orders (by first letters, by last letters, by how often the
spelling occurs), neighbours are compared by an edit score that takes a transposition as one
edit, and numbers must agree strictly; units and floors are taken off first. Records of one
number and street, or of one pair of streets, are then divided by their directions, types, town
and postal code, a missing part going with the commonest place it fits.

Defined results: null and blank addresses, stand-ins and whole blocks denote no place; records
written as the same string are no pair but share their place; repeated rows are rows of their
own; ties of frequency go to the first in order; empty tables give empty results.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.form_keys import one_deletes
from paperloom.operators.pairs import linked_classes, unequal_pairs
from paperloom.operators.runs import map_runs
from paperloom.session import written
from paperloom.tables import spread

#: Neighbours each entry is compared with in every pass and order; crowded sides add an exact join.
WINDOW = 12
#: A tail that stands behind the types of LEAST_STREETS different streets is a town, or a slip of one that is
#: one edit away and TOWN_RATIO times as frequent. Towns go to every worker: MOST_TOWNS at most, an error beyond.
LEAST_STREETS, TOWN_RATIO, MOST_TOWNS = 5, 10, 200_000

#: Directions and street types as people write them.
DIRECTIONS = {"n": "n", "no": "n", "north": "n", "s": "s", "so": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w"}
TYPES = {
    "ave": "ave", "av": "ave", "avenue": "ave", "blvd": "blvd", "bl": "blvd", "boulevard": "blvd", "ct": "ct", "court": "ct",
    "dr": "dr", "drive": "dr", "pkwy": "pkwy", "pky": "pkwy", "parkway": "pkwy", "pl": "pl", "place": "pl", "rd": "rd", "road": "rd",
    "st": "st", "str": "st", "street": "st", "ln": "ln", "lane": "ln", "ter": "ter", "terrace": "ter", "hwy": "hwy", "highway": "hwy",
    "cir": "cir", "circle": "cir", "sq": "sq", "square": "sq", "way": "way",
}
ONES = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_ORDINAL = {w: i + 1 for i, w in enumerate(ONES)}
_ORDINAL |= {w[:-1] + "ieth": 10 * (i + 2) for i, w in enumerate(TENS)}
_UNIT = re.compile(r"\b(?:apt|apartment|unit|ste|suite|fl|floor|rm|room)\b\.?\s*#?\s*[a-z0-9]+\b|#\s*[a-z0-9]+\b")
_BLOCK = re.compile(r"\b\d+x{1,3}\b|\bblock\b")
_CROSS = re.compile(r"\s*(?:&|/|\band\b|\bat\b)\s*")
#: House numbers: plain ones of any length, or of three characters and more with letters misread for digits.
_NUMBERISH = re.compile(r"^(?:\d{1,6}|(?=.*\d)[\dolisb|]{3,6})$")
_STAND_IN = re.compile(r"^(?:unk(?:nown)?|refused|same as (?:above|below)|none|n/?a|not given|homeless|[^a-z0-9]*)$")


def _number(token: str) -> str:
    return token.translate(str.maketrans("olisb|", "011581")).lstrip("0") or "0"


def _street(tokens: list[str]) -> tuple[str, str, str]:
    """(direction, name, type) of the tokens of one street; the name has ordinals as digits."""
    direction = kind = ""
    name = []
    for i, t in enumerate(tokens):
        if t in DIRECTIONS and not direction and (len(tokens) > 1):
            direction = DIRECTIONS[t]
        elif t in TYPES and name and not kind:
            kind = TYPES[t]
        else:
            name.append(t)
    if not name and direction:
        name, direction = [direction], ""
    words = []
    for t in name:
        m = re.fullmatch(r"(\d+)(?:st|nd|rd|th)?", t)
        if m:
            words.append(m[1])
            continue
        head, _, tail = t.partition("-")
        if head in TENS and tail in _ORDINAL:
            words.append(str(10 * (TENS.index(head) + 2) + _ORDINAL[tail]))
        elif t in _ORDINAL:
            words.append(str(_ORDINAL[t]))
        else:
            words.append(t)
    if len(words) == 2 and words[0] in TENS and words[1].isdigit() and int(words[1]) < 10:
        words = [str(10 * (TENS.index(words[0]) + 2) + int(words[1]))]
    return direction, " ".join(words), kind


def _tokens(text: str) -> list[str]:
    return [t.strip("-'") for t in re.findall(r"[a-z0-9|'-]+", text) if t.strip("-'")]


def tail_of(raw: str | None) -> tuple[str, str] | None:
    """(tail, street): the words behind the street type at the end of an address, where a town
    stands, and those before it."""
    s = _UNIT.sub(" ", (raw or "").lower())
    tokens = _tokens(s)
    while tokens and re.fullmatch(r"\d{5}", tokens[-1]):
        tokens.pop()
    at = max((i for i, t in enumerate(tokens) if t in TYPES and i > 0), default=None)
    if at is None:
        return None
    tail = [t for t in tokens[at + 1 :]]
    while tail and tail[0] in DIRECTIONS:
        tail.pop(0)
    if not 1 <= len(tail) <= 3 or any(c.isdigit() for t in tail for c in t) or {"and", "at"} & set(tail):
        return None
    return " ".join(tail), " ".join(t for t in tokens[:at] if t not in DIRECTIONS and not t[0].isdigit())


def _without_town(s: str, towns: dict[str, str]) -> tuple[str, str]:
    """(town, the rest with a comma in its place): the longest run of up to three words that is a town
    and no street (no type behind it)."""
    found = list(re.finditer(r"[a-z][a-z'-]*", s))
    best = None
    for i in range(len(found)):
        for k in range(i, min(i + 3, len(found))):
            if k > i and s[found[k - 1].end() : found[k].start()].strip():
                break
            name = " ".join(m[0] for m in found[i : k + 1])
            typed = k + 1 < len(found) and found[k + 1][0] in TYPES and not s[found[k].end() : found[k + 1].start()].strip()
            if name in towns and not typed:
                size = (found[k].end() - found[i].start(), found[i].start())
                if best is None or size > best[0]:
                    best = (size, towns[name], found[i].start(), found[k].end())
    return (best[1], s[: best[2]] + " , " + s[best[3] :]) if best else ("", s)


def parse_place(raw: str | None, towns: dict[str, str]):
    """(kind, number, direction, name, type, town, zip, direction2, name2, type2) or None; kind b or
    x. ``towns`` has the right spelling of each written town."""
    s = re.sub(r"\s+", " ", (raw or "").lower()).strip()
    if _STAND_IN.match(s) or _BLOCK.search(s):
        return None
    town, s = _without_town(_UNIT.sub(" ", s), towns)
    tokens = _tokens(s)
    zip_code = ""
    numbers = [i for i, t in enumerate(tokens) if _NUMBERISH.match(t)]
    # one or two digits before a type, or behind other numbers, are a street's
    long = [i for i in numbers if len(tokens[i]) > 2] or [i for i in numbers if not (i + 1 < len(tokens) and tokens[i + 1] in TYPES)] or numbers
    if numbers and numbers[-1] == len(tokens) - 1 and re.fullmatch(r"\d{5}", tokens[-1]):
        named = any(t not in DIRECTIONS and t not in TYPES and not t[0].isdigit() for t in tokens)
        before = [i for i in numbers[:-1] if len(tokens[i]) > 2 or (named and tokens[i + 1] not in TYPES and not (i > 0 and tokens[i - 1] in DIRECTIONS))]
        if before:
            zip_code = tokens.pop()
            numbers.pop()
            long = [i for i in long if i < len(tokens)] or before
    cross = _CROSS.split(re.sub(r"^\s*(?:the\s+)?(?:corner of|corner|intersection of|intersection|int of)\s+", "", s))
    if len(cross) == 2 and not (long and long[0] == 0 and len(tokens[0]) > 2):
        sides = []
        for part in cross:
            direction, name, kind = _street([t for t in _tokens(part) if not re.fullmatch(r"\d{5}", t)])
            if not name:
                return None
            sides.append((name, direction, kind))
        (name, direction, kind), (name2, direction2, kind2) = sorted(sides)
        return "x", "", direction, name, kind, town, zip_code, direction2, name2, kind2
    if not numbers:
        return None
    at = long[0]
    direction, name, kind = _street(tokens[:at] + tokens[at + 1 :])
    if not name:
        return None
    return "b", _number(tokens[at]), direction, name, kind, town, zip_code, "", "", ""


_PARTS = "kind string, num string, dir string, name string, type string, town string, zip string, dir2 string, name2 string, type2 string"


def place_parts(addresses: DataFrame) -> DataFrame:
    """raw and its components, for each distinct address that denotes a place."""
    raw = addresses.select("raw").where(F.col("raw").isNotNull()).distinct()
    towns = written_towns(raw)

    def cut(batches):
        for batch in batches:
            got = [(r, *p) for r in batch["raw"] if (p := parse_place(r, towns)) is not None]
            yield pd.DataFrame(got, columns=["raw", "kind", "num", "dir", "name", "type", "town", "zip", "dir2", "name2", "type2"])

    return spread(raw).mapInPandas(cut, "raw string, " + _PARTS)


def written_towns(raw: DataFrame) -> dict[str, str]:
    """Each written town with its right spelling, learned from the tails of all addresses."""

    def tails(batches):
        for batch in batches:
            yield pd.DataFrame([t for r in batch["raw"] if (t := tail_of(r))], columns=["tail", "street"])

    seen = raw.mapInPandas(tails, "tail string, street string").groupBy("tail").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("street").alias("streets"))
    seen = written(seen.select("tail", "n", "streets", F.explode(one_deletes(F.col("tail"))).alias("part")))
    towns = seen.where(F.col("streets") >= LEAST_STREETS).select(F.col("tail").alias("town"), F.col("n").alias("m"), "part")
    slips = seen.join(towns, "part").where((F.col("m") >= F.col("n") * TOWN_RATIO) & (F.length("town") >= 5) & one_edit(F.col("tail"), F.col("town")))
    slips = slips.groupBy("tail").agg(F.max(F.struct("m", "town")).alias("to")).select("tail", F.col("to.town").alias("town"))
    rows = towns.select(F.col("town").alias("tail"), "town").distinct().join(slips.select("tail"), "tail", "left_anti").unionByName(slips).limit(MOST_TOWNS + 1).collect()
    if len(rows) > MOST_TOWNS:
        raise ValueError(f"more than {MOST_TOWNS} towns")
    to = {r["tail"]: r["town"] for r in rows}
    return {t: to.get(town, town) for t, town in to.items()}


def one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion, substitution or swap of neighbours apart."""
    swap = F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))) == b,
    )
    return (F.levenshtein(a, b, 1) >= 0) | ((F.length(a) == F.length(b)) & swap)


def spelling_heads(names: DataFrame, block: list[str], word: str = "name", count: str = "n") -> DataFrame:
    """block, word, head: the commonest spelling that each spelling within ``block`` stands for.

    ``names`` has one row per block and spelling with its count. Two sorted-neighbourhood
    passes, one within equal first and one within equal last two letters, each in two orders:
    by letters from that end (WINDOW entries on both sides) and by frequency (the WINDOW
    commonest). Sides with more spellings than the windows cover are also joined on one-letter
    deletions, so no spelling within one edit is missed: one edit spares the first or the last
    two letters. A spelling points at its commonest neighbour within
    one edit, pointers are followed twice. Numbers and words under five
    letters (the longer of two counts) have to agree wholly.
    """
    near = []
    for order_key in (F.col(word), F.reverse(F.col(word))):
        rows = names.withColumns({"side": F.substring(order_key, 1, 2), "along": order_key})
        by = Window.partitionBy(*block, "side")
        order = F.row_number().over(by.orderBy(F.desc(count), word))
        top = rows.withColumn("order", order).where(F.col("order") <= WINDOW).groupBy(*block, "side").agg(
            F.collect_list(F.struct(F.col(count).alias("n"), F.col(word).alias("w"))).alias("top")
        )
        nxt = F.collect_list(F.struct(F.col(count).alias("n"), F.col(word).alias("w"))).over(by.orderBy("along").rowsBetween(1, WINDOW))
        prv = F.collect_list(F.struct(F.col(count).alias("n"), F.col(word).alias("w"))).over(by.orderBy("along").rowsBetween(-WINDOW, -1))
        rows = rows.withColumns({"nxt": nxt, "prv": prv}).join(top, [*block, "side"])
        near.append(rows.select(*block, word, count, F.explode(F.array_distinct(F.concat("nxt", "prv", "top"))).alias("o")))
        # a crowded side reaches beyond its windows: there any two spellings one edit apart share a deletion
        crowded = names.withColumn("side", F.substring(order_key, 1, 2)).withColumn("held", F.count(F.lit(1)).over(Window.partitionBy(*block, "side")))
        crowded = crowded.where(F.col("held") > WINDOW + 1).select(*block, "side", word, count, F.explode(one_deletes(F.col(word))).alias("variant"))
        others = crowded.select(*block, "side", "variant", F.struct(F.col(count).alias("n"), F.col(word).alias("w")).alias("o"))
        near.append(crowded.join(others, [*block, "side", "variant"]).select(*block, word, count, "o"))
    pairs = reduce(DataFrame.unionByName, near).where((F.col("o.w") != F.col(word)) & (F.struct(F.col("o.n"), F.col("o.w")) > F.struct(F.col(count), F.col(word))))
    pairs = pairs.where((F.greatest(F.length(word), F.length("o.w")) >= 5) & ~F.col(word).rlike(r"^\d") & one_edit(F.col(word), F.col("o.w")))
    up = pairs.groupBy(*block, word).agg(F.max("o").alias("o")).select(*block, word, F.col("o.w").alias("head"))
    up = written(up)
    heads = names.select(*block, word).join(up, [*block, word], "left").withColumn("head", F.coalesce("head", word))
    step = up.select(*block, F.col(word).alias("head"), F.col("head").alias("next"))
    for _ in range(2):
        heads = heads.join(step, [*block, "head"], "left").withColumn("head", F.coalesce("next", "head")).drop("next")
    return heads.select(*block, word, "head")


def _divided(parts: list[str]):
    """A rule that gives the combinations of ``parts`` of one key their place (a counter): fullest
    first, each to the commonest place that has no other value in any part."""

    def rule(key: tuple, rows: list[tuple]) -> list[tuple]:
        rows = sorted(rows, key=lambda r: (-sum((1 if p in ("town", "zip") else 2) * (v != "") for p, v in zip(parts, r) if p != "town"), -r[-1], r[:-1]))
        places: list[dict] = []
        out = []
        for r in rows:
            own = dict(zip(parts, r))
            fits = [p for p in places if all(not v or not p[k] or p[k] == v for k, v in own.items())]
            if fits:
                best = max(fits, key=lambda p: p["n"])
                for k, v in own.items():
                    best[k] = best[k] or v
            else:
                best = {**own, "n": 0, "id": len(places)}
                places.append(best)
            best["n"] += r[-1]
            out.append((*key, *r[:-1], best["id"]))
        return out

    return rule


def _placed(rows: DataFrame, key: list[str], parts: list[str], mark: str) -> DataFrame:
    """raw, place_id of ``rows`` with key and parts. Combinations of parts are few, however many rows."""
    combos = rows.groupBy(*key, *parts).agg(F.sum("n").alias("n"))
    fields = ", ".join(f"{c} string" for c in [*key, *parts])
    told = map_runs(combos, key, [*parts, "n"], _divided(parts), f"{fields}, place int")
    return rows.join(told, [*key, *parts]).select("raw", F.concat_ws("|", F.lit(mark), *key, "place").alias("place_id"))


def address_places(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``raw``) that denote a place, with place_id; equal ids are one place."""
    counts = rows.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    parts = written(place_parts(rows).join(counts, "raw"))
    streets = parts.select(F.explode(F.array("name", "name2")).alias("name"), "n").where("name <> ''").groupBy("name").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    head = written(spelling_heads(streets, ["all"]).select("name", "head"))
    houses = parts.where("kind = 'b'")
    names = houses.groupBy("num", "name").agg(F.sum("n").alias("n"))
    # spellings of one number first; then slips that meet over a right spelling at other numbers
    local = spelling_heads(names, ["num"]).withColumnRenamed("head", "near").join(head.withColumnRenamed("name", "near"), "near").drop("near")
    houses = written(houses.join(local, ["num", "name"]))
    houses = _placed(houses, ["num", "head"], ["dir", "type", "town", "zip"], "b")
    crossings = parts.where("kind = 'x'")
    side = lambda h, k: F.struct(F.col(h).alias("h"), F.col(f"dir{k}").alias("d"), F.col(f"type{k}").alias("t"))
    crossings = crossings.join(head.withColumnRenamed("head", "h1"), "name").join(head.select(F.col("name").alias("name2"), F.col("head").alias("h2")), "name2")
    crossings = crossings.select("raw", "n", "town", "zip", F.least(side("h1", ""), side("h2", "2")).alias("a"), F.greatest(side("h1", ""), side("h2", "2")).alias("b"))
    crossings = crossings.select("raw", "n", "town", "zip", *[F.col(f"{x}.{y}").alias(f"{x}_{z}") for x in "ab" for y, z in (("h", "head"), ("d", "dir"), ("t", "type"))])
    crossings = _placed(crossings, ["a_head", "b_head"], ["a_dir", "a_type", "b_dir", "b_type", "town", "zip"], "x")
    return rows.join(houses.unionByName(crossings), "raw")


def place_rows(summary_logs: DataFrame) -> DataFrame:
    """sl_id, raw, place_id of the rows of summary_logs that denote a place."""
    blank = lambda c: F.when(F.trim(F.regexp_replace(c, r"\s+", " ")) != "", F.col(c))
    rows = summary_logs.select("sl_id", F.coalesce(blank("address_of_incident"), blank("address")).alias("raw")).where("raw is not null")
    return written(address_places(rows).select("sl_id", "raw", "place_id"))


def same_places(summary_logs: DataFrame) -> DataFrame:
    """sl_id_a, sl_id_b: rows of summary_logs that denote one place, written unequally."""
    return unequal_pairs(place_rows(summary_logs), "place_id", "raw", "sl_id", ("sl_id_a", "sl_id_b"))


def place_classes(summary_logs: DataFrame) -> DataFrame:
    """sl_id, class_id (smallest sl_id of the place), links: the rows it is linked to. One row per
    row that denotes a place; rows are not expanded into pairs."""
    return linked_classes(place_rows(summary_logs), "place_id", "raw", "sl_id")
