"""Variant spellings of the names of persons and organisations.

Every token of the names enters a symmetric-delete index: tokens that share a string with one
letter left out are neighbours, and those within one edit (a swap is one) point at the commonest
of them, unless both stand on their own. Roles of tokens (family name, given name, organisation
word) are counted over all names written with a comma or a legal form, and given names that keep
meeting in one family of one log or star are learned as formal and short form. Names of one log
or star and one family name (organisations: first word) are then aligned token by token: the
assignment of least cost decides, over all tokens of both names, where a token may meet an equal
one, its short form, its initial, or an abbreviation of it, and leaving its place costs. A name
that leaves parts out goes with the commonest entity it fits.

Defined results: null and blank names and stand-ins name nobody; rows written as the same
string are no pair but the same entity; repeated rows are rows of their own; names with
unequal suffixes, given names or middle initials differ; empty tables give empty results.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.places import one_edit
from paperloom.operators.form_keys import one_deletes
from paperloom.operators.pairs import linked_classes, unequal_pairs
from paperloom.operators.runs import map_runs
from paperloom.session import written
from paperloom.tables import spread

#: Shortest token that may be misspelt.
LEAST_LETTERS = 4

#: A spelling with OWN_ROWS rows stays on its own beside one that is less than OWN_RATIO times as frequent,
#: a given name that differs in its last vowel beside one less than VOWEL_RATIO times as frequent.
OWN_ROWS, OWN_RATIO, VOWEL_RATIO = 5, 4, 20
#: Families in which two given names must meet to be learned as one, and the share of the rarer one's meetings.
LEAST_FAMILIES, LEAST_MET = 3, 0.5

#: Formal given names and the short forms in common use for them.
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alec sandy", "andrew": "andy drew", "barbara": "barb babs", "benjamin": "ben benny", "catherine": "cathy cate",
    "christine": "chrissy tina", "christopher": "topher", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "donald": "don donny",
    "frederick": "fred freddy", "gerald": "gerry", "gregory": "greg", "henry": "hank", "jacob": "jake", "jeffrey": "jeff", "jennifer": "jen jenny",
    "jessica": "jess jessie", "john": "jack johnny", "joseph": "joe joey", "joshua": "josh", "kenneth": "ken kenny", "lawrence": "larry", "matthew": "matt",
    "michael": "mike mick mikey", "nicholas": "nick nicky", "pamela": "pam", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky becca",
    "ronald": "ron ronny", "stephen": "steve stevie", "steven": "steve", "susan": "suzie", "thomas": "tom tommy", "timothy": "tim timmy", "virginia": "ginny",
    "alexandra": "sandra alex lexi sasha sandy", "anthony": "tony", "beatriz": "bea trixie triz", "charles": "charlie chuck chas",
    "desmond": "des desi dez", "dorothy": "dot dottie dolly", "edward": "ed eddie ned ward", "elizabeth": "liz beth betty eliza lizzie betsy libby",
    "francisco": "frank paco pancho cisco", "gabriela": "gaby gabi gabby", "harold": "hal harry", "ignacio": "nacho iggy",
    "james": "jim jimmy jamie", "josephine": "josie jo", "katherine": "kate kathy katie kat kay kit", "krzysztof": "kris krzys chris krzysiek",
    "leonard": "len lenny leo", "malgorzata": "gosia malgosia", "margaret": "meg peggy maggie marge", "nathaniel": "nat nate nathan",
    "olivia": "liv livvy ollie", "patricia": "trish pat patty tricia", "quentin": "quent quin", "richard": "rick rich dick ricky richie",
    "robert": "bob bobby rob robbie", "rosalind": "roz ros", "samuel": "sam sammy", "susannah": "sue susie suzy sukie",
    "theodore": "ted teddy theo", "ulysses": "uly", "vernon": "vern", "victoria": "tori vicky vicki", "walter": "walt wally",
    "william": "will bill billy willy liam", "yolanda": "yoli yola", "zachary": "zach zack zak",
}
FORMAL = {short: formal for formal, shorts in NICKNAMES.items() for short in shorts.split()} | {f: f for f in NICKNAMES}
#: Titles, suffixes, legal forms and stand-ins.
TITLES = frozenset("officer off ofc po det detective sgt sergeant lt lieutenant capt captain cmdr mr mrs ms miss dr agent the".split())
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "2", "iii": "3", "iv": "4"}
LEGAL = frozenset("inc incorporated co company compny corp corporation ltd limited llc assn assoc association service services svc svcs".split())
STAND_INS = frozenset("unknown|unk|anonymous|refused|none|na|n a|not given|not available|same|same as above|see narrative|john doe|jane doe|citizen|not listed|illegible|pending|redacted".split("|"))


def name_tokens(raw: str | None) -> list[tuple[str, int]]:
    """(token, role) in written order; role 0 plain, 1 before a comma, 2 behind it, 3 suffix,
    4 legal form, 5 abbreviated with a point. Titles are left out; stand-ins have no tokens."""
    s = re.sub(r"\bp\.\s?o\.", "po", re.sub(r"\s+", " ", (raw or "").lower()).strip())
    if re.sub(r"[^a-z ]", "", s).strip() in STAND_INS or not re.search(r"[a-z]", s):
        return []
    out, behind, comma = [], False, False
    for t in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?|,", s):
        if t == ",":
            comma = behind = True
            continue
        bare = t.rstrip(".")
        if bare in TITLES:
            continue
        if bare in SUFFIXES and out:
            out.append((bare, 3))
        elif bare in LEGAL and out:
            out.append((bare, 4))
        else:
            out.append((bare, 2 if behind else 5 if t.endswith(".") and len(bare) > 2 else 0))
    if comma and any(r == 2 for _, r in out):
        out = [(t, 1 if r in (0, 5) else r) for t, r in out]
    return out


def token_heads(tokens: DataFrame) -> DataFrame:
    """token, head: the commonest spelling each token stands for. ``tokens`` has token, n (rows) and
    giv (rows in which it stands as a given name)."""
    long = tokens.where(F.length("token") >= LEAST_LETTERS)
    index = written(long.select("token", "n", "giv", F.explode(one_deletes(F.col("token"))).alias("part")))
    a, b = index.alias("a"), index.alias("b")
    stem = lambda c: F.regexp_replace(c, "[aeiouy]$", "")
    other = (stem("a.token") == stem("b.token")) & (2 * F.col("b.giv") > F.col("b.n"))
    alone = ((OWN_RATIO * F.col("a.n") > F.col("b.n")) & (F.col("a.n") >= OWN_ROWS)) | ((VOWEL_RATIO * F.col("a.n") > F.col("b.n")) & other)
    near = (
        a.join(b, (F.col("a.part") == F.col("b.part")) & (F.struct("b.n", "b.token") > F.struct("a.n", "a.token")))
        .where(~F.col("a.token").isin(*FORMAL) & ~alone & one_edit(F.col("a.token"), F.col("b.token")))
        .groupBy(F.col("a.token").alias("token"))
        .agg(F.max(F.struct(F.col("b.n").alias("n"), F.col("b.token").alias("t"))).alias("up"))
        .select("token", F.col("up.t").alias("head"))
    )
    near = written(near)
    again = near.select(F.col("token").alias("head"), F.col("head").alias("next"))
    for _ in range(2):
        near = near.join(again, "head", "left").select("token", F.coalesce("next", "head").alias("head"))
    return tokens.select("token").join(near, "token", "left").withColumn("head", F.coalesce("head", "token"))


def learned_forms(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """head, formal: given names that stand for a commoner one, learned from names with a comma.

    Two given names that meet under one family name in one log or star, in LEAST_FAMILIES
    different families and in a share LEAST_MET of the families in which the rarer meets any other, are
    one name if they share the first letter or two in a row; relatives meet with any given name. The distinct given names of a family in a log
    or star are few.
    """
    said = tokens.where("role in (1, 2)").groupBy("raw").agg(
        F.min_by("head", F.when(F.col("role") == 1, F.col("i"))).alias("family"), F.min_by("head", F.when(F.col("role") == 2, F.col("i"))).alias("given")
    ).where("family is not null and length(given) > 1")
    met = written(rows.select("raw", "key").join(said, "raw").groupBy("key", "family", "given").agg(F.count(F.lit(1)).alias("n")))
    counts = met.groupBy("given").agg(F.sum("n").alias("n"))
    a, b = met.alias("a"), met.alias("b")
    both = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.family") == F.col("b.family")) & (F.col("a.given") != F.col("b.given")))
    both = written(both.select("a.family", F.col("a.given").alias("given"), F.col("b.given").alias("other")).distinct())
    any_other = both.groupBy("given").agg(F.count_distinct("family").alias("families"))
    pairs = both.groupBy("given", "other").agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= LEAST_FAMILIES)
    pairs = pairs.join(any_other, "given").where(F.col("together") >= F.col("families") * LEAST_MET)
    two = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(2)))
    pairs = pairs.where((F.left("given", F.lit(1)) == F.left("other", F.lit(1))) | F.arrays_overlap(two("given"), two("other")))
    pairs = pairs.join(counts, "given").join(counts.select(F.col("given").alias("other"), F.col("n").alias("m")), "other").where(F.struct("m", "other") > F.struct("n", "given"))
    return pairs.groupBy(F.col("given").alias("head")).agg(F.max(F.struct("together", "m", "other")).alias("best")).select("head", F.col("best.other").alias("formal"))


def _parse(tokens: list[tuple[str, int, str, int, int, int, str]]):
    """(kind, family, rest, suffix) of a name's tokens with heads, role counts and formal forms; of
    organisations the family is the first word. ``rest`` are tokens joined by blanks."""
    suffix = next((SUFFIXES[t] for t, role, *_ in tokens if role == 3), "")
    legal = any(role == 4 for _, role, *_ in tokens)
    plain = [x for x in tokens if x[1] not in (3, 4)]
    if not plain:
        return None
    org = legal or (len(plain) > 1 and sum(x[5] for x in plain) > sum(x[3] + x[4] for x in plain))
    if org:
        words = [x[2] for x in plain]
        return "o", words[0], " ".join(words[1:]), ""
    family = [x for x in plain if x[1] == 1]
    rest = [x for x in plain if x[1] == 2]
    if not rest:

        def familiar(i: int) -> tuple:
            t, _, head, fam, giv, _, formal = plain[i]
            return (len(t) > 1, formal == head and head not in FORMAL and t not in FORMAL, fam >= giv, i == len(plain) - 1)

        at = max(range(len(plain)), key=familiar)
        family, rest = [plain[at]], plain[:at] + plain[at + 1 :]
    elif not family:
        family, rest = rest[-1:], rest[:-1]
    return "p", " ".join(x[2] for x in family), " ".join(x[6] for x in rest), suffix


#: Costs of the assignment: a short form, an abbreviation, an initial, a place left, a token without a partner.
SHORT, ABBREVIATED, INITIAL, MOVED, ALONE = 0.1, 0.2, 0.3, 0.05, 0.5
_NEVER = 1e6


def token_cost(a: str, b: str, given: bool = False) -> float | None:
    """Cost of aligning two given names or organisation words; None if they can't be the same."""
    if a == b:
        return 0.0
    fa, fb = FORMAL.get(a, a), FORMAL.get(b, b)
    if fa == fb:
        return SHORT
    short, long = (fa, fb) if len(fa) <= len(fb) else (fb, fa)
    if len(short) == 1:
        return INITIAL if long[0] == short else None
    # a whole given name, or one that lacks a last vowel, is no abbreviation (Daniel, Daniela)
    another = given and (short in NICKNAMES or (len(short) == len(long) - 1 and long[-1] in "aeiouy"))
    return ABBREVIATED if len(short) >= 3 and long.startswith(short) and not another else None


def optimal_assignment(costs: list[list[float]]) -> list[int]:
    """Column of each row in the assignment of least total cost (rows at most columns), by shortest
    augmenting paths with potentials; cubic in the size."""
    n, m = len(costs), len(costs[0]) if costs else 0
    u, v, row_of = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], j = i, 0
        least, way, done = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[j]:
            done[j] = True
            r, step, nxt = row_of[j], float("inf"), 0
            for k in range(1, m + 1):
                if not done[k]:
                    slack = costs[r - 1][k - 1] - u[r] - v[k]
                    if slack < least[k]:
                        least[k], way[k] = slack, j
                    if least[k] < step:
                        step, nxt = least[k], k
            for k in range(m + 1):
                if done[k]:
                    u[row_of[k]] += step
                    v[k] -= step
                else:
                    least[k] -= step
            j = nxt
        while j:
            row_of[j] = row_of[way[j]]
            j = way[j]
    out = [0] * n
    for k in range(1, m + 1):
        if row_of[k]:
            out[row_of[k] - 1] = k - 1
    return out


def alignment(a: list[str], b: list[str], fixed_initials: bool = False) -> float | None:
    """Least cost of assigning the tokens of the shorter list to those of the longer one, each to one
    of its own; None if some token fits none. With ``fixed_initials`` (persons) an initial keeps its
    place among the given names, and the first of both lists must have partners."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return ALONE * len(b)

    def cost(i: int, k: int) -> float:
        c = token_cost(a[i], b[k], given=fixed_initials)
        moved = i != k
        if c is None or (fixed_initials and moved and min(len(a[i]), len(b[k])) == 1):
            return _NEVER
        return c + MOVED * moved

    costs = [[cost(i, k) for k in range(len(b))] for i in range(len(a))]
    chosen = optimal_assignment(costs)
    total = sum(costs[i][k] for i, k in enumerate(chosen))
    if total >= _NEVER or (fixed_initials and 0 not in chosen):
        return None
    return total + ALONE * (len(b) - len(a))


def _fit(x: dict, y: dict) -> float | None:
    """Cost of taking two names of one family or first word for one entity, None if they differ."""
    if x["suffix"] and y["suffix"] and x["suffix"] != y["suffix"]:
        return None
    return alignment(x["rest"], y["rest"], fixed_initials=x["kind"] == "p")


def _entities(key: tuple, rows: list[tuple]) -> list[tuple]:
    """Number the entities among the distinct parsed names of one key and family name."""
    kind = key[1]
    split = [(rest.split(), rest, suffix, n) for rest, suffix, n in rows]
    # fullest first: a spelled-out given name, a suffix, more tokens; then the commonest
    split.sort(key=lambda r: (-(4 * (len(r[0][0]) > 1 if r[0] else 0) + 2 * (r[2] != "") + min(len(r[0]), 2) - 1), -r[3], r[1], r[2]))
    entities: list[dict] = []
    out = []
    for tokens, rest, suffix, n in split:
        own = {"kind": kind, "rest": tokens, "suffix": suffix}
        fits = [e for e in entities if _fit(e, own) is not None]
        if fits:
            best = max(fits, key=lambda e: e["n"])
            if (len(best["rest"]), sum(map(len, best["rest"]))) < (len(tokens), sum(map(len, tokens))):
                best["rest"] = tokens
            best["suffix"] = best["suffix"] or suffix
        else:
            best = own | {"n": 0, "id": len(entities)}
            entities.append(best)
        best["n"] += n
        out.append((*key, rest, suffix, best["id"]))
    return out


_PARSED = ["kind", "family", "rest", "suffix"]


def parsed_names(rows: DataFrame) -> DataFrame:
    """raw, kind, family, rest, suffix of each distinct name that names someone. ``rows``: raw, key."""
    raw = rows.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))

    def cut(batches):
        for batch in batches:
            got = [(r, int(n), i, t, role) for r, n in zip(batch["raw"], batch["n"]) for i, (t, role) in enumerate(name_tokens(r))]
            yield pd.DataFrame(got, columns=["raw", "n", "i", "token", "role"])

    tokens = written(spread(raw).mapInPandas(cut, "raw string, n bigint, i int, token string, role int"))
    counts = tokens.where("role not in (3, 4)").groupBy("token").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("role") == 2, F.col("n")).otherwise(0)).alias("giv"))
    heads = written(token_heads(counts))
    tokens = written(tokens.join(heads, "token", "left").withColumn("head", F.when(F.col("role") == 5, F.col("token")).otherwise(F.coalesce("head", "token"))))
    legal = tokens.where("role = 4").select("raw", F.lit(1).alias("legal")).distinct()
    roles = (
        tokens.join(legal, "raw", "left").groupBy("head")
        .agg(
            F.sum(F.when(F.col("role") == 1, F.col("n")).otherwise(0)).alias("fam"),
            F.sum(F.when((F.col("role") == 2) & F.col("legal").isNull(), F.col("n")).otherwise(0)).alias("giv"),
            F.sum(F.when(F.col("legal") == 1, F.col("n")).otherwise(0)).alias("org"),
        )
    )
    # a name has a handful of tokens, so what is gathered per name is small
    formal = F.coalesce("formal", "head").alias("formal")
    whole = tokens.join(roles, "head").join(learned_forms(rows, tokens), "head", "left").groupBy("raw").agg(
        F.sort_array(F.collect_list(F.struct("i", "token", "role", "head", "fam", "giv", "org", formal))).alias("ts")
    )

    def parse(batches):
        for batch in batches:
            got = []
            for r, ts in zip(batch["raw"], batch["ts"]):
                p = _parse([(t["token"], t["role"], t["head"], t["fam"], t["giv"], t["org"], t["formal"]) for t in ts])
                if p is not None:
                    got.append((r, *p))
            yield pd.DataFrame(got, columns=["raw", *_PARSED])

    return whole.mapInPandas(parse, "raw string, kind string, family string, rest string, suffix string")


def name_entities(rows: DataFrame) -> DataFrame:
    """``rows`` (raw, key and others) that name someone, with entity_id; one per key and entity.

    Entities are told within a key and family name from the distinct parsed names, which are few
    however many rows share the key.
    """
    parsed = written(parsed_names(rows))
    named = written(rows.join(parsed, "raw"))
    distinct = named.groupBy("key", *_PARSED).agg(F.count(F.lit(1)).alias("n"))
    told = map_runs(
        distinct, ["key", "kind", "family"], ["rest", "suffix", "n"], _entities,
        "key string, kind string, family string, rest string, suffix string, entity int",
    )
    return named.join(told, ["key", *_PARSED]).withColumn("entity_id", F.concat_ws("|", "key", "kind", "family", "entity"))


def name_rows(summary_logs: DataFrame) -> DataFrame:
    """sl_id, raw, key: one row per name and key, where a key is a log or a star as stored."""
    blank = lambda c: F.when(F.trim(F.regexp_replace(c, r"\s+", " ")) != "", F.col(c))
    log = F.nullif(F.regexp_extract("pdf_name", r"(?i)^\s*LOG[ _](\d{7})", 1), F.lit(""))
    keys = F.array(F.concat(F.lit("log:"), log), F.concat(F.lit("star:"), F.col("star_no")))
    return (
        summary_logs.select("sl_id", F.coalesce(blank("party_name"), blank("accused_name")).alias("raw"), F.explode(keys).alias("key"))
        .where(F.col("raw").isNotNull() & F.col("key").isNotNull())
    )


def same_names(summary_logs: DataFrame) -> DataFrame:
    """sl_id_a, sl_id_b: rows of one log or star that name the same one in unequal writing."""
    named = written(name_entities(name_rows(summary_logs)).select("sl_id", "raw", "entity_id"))
    return unequal_pairs(named, "entity_id", "raw", "sl_id", ("sl_id_a", "sl_id_b"))


def name_classes(summary_logs: DataFrame) -> DataFrame:
    """sl_id, key, class_id (smallest sl_id of the entity in that log or star), links: the rows it
    is linked to under that key. One row per row and key; rows are not expanded into pairs."""
    named = written(name_entities(name_rows(summary_logs)).select("sl_id", "key", "raw", "entity_id"))
    return linked_classes(named, "entity_id", "raw", "sl_id", ["key"])
