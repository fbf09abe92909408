"""Noise in text from scanned pages: broken words, misread glyphs, running headers.

Words are grouped by a confusable-glyph skeleton and rare forms give way to the frequent form
of their group; where several frequent forms fit, the one that stands beside the same words in
other texts is taken. Lines are masked by digit to find running headers and page numbers, and
the rest is reflowed.

Equal texts are worked on once. Lines, running text and words of a text stay together in arrays
of its row; what is shuffled are counts of words and line templates, and the few findings.

Defined results: a null or blank text has no lines, no findings and a null repaired text; a
repeated row counts once; of equally frequent right forms the one nearest in edits, then first
in order, is taken; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.form_keys import heading_key
from paperloom.session import written

#: The form columns whose texts come from scanned prose.
PROSE_COLUMNS = ("Initial / Intake Allegation", "Allegation", "Description of Incident", "Narrative", "Remarks")
#: Glyph sequences that scanners confuse, each spelled out in strokes, then single
#: glyphs that look alike. After both steps confusable words are the same string.
STROKES = (("m", "rn"), ("w", "vv"), ("d", "cl"), ("h", "li"), ("n", "ri"), ("u", "ii"))
GLYPHS = ("01|i€@+ƒ569c", "ollleatfsbge")
#: A line template is furniture only if it stands in LEAST_TEXTS texts, however many there are; words that tell it from prose.
LEAST_TEXTS, STEM = 4, 3
#: A letters-only form yields to one this many times as frequent; a form with odd glyphs to any
#: form that stands in LEAST_RIGHT texts. Of several that fit, one goes first that stands beside the same words in
#: LEAST_BESIDE texts and RATIO times as many as the next.
RATIO, LEAST_RIGHT, LEAST_BESIDE = 10, 2, 3

_EDGES = " \t\r\n\x0b\x0c.,;:!?()[]{}\"'“”‘’*_/<>~#-"
_EDGE = r"[\s.,;:!?()\[\]{}\"'“”‘’*_/<>~#-]+"
_WORD = r"^[a-z]+(?:['-][a-z]+)*$"
_BREAK = r"([\p{L}\p{N}€@+|ƒ])[-­¬][\n\x02]+(?=[\p{L}€@+|ƒ])"
#: Between the halves of a broken word, and between paragraphs.
_MARK, _PARAGRAPH = "\u0001", "\u0002"
#: Before the form of a word with a capital, in a case key.
_CAPITAL = "\u0003"
_BARE_NUMBER = r"^[^\p{L}\p{N}.]{0,4}\d{1,9}[^\p{L}\p{N}.]{0,4}$"
KEYS = ["src", "rec_id"]


def skeleton(word: Column) -> Column:
    """The confusable-glyph skeleton of a lower-case word."""
    for glyph, strokes in STROKES:
        word = F.replace(word, F.lit(glyph), F.lit(strokes))
    return F.translate(word, *GLYPHS)


def bare_word(token: Column) -> Column:
    """Lower case, without punctuation around; a glyph such as | or @ stays."""
    return F.btrim(F.lower(token), F.lit(_EDGES))


def scanned_texts(report_extract: DataFrame, cells: DataFrame) -> DataFrame:
    """src, rec_id, text of every narrative and of every cell row in a prose column.

    A heading counts by its column name alone, exact or one letter off.
    """
    right = F.array(*[heading_key(F.lit(c)) for c in PROSE_COLUMNS])
    near = F.exists(right, lambda r: F.levenshtein(r, F.col("ckey"), 1) >= 0)
    prose = cells.withColumn("ckey", heading_key(F.col("column_name"))).where(near)
    return (
        report_extract.select(F.lit("report_extract").alias("src"), F.col("docid").cast("string").alias("rec_id"), F.col("narrative").alias("text"))
        .unionByName(prose.select(F.lit("cr_summary_data_temp").alias("src"), F.col("row_id").cast("string").alias("rec_id"), "text"))
        .where(F.col("text").isNotNull())
        .withColumn("copy", F.unhex(F.md5("text")))
    )


def distinct_texts(rows: DataFrame) -> DataFrame:
    """copy, lines, masks: each different text once, as its trimmed lines with runs of blanks as one,
    and the same lines with digits masked. Cut as whole texts, so that no line is handled alone."""
    t = F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), r"[^\S\n]+|\u00a0+", " ")
    t = F.regexp_replace(F.regexp_replace(t, " +", " "), "(?m)^ | $", "")
    return rows.select("copy", "text").dropDuplicates(["copy"]).select("copy", t.alias("t")).select(
        "copy", F.split("t", "\n").alias("lines"), F.split(line_mask(F.col("t")), "\n").alias("masks")
    )


def line_mask(line: Column) -> Column:
    return F.regexp_replace(line, "[0-9]+", "#")


def furniture_templates(texts: DataFrame) -> DataFrame:
    """mask of each line template that recurs across the laid-out texts and cuts into sentences.

    Nothing here depends on how many other texts there are. A template is furniture if it
    neither begins in lower case nor ends a sentence, stands in LEAST_TEXTS different texts and
    between as many different lines (copies of one text repeat its neighbours too; at the end of
    texts the lines before are enough, at their top those after if they mostly begin anew), mostly
    follows a line
    that ends no sentence, and if its first STEM words, where they occur within the lines, mostly
    begin one: prose wraps anywhere. Templates without a letter need no such stem.
    """
    none = F.array(F.lit(None).cast("string"))
    filled = texts.where(F.size("lines") > 1).select("copy", F.array_remove("lines", "").alias("ls"), F.array_remove("masks", "").alias("masks")).where(F.size("ls") > 0)
    n = F.size("ls")
    around = F.arrays_zip("masks", F.concat(none, F.slice("ls", F.lit(1), n - 1)).alias("before"), F.concat(F.slice("ls", F.lit(2), n - 1), none).alias("after"))
    hashed = lambda c: F.when(c.isNotNull(), F.xxhash64(c))
    laid = (
        filled.select("copy", F.inline(around).alias("mask", "before", "after")).where(~F.col("mask").rlike(r"^\p{Ll}|[.?!]$"))
        .select(
            "copy", "mask", (~F.col("before").rlike(r"[.?!]['\"”)]?$")).cast("int").alias("open"), F.col("after").rlike(r"^\p{Ll}").cast("int").alias("goes_on"),
            hashed(F.col("before")).alias("before"), hashed(F.col("after")).alias("after"),
        )
    )
    seen = laid.groupBy("mask", "copy").agg(F.avg("open").alias("open")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"), F.avg("open").alias("open"))
    often = seen.where((F.col("n") >= LEAST_TEXTS) & (F.coalesce("open", F.lit(1.0)) >= 0.5)).select("mask")
    varied = laid.join(often, "mask").groupBy("mask").agg(F.count_distinct("before").alias("b"), F.count_distinct("after").alias("a"), F.avg("goes_on").alias("goes_on"))
    between = F.least("b", "a") >= LEAST_TEXTS
    varied = varied.where(between | ((F.col("b") >= LEAST_TEXTS) & (F.col("a") == 0)) | ((F.col("a") >= LEAST_TEXTS) & (F.col("goes_on") < 0.5)))
    words = F.split("mask", " ")
    # the stem of a template of fewer words is the whole of it
    size = F.least(F.size("ws"), F.lit(STEM))
    asked = written(varied.where(F.col("mask").rlike(r"\p{L}")).select("mask", words.alias("ws")).select("mask", F.col("ws")[0].alias("word"), size.alias("size"), F.xxhash64(F.array_join(F.slice("ws", F.lit(1), size), " ")).alias("stem")))
    # only words that begin a template go on to be compared in their lines
    starts = filled.select(F.explode("masks").alias("mask")).select(words.alias("ws")).select("ws", F.posexplode("ws").alias("at", "word"))
    starts = starts.join(asked.select("word", "size").distinct(), "word").where(F.size("ws") - F.col("at") >= F.col("size"))
    grams = starts.select((F.col("at") == 0).cast("int").alias("begins"), "size", F.xxhash64(F.array_join(F.slice("ws", F.col("at") + 1, F.col("size")), " ")).alias("stem"))
    begun = grams.join(asked.select("size", "stem").distinct(), ["size", "stem"]).groupBy("size", "stem").agg(F.avg("begins").alias("share"))
    alone = asked.join(begun.where(F.col("share") >= 0.5), ["size", "stem"]).select("mask")
    return alone.unionByName(varied.where(~F.col("mask").rlike(r"\p{L}")).select("mask")).withColumn("known", F.lit(True))


def marked_texts(texts: DataFrame) -> DataFrame:
    """``texts`` with ``marks``: the places of their furniture lines (known templates; page numbers
    standing alone), null without."""
    masks = texts.where(F.size("lines") > 1).select("copy", F.posexplode(F.arrays_zip("masks", "lines")).alias("i", "x"))
    masks = masks.select("copy", "i", "x.masks", F.col("x.lines").rlike(_BARE_NUMBER).alias("bare")).where("masks <> ''").withColumnRenamed("masks", "mask")
    known = masks.join(furniture_templates(texts), "mask", "left").where(F.col("bare") | F.col("known").isNotNull())
    return texts.join(known.groupBy("copy").agg(F.collect_set("i").alias("marks")), "copy", "left").select("copy", "lines", "marks")


def running_text(lines: Column, marks: Column) -> Column:
    """The lines without furniture as one text: the halves of a word broken over a line end are parted by
    U+0001 (a hyphen that ends a dash joins nothing), paragraphs by U+0002, lines by line ends."""
    kept = F.when(marks.isNull(), lines).otherwise(F.filter(lines, lambda x, i: ~F.array_contains(marks, i)))
    text = F.regexp_replace(F.array_join(kept, "\n"), "\n\n+", _PARAGRAPH)
    return F.regexp_replace(text, _BREAK, f"$1{_MARK}")


def case_key(bare: Column) -> Column:
    """The lower-case form of a word without punctuation around it, behind a mark if it has a capital:
    form and case in one string, which arrays compare fast."""
    first = F.left(bare, F.lit(1))
    return F.concat(F.when(first != F.lower(first), _CAPITAL).otherwise(""), F.lower(bare))


def key_parts(key: Column) -> list[Column]:
    """form and cap of a case key."""
    cap = F.startswith(key, F.lit(_CAPITAL))
    return [F.when(cap, F.substring(key, 2, 1 << 20)).otherwise(key).alias("form"), cap.alias("cap")]


def written_forms(texts: DataFrame) -> DataFrame:
    """copy, lines, marks, words (the tokens of the running text in order), wholes (the different whole
    tokens), keys (their case keys) and splits: the different broken words, where ``alt`` has a hyphen
    between the halves, ``half`` is the second, and ``cap``: it begins with a capital, as names and
    sentences do."""
    words = F.array_remove(F.split(running_text(F.col("lines"), F.col("marks")), r"[ \n\x02]"), "")
    rows = texts.select("copy", "lines", "marks", words.alias("words"))
    rows = rows.withColumn("tokens", F.array_distinct("words")).withColumn("some", F.array_join("words", " ").contains(_MARK))
    rows = rows.withColumn("wholes", F.when(F.col("some"), F.filter("tokens", lambda t: ~t.contains(_MARK))).otherwise(F.col("tokens")))
    bare = F.transform("wholes", lambda t: F.btrim(t, F.lit(_EDGES)))
    first = lambda t: F.left(F.btrim(t, F.lit(_EDGES)), F.lit(1))
    joined = lambda t, by: bare_word(F.replace(t, F.lit(_MARK), F.lit(by)))
    broken = F.transform(F.filter("tokens", lambda t: t.contains(_MARK)), lambda t: F.struct(
        t.alias("token"), joined(t, "").alias("form"), (first(t) != F.lower(first(t))).alias("cap"), joined(t, "-").alias("alt"), bare_word(F.element_at(F.split(t, _MARK), -1)).alias("half")
    ))
    return rows.select("copy", "lines", "marks", "words", "wholes", F.transform(bare, case_key).alias("keys"), F.when(F.col("some"), broken).alias("splits"))


def form_counts(texts: DataFrame) -> DataFrame:
    """form, cap, n: in how many different texts each form stands whole."""
    counts = texts.select(F.explode(F.array_distinct("keys")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*key_parts(F.col("key")), "n")


def candidate_forms(texts: DataFrame) -> DataFrame:
    """form, cap, right, rank, beats: the forms each written one may stand for, their order, and
    whether they are frequent enough beside it to be taken without regard to context.

    Counts are taken over all texts, by case: candidates of the same case go first and those of the
    other case serve only where there are none. Within a skeleton group a form yields to the frequent
    form nearest to it; forms that yield themselves are no candidates; broken words count for nothing.
    Only distinct forms meet in the join.
    """
    seen = form_counts(texts)
    broken = texts.select(F.explode("splits").alias("x")).select("x.cap", F.explode(F.array("x.form", "x.alt", "x.half")).alias("form")).distinct()
    asked = (
        seen.unionByName(broken.withColumn("n", F.lit(0).cast("long"))).where(F.col("form").rlike("[a-z]"))
        .groupBy("form", "cap").agg(F.max("n").alias("n")).withColumn("sk", skeleton(F.col("form")))
        .withColumn("all", F.sum("n").over(Window.partitionBy("form")))
    )
    asked = written(asked)
    letters = F.col("form").rlike(_WORD)
    good = asked.where(letters & (F.col("n") >= LEAST_RIGHT)).withColumn("top", F.max("n").over(Window.partitionBy("sk", "cap")))
    # a form that itself yields to another of its group is no right form
    good = good.where(F.col("n") * RATIO > F.col("top")).select(F.col("form").alias("right"), F.col("n").alias("m"), F.col("cap").alias("rcap"), "sk")
    beats = F.when(F.col("form") == F.col("right"), True).when(letters & (F.col("all") > 0), F.col("m") >= F.col("all") * RATIO).otherwise(True)
    # case first; then any form that outnumbers the written one tenfold goes before that itself
    rank = F.struct(
        (F.col("cap") != F.col("rcap")).alias("other"), (F.col("m") < F.col("all") * RATIO).alias("own"),
        F.levenshtein("form", "right").alias("d"), (-F.col("m")).alias("neg"), F.col("right").alias("right"),
    )
    met = asked.join(good, "sk").select("form", "cap", "right", rank.alias("rank"), beats.alias("beats"))
    return met.groupBy("form", "cap", "right").agg(F.min("rank").alias("rank"), F.max("beats").alias("beats"))


def right_forms(candidates: DataFrame) -> DataFrame:
    """form, cap, right, n: the first candidate of each written form."""
    best = candidates.where("beats").groupBy("form", "cap").agg(F.min("rank").alias("r"))
    return best.select("form", "cap", F.col("r.right").alias("right"), (-F.col("r.neg")).alias("n"))


def forms_in_context(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """copy, form, cap, beside: where several forms fit a whole form of a text, the one that neighbouring
    words support.

    Only forms of the case that goes first compete. Support of a form is the number of texts in
    which it stands, in the case in question, behind the same word or before the same word. Only forms that compete, and what they may stand for, leave their texts.
    """
    best = F.min("rank.other").over(Window.partitionBy("form", "cap"))
    candidates = candidates.withColumn("best", best).where(F.col("rank.other") == F.col("best"))
    several = candidates.groupBy("form", "cap").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("form", "cap")
    several = written(candidates.join(several, ["form", "cap"]).select("form", "cap", "right", (F.col("cap") != F.col("rank.other")).alias("rcap")))
    asked = several.select(F.explode(F.array("form", "right")).alias("form")).distinct()
    edge = F.array(F.lit(""))
    n = F.size("bare")
    bare = texts.select("copy", F.transform("words", lambda w: F.btrim(w, F.lit(_EDGES))).alias("bare")).where(n > 0)
    placed = F.arrays_zip("bare", F.concat(edge, F.slice("bare", F.lit(1), n - 1)).alias("left"), F.concat(F.slice("bare", F.lit(2), n - 1), edge).alias("right"))
    rows = bare.select("copy", F.inline(placed).alias("bare", "left", "right")).withColumn("form", F.lower("bare")).join(asked, "form")
    rows = rows.select("copy", "form", (F.left("bare", F.lit(1)) != F.lower(F.left("bare", F.lit(1)))).alias("cap"), F.array(F.lower("left"), F.concat(F.lit(">"), F.lower("right"))).alias("near"))
    stands = written(rows.select("copy", "form", "cap", F.explode("near").alias("near")).where("near not in ('', '>')").distinct())
    support = stands.groupBy(F.col("form").alias("right"), F.col("cap").alias("rcap"), "near").agg(F.count_distinct("copy").alias("s"))
    own = stands.join(several, ["form", "cap"]).join(support, ["right", "rcap", "near"]).groupBy("copy", "form", "cap", "right").agg(
        F.sum(F.when(F.col("form") == F.col("right"), F.col("s") - 1).otherwise(F.col("s"))).alias("s")  # the text itself is no support
    )
    best = own.groupBy("copy", "form", "cap").agg(F.max(F.struct("s", "right")).alias("b"), F.sort_array(F.collect_list("s"), asc=False).alias("all"))
    clear = (F.col("b.s") >= LEAST_BESIDE) & (F.col("b.s") >= RATIO * F.coalesce(F.get("all", F.lit(1)), F.lit(0)))
    return best.where(clear).select("copy", "form", "cap", F.col("b.right").alias("beside"))


def changed_tokens(texts: DataFrame) -> DataFrame:
    """copy, token, kinds (split, misread or both), right: what each finding in the running text should
    read, in lower case without punctuation. Single letters are initials and stay. ``texts``: written_forms."""
    candidates = written(candidate_forms(texts))
    rights = written(right_forms(candidates))
    context = forms_in_context(texts, candidates)
    wholes = texts.select("copy", F.inline(F.arrays_zip("wholes", "keys")).alias("token", "key")).select("copy", "token", *key_parts(F.col("key")))
    fixed = rights.where((F.col("form") != F.col("right")) & (F.length("form") > 1)).select("form", "cap", "right")
    plain = wholes.join(fixed, ["form", "cap"])
    supported = context.where(F.length("form") > 1)
    plain = plain.join(supported, ["copy", "form", "cap"], "left").withColumn("right", F.coalesce("beside", "right")).drop("beside")
    # a form that reads well by itself may still be out of place
    real = wholes.join(supported.where("form <> beside"), ["copy", "form", "cap"]).join(fixed.select("form", "cap"), ["form", "cap"], "left_anti").withColumnRenamed("beside", "right")
    misread = plain.unionByName(real).where("form <> right").select("copy", "token", F.array(F.lit("misread")).alias("kinds"), "right", F.lit(False).alias("hyphen"))
    broken = texts.select("copy", F.explode("splits").alias("x")).select("copy", "x.*")
    a = rights.select("form", "cap", F.col("right").alias("r1"), F.col("n").alias("n1"))
    b = rights.select(F.col("form").alias("alt"), "cap", F.col("right").alias("r2"), F.col("n").alias("n2"))
    c = rights.groupBy(F.col("form").alias("half")).agg(F.max("n").alias("n3"))
    joined = broken.join(a, ["form", "cap"], "left").join(b, ["alt", "cap"], "left").join(c, "half", "left")
    hyphen = F.coalesce(F.col("n2"), F.lit(0)) > F.coalesce(F.col("n1"), F.lit(0))
    right = F.when(hyphen, F.col("r2")).otherwise(F.coalesce(F.col("r1"), F.col("form")))
    wrong = right != F.when(hyphen, F.col("alt")).otherwise(F.col("form"))
    # an unknown word whose second half is a word itself: the text lost words after the line end
    found = F.coalesce("n1", "n2").isNotNull() | (F.col("n3").isNull() & F.col("form").rlike(_WORD))
    kinds = F.when(found & wrong, F.array(F.lit("split"), F.lit("misread"))).when(found, F.array(F.lit("split"))).otherwise(F.array())
    return misread.unionByName(joined.select("copy", "token", kinds.cast("array<string>").alias("kinds"), right.alias("right"), hyphen.alias("hyphen")))


def _prepared(report_extract: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, rec_id, copy of the rows; their different texts as written_forms), the latter written once."""
    rows = scanned_texts(report_extract, cells)
    texts = written(distinct_texts(rows))
    return rows.select(*KEYS, "copy"), written(written_forms(marked_texts(texts)))


def copy_findings(texts: DataFrame) -> DataFrame:
    """copy, kind, token (distinct) of each different text: kinds split, misread and furniture."""
    furniture = texts.where("marks is not null").select("copy", F.lit("furniture").alias("kind"), F.explode(F.transform("marks", lambda i: F.get("lines", i))).alias("token"))
    changed = changed_tokens(texts).select("copy", F.explode("kinds").alias("kind"), F.col("right").alias("token"))
    return furniture.unionByName(changed).distinct()


def noise_found(report_extract: DataFrame, cells: DataFrame) -> DataFrame:
    """src, rec_id, kind, token (distinct): kinds split, misread and furniture."""
    rows, texts = _prepared(report_extract, cells)
    return rows.distinct().join(written(copy_findings(texts)), "copy").select(*KEYS, "kind", "token").distinct()


def repaired_texts(report_extract: DataFrame, cells: DataFrame) -> DataFrame:
    """src, rec_id, text: each text as continuous paragraphs, without furniture, halves joined,
    misread words put right (a capital first letter and all capitals are kept).

    Empty lines part paragraphs. Texts of one id that differ come out as one row each; blank ones don't.
    """
    rows, texts = _prepared(report_extract, cells)
    plain = F.replace("token", F.lit(_MARK), F.when(F.col("hyphen"), F.lit("-")).otherwise(F.lit("")))
    body = F.btrim(plain, F.lit(_EDGES))
    cased = F.when((F.length(body) > 1) & (F.upper(body) == body), F.upper("right")).when(body.rlike(r"^\p{Lu}"), F.initcap("right")).otherwise(F.col("right"))
    read = F.when((F.lower(body) != F.col("right")) & (body != ""), F.replace(plain, body, cased)).otherwise(plain)
    # the changes of a text are as many as its findings
    changes = changed_tokens(texts).select("copy", "token", read.alias("read")).groupBy("copy").agg(F.map_from_entries(F.collect_list(F.struct("token", "read"))).alias("changes"))
    put_right = lambda w: F.coalesce(F.element_at("changes", w), F.replace(w, F.lit(_MARK), F.lit("")))
    paragraph = lambda p: F.array_join(F.transform(F.filter(F.split(p, r"[ \n]"), lambda w: w != ""), put_right), " ")
    paragraphs = F.filter(F.transform(F.split(running_text(F.col("lines"), F.col("marks")), _PARAGRAPH), paragraph), lambda p: p != "")
    done = texts.join(written(changes), "copy", "left").select("copy", F.array_join(paragraphs, "\n\n").alias("text")).where("text <> ''")
    return rows.distinct().join(done, "copy").select(*KEYS, "text")


def damaged_records(report_extract: DataFrame, cells: DataFrame) -> DataFrame:
    """src, rec_id of each record with any finding."""
    rows, texts = _prepared(report_extract, cells)
    return rows.join(written(copy_findings(texts)).select("copy").distinct(), "copy").select(*KEYS).distinct()
