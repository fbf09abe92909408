"""Narratives of digests and web complaints from word boxes in inches, merged and sampled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.stats import ordered_concat
from paperloom.functions.text import first_group, line_key, osa_below, page_tail, qgram_jaccard_distance, squish
from paperloom.operators.lines import confident_words, document_lines, fill_down
from paperloom.session import written

FILE, PAGE = ["fileid"], ["fileid", "page_no"]
#: Flags of digest lines, by the first that holds. c: bare text equals, x: text has,
#: b: bare text begins with.
DIGEST_FLAGS = (
    ("c", "ALLEGATIONS", "alleg"), ("x", "IF CPD MEMBER, LIST", "alleg"), ("x", "LIST RANK, STAR, EMPLOYEE", "alleg"),
    ("c", "SUMMARY", "summ"), ("x", "^Briefly summarize the investigation", "summ"),
    ("x", "your efforts to prove or disprove the allegation", "summ"), ("x", r"support the allegation\(s\)", "summ"),
    ("x", "sustained cases ONLY", "summ"), ("x", "be included as attachments", "summ"), ("b", "^ATTACHMENTS", "attach"),
    ("b", "^FINDINGS", "findings"), ("b", "^EVIDENCE", "evidence"), ("b", "^INVESTIGATION", "investigations"),
    ("b", "^INVESTIGATION SUMMARY", "investigations"), ("b", "^SEE ATTACHED", "ignore"), ("b", "^SEE NARRATIVE", "ignore"),
    ("b", "^See Attached", "ignore"), ("b", "^See Narrative", "ignore"), ("b", "^SEE PAGE", "ignore"),
)
#: Printed notes that are no part of an allegation.
PRINTED_NOTES = (
    'NOTE: Complaint Log "Type" remains classified as Info — Sworn Affidavit NOT on file',
    'Complaint type classified as "CR" Sworn affidavit on file',
)


def _bare(text: Column) -> Column:
    return squish(F.regexp_replace(text, r"(?U)[^\w\s]", ""))


def word_lines(words: DataFrame) -> DataFrame:
    return document_lines(confident_words(words), [*FILE, "filename", "page_no", "line_id"], ["word_id"])


def digest_lines(words: DataFrame) -> DataFrame:
    """Digest lines with the flag of their part, filled down within a page."""
    lines = word_lines(words).withColumn("bare", _bare(F.col("text")))
    flag = None
    for kind, pattern, name in DIGEST_FLAGS:
        hit = F.col("bare") == pattern if kind == "c" else F.col("text" if kind == "x" else "bare").rlike(pattern)
        flag = F.when(hit, name) if flag is None else flag.when(hit, name)
    gap = F.col("y0") - F.lag("y0").over(Window.partitionBy(*PAGE).orderBy("line_id"))
    foot = (F.col("y0") > 10) & F.col("bare").rlike(r"(Page)|(CPD\-44)") & (gap > 1.5)
    # a null gap leaves the footer test undecided, which clears the flag as in the original rule
    undecided = (F.col("y0") > 10) & F.col("bare").rlike(r"(Page)|(CPD\-44)") & gap.isNull()
    lines = lines.withColumn("flag", F.when(foot, "foot").when(undecided, F.lit(None)).otherwise(flag))
    return fill_down(lines, PAGE, ["line_id"], "flag")


def clean_allegation(lines: DataFrame) -> DataFrame:
    """Allegation lines without what the form prints in the box."""
    text, bare = F.col("text"), F.trim(F.regexp_replace("text", r"(?U)[^\w\s]", ""))
    printed = [r"^CPD [0-9]+$", r"^CPD.+Page [0-9]+", r"^\(Rev\.", r"^CPD\-44\.112", "IF CPD MEMBER, LIST", "LIST RANK, STAR, EMPLOYEE"]
    good = (bare != "ALLEGATIONS") & ~bare.rlike("Sworn [Aa]ffidavit NOT on file") & ~bare.rlike("SEE ATTACHED")
    for p in printed:
        good = good & ~text.rlike(p)
    good = good & (F.regexp_count(text, F.lit("[A-Za-z0-9]")) > 2)
    for note in PRINTED_NOTES:
        good = good & (qgram_jaccard_distance(text, F.lit(note), 8) > 0.8)
    return lines.where((F.col("flag") == "alleg") & good)


def without_heads(lines: DataFrame) -> DataFrame:
    head = (F.col("y0") < 0.5) | ((F.col("y0") < 1.1) & F.col("text").rlike("^(INSTRUCTIONS|SUSTAINED|SUMMARY REPORT|CHICAGO POLICE)"))
    return lines.where(~head)


def paragraphs(lines: DataFrame) -> DataFrame:
    """fileid, filename, text: lines joined to paragraphs (a gap over .1 parts them), paragraphs
    by an empty line."""
    w = Window.partitionBy(*PAGE).orderBy("line_id")
    new = F.coalesce(F.col("y0") > F.lag("y1").over(w) + 0.1, F.lit(True))
    rows = lines.withColumn("_new", new.cast("int")).withColumn("pid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    par = rows.groupBy(*FILE, "filename", "page_no", "pid").agg(squish(ordered_concat(F.col("text"), [F.col("line_id")])).alias("text"))
    return par.groupBy(*FILE, "filename").agg(ordered_concat(F.col("text"), [F.col("page_no"), F.col("pid")], "\n\n").alias("text"))


def digest_narratives(words: DataFrame) -> DataFrame:
    """fileid, cr_id, filename, text, pass_no of the digest files.

    Four passes, each for files none before gave a text: allegations all on page one; on one
    page after page heads are cut; on any pages; lines between other headings.
    """
    lines = written(digest_lines(words))
    alleg = lines.where("flag = 'alleg'")
    own = Window.partitionBy(*FILE)
    done: list[DataFrame] = []

    def left(rows: DataFrame) -> DataFrame:
        return reduce(lambda r, d: r.join(d.select(*FILE).distinct(), FILE, "left_anti"), done, rows)

    def add(found: DataFrame, n: int) -> None:
        done.append(written(found.withColumn("pass_no", F.lit(n))))

    first = alleg.withColumn("_a", F.min("page_no").over(own)).withColumn("_b", F.max("page_no").over(own)).where("_a = 1 and _b = 1").drop("_a", "_b")
    add(paragraphs(clean_allegation(first)), 1)
    cut = without_heads(clean_allegation(left(alleg)))
    add(paragraphs(cut.withColumn("_p", F.size(F.collect_set("page_no").over(own))).where("_p = 1").drop("_p")), 2)
    add(paragraphs(without_heads(clean_allegation(left(alleg)))), 3)
    flag = F.when(F.col("text").rlike(r"^ALLEGATION\:|^Allegations\:"), "alleg").when(F.col("text").rlike(r"^SUMMARY(\:)?$|SUMMARY/INVESTIGATION"), "summary")
    rest = fill_down(left(lines).withColumn("flag", flag), FILE, ["page_no", "line_id"], "flag")
    add(paragraphs(rest.where("flag = 'alleg'")), 4)
    out = reduce(lambda a, b: a.unionByName(b), done)
    return out.select(*FILE, first_group(F.col("filename"), r"^LOG_([0-9]+)\-").alias("cr_id"), "filename", "text", "pass_no")


def complaint_lines(words: DataFrame) -> DataFrame:
    """Web-complaint lines with their marks, page headers and footers cut off."""
    text = F.col("text")
    page = Window.partitionBy(*PAGE)
    lines = word_lines(words).withColumns({
        "info": osa_below(text, F.lit("INFORMATION ABOUT THE INCIDENT"), 7), "place": osa_below(text, F.lit("Location of the incident"), 7),
        "indented": F.col("x0") > 2.5, "capitals": text == F.upper(text), "seqid": line_key(F.col("page_no"), F.col("y0")),
        "low": F.col("y0") > F.max("y1").over(page) - 1.1,
    })
    header = (F.col("y0") < 0.5) & text.rlike("WEB Complaint|Page [0-9]+ of [0-9]+")
    footer = F.col("low") & text.rlike(r"http\://|^CPD|[0-9]+/[0-9]+/[0-9]+")
    lines = lines.withColumns({
        "hdr_until": F.coalesce(F.max(F.when(header, F.col("y1"))).over(page), F.lit(0.0)), "ftr_from": F.min(F.when(footer, F.col("y0"))).over(page),
    })
    return lines.withColumn("inside", (F.col("y0") > F.col("hdr_until")) & (F.col("ftr_from").isNull() | (F.col("y1") < F.col("ftr_from"))))


def left_margins(words: DataFrame) -> DataFrame:
    """fileid, page_no, left_margin; files with a page lacking one are left out wholly.

    The margin is right of a file's one word like 'incident' in the left half; else the lowest
    tenth of the line starts between 2 and 4.5 inches, if nine tenths lie within .25 of it.
    """
    label = (F.col("x1") < 3.5) & osa_below(F.col("text"), F.lit("incident"), 3)
    by_label = words.where(label).groupBy(*FILE).agg(F.count(F.lit(1)).alias("n"), F.max("x1").alias("left_margin")).where("n = 1").drop("n")
    starts = words.join(by_label.select(*FILE), FILE, "left_anti").groupBy(*PAGE, "line_id").agg(F.min("x0").alias("x0")).where("x0 > 2 and x0 < 4.5")
    spread = starts.groupBy(*PAGE).agg(F.percentile("x0", F.lit(0.1)).alias("lo"), F.percentile("x0", F.lit(0.9)).alias("hi")).where("hi - lo < 0.25")
    every = words.select(*PAGE).distinct()
    out = every.join(by_label, FILE).unionByName(spread.select(*PAGE, F.col("lo").alias("left_margin")))
    short = every.join(out.select(*PAGE), PAGE, "left_anti").select(*FILE).distinct()
    return out.join(short, FILE, "left_anti")


def _words_in(words: DataFrame, lines: DataFrame, ranges: DataFrame) -> DataFrame:
    pages = lines.select(*PAGE, "hdr_until", "ftr_from").distinct()
    rows = words.join(pages, PAGE, "left").where(
        (F.col("y0") > F.coalesce("hdr_until", F.lit(0.0))) & (F.col("ftr_from").isNull() | (F.col("y1") < F.col("ftr_from")))
    )
    key = line_key(F.col("page_no"), F.col("y0"))
    rows = written(rows.join(ranges, FILE).where((key >= F.col("from")) & (key <= F.col("to"))).drop("from", "to"))
    margin = left_margins(rows)
    return rows.join(margin, PAGE).where(F.col("x0") > F.col("left_margin"))


def complaint_narratives(words: DataFrame) -> DataFrame:
    """fileid, cr_id, filename, text, pass_no of the web complaints.

    Pass one: between the one 'information' label and the one 'location' label. Pass two, for
    the rest: from the label to the first line whose next one is neither indented nor in
    capitals and stands more than .3 below, all on one page.
    """
    lines = written(complaint_lines(words))
    order = Window.partitionBy(*FILE).orderBy("page_no", "line_id")
    inside = lines.where("inside").withColumns({
        "starts": F.coalesce(F.lag("info").over(order), F.lit(False)), "ends": F.coalesce(F.lead("place").over(order), F.lit(False)),
    })
    one = inside.groupBy(*FILE).agg(
        F.count_if("starts").alias("s"), F.count_if("ends").alias("e"),
        F.min(F.when(F.col("starts"), F.col("seqid"))).alias("from"), F.max(F.when(F.col("ends"), F.col("seqid"))).alias("to"),
    ).where("s = 1 and e = 1 and `to` > `from`").select(*FILE, "from", "to")
    by_order = [F.col(c) for c in ("page_no", "line_id", "word_id")]
    told = written(_words_in(words, lines, one).groupBy(*FILE, "filename").agg(ordered_concat(F.col("text"), by_order).alias("text")))
    rest = lines.where("inside").join(told.select(*FILE), FILE, "left_anti")
    starts = rest.groupBy(*FILE).agg(F.count_if("info").alias("n"), F.min(F.when(F.col("info"), F.col("seqid"))).alias("from")).where("n = 1").drop("n")
    page = Window.partitionBy(*PAGE).orderBy("line_id")
    after = rest.join(starts, FILE).where("seqid > `from`")
    stop = ~F.lead("indented").over(page) & ~F.lead("capitals").over(page) & (F.lead("y0").over(page) - F.col("y1") > 0.3)
    two = after.withColumn("_s", F.coalesce(stop, F.lit(False))).groupBy(*FILE, "from").agg(F.min(F.when(F.col("_s"), F.col("seqid"))).alias("to")).where("`to` is not null")
    more = _words_in(words.join(told.select(*FILE), FILE, "left_anti"), lines, two).groupBy(*FILE, "filename").agg(ordered_concat(F.col("text"), by_order).alias("text"))
    out = told.withColumn("pass_no", F.lit(1)).unionByName(more.withColumn("pass_no", F.lit(2)))
    return out.select(*FILE, first_group(F.col("filename"), r"^LOG[_ ]([0-9]+)\-").alias("cr_id"), "filename", "text", "pass_no")


MERGED = ["cr_id", "filename", "rpt_type", "rpt_page_from", "rpt_page_to", "doccloud_url", "text"]


def face_narratives(cells: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Allegation cells (cr_id, section_name, column_name, pdf_name, page_num, text) as narratives."""
    rows = cells.where(F.col("column_name").isin("Initial / Intake Allegation", "Allegation"))
    rows = rows.select("cr_id", "section_name", "column_name", "pdf_name", "page_num", "text").distinct()
    ref = pdfs.select(F.col("filename").alias("pdf_name"), "doccloud_url").distinct()
    return rows.join(ref, "pdf_name", "left").select(
        "cr_id", F.col("pdf_name").alias("filename"), F.concat_ws(" ", "section_name", "column_name").alias("rpt_type"),
        F.col("page_num").alias("rpt_page_from"), F.col("page_num").alias("rpt_page_to"), "doccloud_url", "text",
    )


def file_narratives(narratives: DataFrame, pdfs: DataFrame, rpt_type: str) -> DataFrame:
    """Narratives (cr_id, filename, text) of page-range files as narratives of their originals."""
    stem, first, last = page_tail(F.col("filename"))
    rows = narratives.select("cr_id", stem.alias("original"), first.alias("rpt_page_from"), last.alias("rpt_page_to"), "text")
    ref = pdfs.select(F.col("filename").alias("original"), "doccloud_url").distinct()
    return rows.join(ref, "original", "left").select(
        "cr_id", F.col("original").alias("filename"), F.lit(rpt_type).alias("rpt_type"), "rpt_page_from", "rpt_page_to", "doccloud_url", "text"
    )


def merged_narratives(faces: DataFrame, digests: DataFrame, complaints: DataFrame, pdfs: DataFrame) -> DataFrame:
    """The three sources in the seven common columns."""
    parts = [face_narratives(faces, pdfs), file_narratives(digests, pdfs, "log_summary_digest"), file_narratives(complaints, pdfs, "web_complaint_detail")]
    text_id = [p.withColumn("cr_id", F.col("cr_id").cast("string")) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), text_id).select(*MERGED)


def stratified_sample(rows: DataFrame, stratum: str, ids: list[str], n: int, seed: int = 0) -> DataFrame:
    """At most n rows of each stratum in a reproducible random order, ``place`` from 1."""
    w = Window.partitionBy(stratum).orderBy(F.md5(F.concat_ws("|", *[F.col(i).cast("string") for i in ids], F.lit(str(seed)))), *ids)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def short_strata(rows: DataFrame, stratum: str, n: int) -> DataFrame:
    """Strata with fewer than n rows."""
    return rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") < n)


def topical_texts(narratives: DataFrame) -> DataFrame:
    """Texts under 30,000 characters that speak of ongoing matters or harassment."""
    return narratives.where((F.length("text") < 30000) & F.lower("text").rlike(r"(on[\-\s]*going)|(harass)"))
