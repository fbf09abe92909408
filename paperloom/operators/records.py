"""Structured report records: narrative, incident and personnel of a labelled report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.geometry import overlap_of_shorter
from paperloom.functions.stats import average_rank, distinct_sorted_concat, ordered_concat
from paperloom.operators.layout import column_islands
from paperloom.operators.lines import same_line_groups

#: Columns of the personnel table, by the first pattern that a heading word shows.
HEADINGS = (("Star(No)?", "star_no"), ("Emp(No)?", "emp_no"), ("Name", "name"), ("User", "user"), ("Date", "date"), ("Unit", "unit"), ("Beat", "beat"))
PERSONNEL = ["role", "star_no", "name", "date", "unit", "beat"]
DOC = "docid"


def report_narratives(words: DataFrame) -> DataFrame:
    """docid, narrative_conf (confidence per word), narrative in page, line and word order."""
    return words.where("section = 'narrative'").groupBy(DOC).agg(
        F.round(F.sum("section_conf") / F.count(F.lit(1)), 9).alias("narrative_conf"),
        ordered_concat(F.col("text"), [F.col(c) for c in ("docpg", "line_id", "word_id")]).alias("narrative"),
    )


def incident_lines(words: DataFrame) -> DataFrame:
    """docid, docpg, line_no, text, info_type (iucr or occ_date) of the tagged incident lines."""
    rows = same_line_groups(words.where("section = 'incident'"), [DOC, "docpg"])
    lines = rows.groupBy(DOC, "docpg", "line_no").agg(ordered_concat(F.col("text"), [F.col("x0"), F.col("word_id")]).alias("text"))
    kind = F.when(F.col("text").rlike(r"^IUCR|[0-9]{4} \-"), "iucr").when(F.col("text").startswith("Occurrence Date"), "occ_date")
    return lines.withColumn("info_type", kind).where("info_type is not null")


def incidents_in_review(lines: DataFrame) -> DataFrame:
    """docid, suspected_issue of documents whose tagged lines stand on several pages."""
    per = lines.groupBy(DOC).agg(F.count_distinct("docpg").alias("pages"), F.count_if(F.col("info_type") == "occ_date").alias("dates")).where("pages > 1")
    return per.select(DOC, F.when(F.col("dates") > 1, "multiple OCIC reports concatenated").otherwise("unknown page types").alias("suspected_issue"))


def report_incidents(lines: DataFrame) -> DataFrame:
    """docid, incident_date, iucr_id, iucr of one-page documents; null date where none is tagged."""
    own = Window.partitionBy(DOC)
    rows = lines.withColumn("pages", F.size(F.collect_set("docpg").over(own))).where("pages = 1")
    date = F.max(F.when(F.col("info_type") == "occ_date", F.col("text"))).over(own)
    number = F.count(F.when(F.col("info_type") == "iucr", 1)).over(own.orderBy("docpg", "line_no").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"incident_date": F.trim(F.regexp_replace(date, "#.*$", "")), "iucr_id": number}).where("info_type <> 'occ_date'")
    return rows.select(DOC, "incident_date", "iucr_id", F.col("text").alias("iucr"))


def personnel_headings(words: DataFrame) -> DataFrame:
    """docid, docpg, column, x0, x1 of the headings in the first line of each personnel section."""
    page = Window.partitionBy(DOC, "docpg")
    first = words.where("section = 'personnel'").withColumn("_l", F.min("line_id").over(page)).where("line_id = _l")
    column = None
    for pattern, name in HEADINGS:
        hit = F.trim("text").rlike(pattern)
        column = F.when(hit, name) if column is None else column.when(hit, name)
    return first.withColumn("column", column).where("column is not null").groupBy(DOC, "docpg", "column", "line_id").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1")
    ).drop("line_id")


def personnel_cells(words: DataFrame) -> DataFrame:
    """docid, docpg, line_id, column_id, column, text of the body cells under exactly one heading.

    Body columns are groups of boxes less than 40 pixels apart. A cell left of every heading is
    a role; another belongs to the headings it overlaps by more than half of the shorter.
    """
    page = Window.partitionBy(DOC, "docpg")
    body = words.where("section = 'personnel'").withColumn("_l", F.min("line_id").over(page)).where("line_id > _l").drop("_l")
    islands = column_islands(body, [DOC, "docpg"], 40).select(DOC, "docpg", "word_id", "column_id").distinct()
    cells = words.join(islands, [DOC, "docpg", "word_id"]).groupBy(DOC, "docpg", "line_id", "column_id").agg(
        ordered_concat(F.col("text"), [F.col("word_id")]).alias("text"), F.min("x0").alias("r0"), F.max("x1").alias("r1")
    )
    met = cells.join(personnel_headings(words), [DOC, "docpg"])
    leftmost = F.min("x0").over(Window.partitionBy(DOC, "docpg", "column_id"))
    met = met.withColumn("column", F.when(F.col("r1") < leftmost, "role").otherwise(F.col("column")))
    met = met.where((F.col("column") == "role") | (overlap_of_shorter(F.col("r0"), F.col("r1"), F.col("x0"), F.col("x1")) > 0.5))
    rows = met.select(DOC, "docpg", "line_id", "column_id", "column", "text").distinct()
    cell = Window.partitionBy(DOC, "docpg", "line_id", "column_id")
    return rows.withColumn("_n", F.size(F.collect_set("column").over(cell))).where("_n = 1").drop("_n")


def personnel_in_review(cells: DataFrame) -> DataFrame:
    per = cells.groupBy(DOC).agg(F.count_distinct("docpg").alias("pages")).where("pages > 1")
    return per.select(DOC, F.lit("unknown page types").alias("suspected_issue"))


def report_personnel(cells: DataFrame) -> DataFrame:
    """docid, row and the PERSONNEL columns of one-page documents, one row per table row.

    A row is the average rank of its line within its body column; a (row, column) met twice is
    dropped, as are employee number and user.
    """
    own = Window.partitionBy(DOC)
    rows = cells.withColumn("_p", F.size(F.collect_set("docpg").over(own))).where("_p = 1")
    column = Window.partitionBy(DOC, "docpg", "column_id")
    ties = Window.partitionBy(DOC, "docpg", "column_id", "line_id")
    rows = rows.withColumn("row", average_rank(F.col("line_id"), column, ties))
    once = Window.partitionBy(DOC, "docpg", "row", "column")
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(once)).where("_n = 1 and column not in ('emp_no', 'user')")
    return rows.select(DOC, "row", "column", "text").distinct().groupBy(DOC, "row").pivot("column", PERSONNEL).agg(F.min("text"))


def usable_personnel(personnel: DataFrame) -> DataFrame:
    """Rows of the documents with a role, a name, a star or unit, and three letters in role and name."""
    own = Window.partitionBy(DOC)
    some = lambda c: F.max(F.col(c).isNotNull().cast("int")).over(own)
    letters = lambda c: F.max(F.regexp_count(c, F.lit("[a-zA-Z]"))).over(own)
    good = (some("role") > 0) & (some("star_no") + some("unit") > 0) & (some("name") > 0) & (letters("role") > 2) & (letters("name") > 2)
    return personnel.withColumn("_g", good).where("_g").drop("_g")


def report_records(words: DataFrame, least_conf: float = 0.5) -> DataFrame:
    """docid and json: one nested record per document that has all three parts and no issue."""
    words = words.dropDuplicates([DOC, "docpg", "line_id", "word_id", "text", "x0", "y0", "x1", "y1", "section"])
    lines, cells = incident_lines(words), personnel_cells(words)
    incident = report_incidents(lines).where("iucr is not null").groupBy(DOC, "incident_date").agg(F.sort_array(F.collect_list(F.struct("iucr_id", "iucr"))).alias("incident"))
    people = usable_personnel(report_personnel(cells)).groupBy(DOC).agg(F.sort_array(F.collect_list(F.struct("row", *PERSONNEL))).alias("personnel"))
    told = report_narratives(words).where(F.col("narrative_conf") >= least_conf).select(DOC, F.array(F.struct("narrative_conf", "narrative")).alias("narrative"))
    whole = incident.join(people, DOC).join(told, DOC)
    for review in (incidents_in_review(lines), personnel_in_review(cells)):
        whole = whole.join(review.select(DOC), DOC, "left_anti")
    return whole.groupBy(DOC).agg(F.to_json(F.sort_array(F.collect_list(F.struct("incident_date", "incident", "personnel", "narrative"))), {"pretty": "true"}).alias("json"))


def report_issues(words: DataFrame) -> DataFrame:
    """docid, suspected_issues (distinct, in order, joined)."""
    issues = incidents_in_review(incident_lines(words)).unionByName(personnel_in_review(personnel_cells(words)))
    return issues.groupBy(DOC).agg(distinct_sorted_concat(F.col("suspected_issue")).alias("suspected_issues"))
