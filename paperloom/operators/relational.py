"""Joins, upserts and set operations over the record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.ordinals import global_ordinals


def narratives_view(cells: DataFrame, pdfs: DataFrame, pages: DataFrame, include_review_remarks: bool = False) -> DataFrame:
    """Narrative cells with their pdf and page. ``cells`` has filename-equal pdf_name and page_num.

    The remarks of incident reviews are left out unless asked for: the source of this view
    compares two literals there, which never holds.
    """
    is_ = lambda s, c: (F.col("section_name") == s) & (F.col("column_name") == c)
    wanted = (
        is_("Accused Members", "Initial / Intake Allegation")
        | is_("Incident Finding / Overall Case Finding", "Finding")
        | is_("Current Allegations", "Allegation")
    )
    if include_review_remarks:
        wanted = wanted | is_("Review Incident", "Remarks")
    p = pdfs.select("cr_id", F.col("filename").alias("pdf_name"), F.col("id").alias("pdf_id"), "doccloud_url")
    pp = pages.select(F.col("id").alias("page_id"), "pdf_id", "page_num")
    return (
        cells.where(wanted & F.col("text").isNotNull()).join(p, "pdf_name").join(pp, ["pdf_id", "page_num"])
        .select("cr_id", "pdf_name", "pdf_id", "page_id", F.col("row_id").alias("summary_data_id"), "page_num", "section_name", "column_name", "text", "doccloud_url")
    )


def insert_ignore(known: DataFrame, new: DataFrame, keys: list[str], id_column: str = "id") -> DataFrame:
    """``known`` with the rows of ``new`` whose keys it lacks, ids counted on in key order.

    Of new rows with equal keys the first in order of all columns is taken; null keys never
    conflict with each other.
    """
    fields = [c for c in known.columns if c != id_column]
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in fields])
    fresh = new.join(known.select(*keys), keys, "left_anti")
    fresh = fresh.withColumn("_rank", F.when(some_null, 1).otherwise(F.row_number().over(first))).where("_rank = 1").drop("_rank")
    top = known.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    fresh = global_ordinals(fresh.select(*fields), [*keys, *[c for c in fields if c not in keys]], "_n").crossJoin(F.broadcast(top))  # one row
    fresh = fresh.withColumn(id_column, (F.col("_top") + F.col("_n") + 1).cast(known.schema[id_column].dataType))
    return known.unionByName(fresh.select(*known.columns))


def log_number(filename: Column) -> Column:
    """The second part of a name such as LOG_1000045.pdf or LOG 1000045.pdf, as a number."""
    return F.when(filename.like("LOG_%"), F.try_element_at(F.split(filename, "[_ .]"), F.lit(2)).try_cast("int"))


def update_log_numbers(pdfs: DataFrame, batch_data: DataFrame | None = None) -> DataFrame:
    """cr_id set from batch data by log_number, then from the file name, then from batch data by
    its own file name; a later source wins. Of several matches the smallest number is taken."""
    out = pdfs
    if batch_data is not None:
        by_log = batch_data.where(F.col("log_number").like("%LOG%")).select(
            F.concat("prod_begin", F.lit(".pdf")).alias("filename"), F.split_part("log_number", F.lit("_"), F.lit(2)).try_cast("int").alias("_a")
        ).groupBy("filename").agg(F.min("_a").alias("_a"))
        by_name = batch_data.where(F.col("filename").like("%LOG%")).select(
            F.concat("prod_begin", F.lit(".pdf")).alias("_f"),
            F.split_part(F.split_part("filename", F.lit("_"), F.lit(2)), F.lit("."), F.lit(1)).try_cast("int").alias("_c"),
        ).groupBy("_f").agg(F.min("_c").alias("_c")).withColumnRenamed("_f", "filename")
        out = out.join(by_log, "filename", "left").join(by_name, "filename", "left")
    else:
        out = out.withColumns({"_a": F.lit(None).cast("int"), "_c": F.lit(None).cast("int")})
    return out.withColumn("cr_id", F.coalesce("_c", log_number(F.col("filename")), "_a", "cr_id").cast("int")).select(*pdfs.columns)


def update_page_class(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``pages`` with page_classification replaced where ``found`` has (pdf_id, page_num)."""
    one = found.groupBy("pdf_id", "page_num").agg(F.min("page_classification").alias("_new"), F.lit(True).alias("_hit"))
    return pages.join(one, ["pdf_id", "page_num"], "left").withColumn(
        "page_classification", F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("page_classification"))
    ).select(*pages.columns)


def pending_uploads(batches: DataFrame, pdfs: DataFrame) -> DataFrame:
    """dropbox_path, filename, cr_id of the pdfs without an address yet."""
    return pdfs.where(F.col("doccloud_url").isNull()).join(
        batches.select(F.col("id").alias("batch_id"), "dropbox_path"), "batch_id"
    ).select("dropbox_path", "filename", "cr_id")


def pending_titles(files: DataFrame, titles: DataFrame) -> DataFrame:
    """filename of ``files`` whose lower-case base name is no title (compared in lower case)."""
    base = F.lower(F.regexp_replace(F.element_at(F.split("filename", "/"), -1), r"(?i)\.pdf$", ""))
    known = titles.select(F.lower("title").alias("_t")).distinct()
    return files.withColumn("_t", base).join(known, "_t", "left_anti").select("filename")


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each value of ``by`` in the given order."""
    w = Window.partitionBy(*by).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def missing_pages(pdfs: DataFrame, pages: DataFrame) -> DataFrame:
    """filename, expected, present, missing (array) of the pdfs that lack a page of 1..page_count.

    Files without a page count are unknown and not listed.
    """
    wanted = pdfs.where("page_count >= 1").select(F.col("id").alias("pdf_id"), "filename", "page_count", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page_num"))
    there = pages.select("pdf_id", "page_num").distinct().withColumn("have", F.lit(1))
    return (
        wanted.join(there, ["pdf_id", "page_num"], "left").groupBy("pdf_id", "filename", "page_count")
        .agg(F.count("have").alias("present"), F.sort_array(F.collect_list(F.when(F.col("have").isNull(), F.col("page_num")))).alias("missing"))
        .where(F.size("missing") > 0)
        .select("filename", F.col("page_count").cast("bigint").alias("expected"), "present", "missing")
    )


def missing_numbers(df: DataFrame, group: str, number: str) -> DataFrame:
    """group and missing: numbers between the least and greatest of each group that don't occur.

    Gaps come from neighbouring numbers, so no list of a group is gathered.
    """
    w = Window.partitionBy(group).orderBy(number)
    gaps = df.where(F.col(number).isNotNull()).select(group, number).distinct().withColumn("_next", F.lead(number).over(w))
    lost = F.sequence((F.col(number) + 1).cast("bigint"), (F.col("_next") - 1).cast("bigint"))
    return gaps.where(F.col("_next") - F.col(number) > 1).select(group, F.explode(lost).alias("missing"))


def fill_sole_missing(pages: DataFrame, begin: int, end: int) -> DataFrame:
    """page_num, control_number: scraped numbers, where exactly one number of begin..end is
    missing the pages without one get its prefix and zeros (the number itself isn't appended).
    """
    found = pages.where(F.col("control_number").isNotNull()).select(
        F.element_at(F.split("control_number", " "), -1).try_cast("bigint").alias("n")
    ).distinct()
    wanted = pages.sparkSession.range(begin, end + 1).select(F.col("id").alias("n"))
    lost = wanted.join(found, "n", "left_anti").agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("lost"))
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(8) - F.length(F.col("lost").cast("string")), F.lit(0)))
    return pages.crossJoin(F.broadcast(lost)).select(  # one row
        "page_num",
        F.when(F.col("control_number").isNull() & (F.col("many") == 1), F.concat(F.lit("CPD "), zeros)).otherwise(F.col("control_number")).alias("control_number"),
    )


def checked_left_join(left: DataFrame, right: DataFrame, on: list[str], same: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(joined, problems): a left join, and the keys that fan out or whose fields disagree.

    problems: on..., problem ('fans out' or 'disagrees'), rows.
    """
    joined = left.join(right, on, "left")
    fans = right.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").join(left.select(*on).distinct(), on, "left_semi")
    problems = fans.select(*on, F.lit("fans out").alias("problem"), "rows")
    if same:
        a, b = same
        off = joined.where(F.col(b).isNotNull() & (F.col(a).isNull() | (F.col(a) != F.col(b))))
        problems = problems.unionByName(off.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).select(*on, F.lit("disagrees").alias("problem"), "rows"))
    return joined, problems


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows by column name, missing columns null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def page_ranges(pages: DataFrame, wanted: str, file: list[str]) -> DataFrame:
    """file..., page_from, page_to, rpt_num of each report of a class.

    A report ends before the next report of any class, the last one at page_count; reports of
    the wanted class are numbered by average rank of their first page.
    """
    w = Window.partitionBy(*file).orderBy("page_num")
    ends = pages.withColumn("page_to", F.lead("page_num").over(w) - 1).where(F.col("page_classification") == wanted)
    ends = ends.withColumn("page_to", F.coalesce("page_to", "page_count"))
    own = Window.partitionBy(*file)
    same = Window.partitionBy(*file, "page_num")
    rank = F.rank().over(own.orderBy("page_num")) + (F.count(F.lit(1)).over(same) - 1) / F.lit(2.0)
    return ends.select(*file, F.col("page_num").alias("page_from"), "page_to", rank.alias("rpt_num"))
