"""File sources: token tables, page texts, delimited and nested files, hashes, listings."""

from __future__ import annotations

import posixpath
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.tables import SCHEMAS

#: File names in a row of a listing, bytes of content in an Arrow batch, and tasks a core that read small files.
LISTED, BATCH_BYTES, WAVES = 256, 4 << 20, 8


def file_name(path: Column) -> Column:
    """The last part of a file path or URI, with blanks and signs as they stand."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def _page_of_name() -> tuple[Column, Column]:
    """(pdf_name, page number) of a name such as NAME.pdf.12.tsv."""
    return F.regexp_extract("name", r"^(.*)\.\d+\.[A-Za-z]+$", 1), F.regexp_extract("name", r"\.(\d+)\.[A-Za-z]+$", 1).try_cast("int")


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    """name, content of the files under ``path``: a file, a folder (the files right in it), or a pattern of either.

    For many small files: executors list the folders and read the files, many to a task, and the driver holds
    none of their names. ``path`` lies in a file system that Arrow knows and all executors reach. Hidden files
    (. or _ first) are left out unless named as pages are. A pattern may fit nothing, a plain path must exist.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    parts = path.rstrip("/").split("/")
    globs = [hadoop.GlobPattern(p) for p in parts]
    first = next((i for i, g in enumerate(globs) if g.hasWildcard()), len(parts))
    home = hadoop.Path(re.sub(r"\\(.)", r"\1", "/".join(parts[:first])) or ("/" if first else "."))
    uri = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(home).toUri().toASCIIString()
    uri = re.sub("^s3[an]:", "s3:", uri)
    patterns = [g.compiled().pattern() for g in globs[first:]]

    def system():
        from pyarrow import fs as pafs

        return pafs.FileSystem.from_uri(uri)

    def within(where, folder, pattern=".*"):
        from pyarrow import fs as pafs

        fits = re.compile(pattern, re.DOTALL).fullmatch
        return [i for i in where.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if fits(i.base_name)]

    def rows(pairs):
        import pyarrow as pa

        some = []
        for pair in pairs:
            some.append(pair)
            if len(some) == 1000:
                yield pa.RecordBatch.from_pylist(some)
                some = []
        if some:
            yield pa.RecordBatch.from_pylist(some)

    def folders(pattern):
        def run(batches):
            where, _ = system()
            yield from rows({"folder": i.path} for batch in batches for f in batch.column(0).to_pylist() for i in within(where, f, pattern) if not i.is_file)

        return run

    def files(batches):
        where, base = system()

        def found():
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    infos = within(where, folder, patterns[-1]) if patterns else [where.get_file_info(base)]
                    if not patterns and infos[0].type.name == "NotFound":
                        raise FileNotFoundError(path)
                    kept = {folder if patterns else posixpath.dirname(base): [i.base_name for i in infos if i.is_file]}
                    for i in infos:
                        if not i.is_file:
                            kept[i.path] = [x.base_name for x in within(where, i.path) if x.is_file]
                    for at, names in kept.items():
                        names = [n for n in names if n[0] not in "._" or re.search(r"\.\d+\.[A-Za-z]+$", n)]
                        for k in range(0, len(names), LISTED):
                            yield {"folder": at, "names": names[k : k + LISTED]}

        yield from rows(found())

    def contents(batches):
        import pyarrow as pa

        where, _ = system()
        names, data, size = [], [], 0
        for batch in batches:
            for folder, some in zip(batch.column(0), batch.column(1)):
                for name in some.as_py():
                    with where.open_input_stream(f"{folder.as_py()}/{name}") as file:
                        data.append(file.read())
                    names.append(name)
                    size += len(data[-1]) + 100
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary())], ["name", "content"])
                        names, data, size = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary())], ["name", "content"])

    tasks = WAVES * spark.sparkContext.defaultParallelism
    where = spark.range(0, 1, 1, 1).mapInArrow(lambda batches: rows({"folder": system()[1]} for batch in batches for _ in range(len(batch))), "folder string")
    for pattern in patterns[:-1]:
        where = where.mapInArrow(folders(pattern), "folder string").repartition(tasks)
    return where.mapInArrow(files, "folder string, names array<string>").repartition(tasks).mapInArrow(contents, "name string, content binary")


def read_batch_list(spark: SparkSession, path: str) -> DataFrame:
    """dropbox_path of each non-empty line."""
    return spark.read.text(path).select(F.trim("value").alias("dropbox_path")).where("dropbox_path <> ''")


def read_tokens(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(tokens, rejects) of tab-separated token files with a header row and no quoting.

    tokens: pdf_name, page, seq and the twelve fields; numbers that are none go to rejects
    with their line.
    """
    names = [f.split(" ")[0] for f in SCHEMAS["token_tsv"].split(", ")]
    pdf, page = _page_of_name()
    # the heading is the first line that isn't blank; blank lines are none
    body = F.regexp_replace(F.col("content").cast("string"), r"^([\x00-\x20]*[\r\n])?[^\r\n]*", "")
    rows = read_contents(spark, path).select(pdf.alias("pdf_name"), page.alias("page"), F.explode(F.split(body, r"[\r\n]+")).alias("line")).where(F.col("line").rlike(r"[^\x00-\x20]"))
    # exploded, since the optimizer would write a plain split into every field and every condition on it
    rows = rows.select("pdf_name", "page", F.explode(F.array(F.split("line", "\t"))).alias("fields"))
    raw = rows.select("pdf_name", "page", *[F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])
    numbers = [n for n in names if n != "text"]
    bad = F.lit(False)
    for n in numbers:
        bad = bad | F.col(n).try_cast("int").isNull()
    order = F.struct(*[F.col(n) for n in ("page_num", "block_num", "par_num", "line_num", "word_num")])
    good = raw.where(~bad).select("pdf_name", "page", *[F.col(n).try_cast("int").alias(n) for n in numbers], F.coalesce("text", F.lit("")).alias("text"))
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("pdf_name", "page").orderBy(order, "level", "left", "top", "width", "height", "conf", "text"))
    return good.withColumn("seq", seq), raw.where(bad)


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """pdf_name, page, text of whole page files."""
    pdf, page = _page_of_name()
    return read_contents(spark, path).select(pdf.alias("pdf_name"), page.alias("page"), F.col("content").cast("string").alias("text"))


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.csv(path, sep=sep, header=header, schema=schema)


def read_batch_data(spark: SparkSession, parts: list[tuple[str, list[str]]]) -> DataFrame:
    """Headless CSV files with column lists of their own, as rows of cr_batch_data."""
    fields = [f.strip().split(" ") for f in SCHEMAS["cr_batch_data"].split(", ")]
    out = None
    for path, columns in parts:
        part = spark.read.csv(path, header=False, schema=", ".join(f"`{c}` STRING" for c in columns))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    have = set(out.columns)
    return out.select(*[(F.col(n).try_cast(k) if n in have else F.lit(None).cast(k)).alias(n) for n, k in fields])


def read_form_documents(spark: SparkSession, path: str) -> DataFrame:
    """pdf_name, page_num, sections of a JSON array of form documents."""
    schema = "pdf_name STRING, page_num INT, sections ARRAY<STRUCT<section_name: STRING, columns: ARRAY<STRUCT<col_name: STRING, col_text: STRING>>>>"
    return spark.read.schema(schema).json(path, multiLine=True)


def listed_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """path, length and name of the files whose name ends in pdf; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*pdf").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", file_name(F.col("_metadata.file_path")).alias("name"))


def hashed_files(spark: SparkSession, path: str, digits: int = 8) -> DataFrame:
    """path, sha1, and its first digits as id."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha1("content").alias("sha1")).withColumn("id", F.substring("sha1", 1, digits))


def pdf_page_counts(spark: SparkSession, path: str) -> DataFrame:
    """path and page_count, counted from the page objects of plain PDF files; null where the file
    can't be read that way (compressed object streams)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*pdf").load(path)
    body = F.decode("content", "ISO-8859-1")
    pages = F.regexp_count(body, F.lit(r"/Type\s*/Page[^s]"))
    return files.select("path", F.when(body.startswith("%PDF") & (pages > 0), pages).alias("page_count"))


def finished_pages(listing: DataFrame, pdfs: DataFrame, kinds: tuple[str, ...] = ("tsv", "txt", "png")) -> DataFrame:
    """filename, missing: files lacking one of the kinds for a page of 1..page_count.

    ``listing`` has filename, page, kind.
    """
    wanted = pdfs.where("page_count >= 1").select(
        "filename", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page"), F.array(*[F.lit(k) for k in kinds]).alias("kinds")
    ).select("filename", "page", F.explode("kinds").alias("kind"))
    return wanted.join(listing.select("filename", "page", "kind").distinct(), ["filename", "page", "kind"], "left_anti").groupBy("filename").agg(F.count(F.lit(1)).alias("missing"))


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """filename, page, kind of the page files under ``path``, such as NAME.pdf.12.tsv; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = r"^(.*)\.(\d+)\.([A-Za-z]+)$"
    name = file_name(F.col("_metadata.file_path"))
    return files.select(name.alias("name")).select(
        F.regexp_extract("name", parts, 1).alias("filename"), F.regexp_extract("name", parts, 2).try_cast("int").alias("page"), F.regexp_extract("name", parts, 3).alias("kind")
    ).where("page is not null")


def read_feather(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of Feather files with the columns of ``schema``; a file is read by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def read(batches):
        import pyarrow as pa
        from pyarrow import feather

        for batch in batches:
            for content in batch.column(0):
                yield from feather.read_table(pa.BufferReader(content.as_buffer()), columns=names).to_batches()

    names = [part.strip().split(" ")[0].strip("`") for part in schema.split(",")]
    return files.mapInArrow(read, schema)


def read_database(spark: SparkSession, url: str, table: str, columns: list[str], **options: str) -> DataFrame:
    """Distinct rows of some columns of a database table; the projection is pushed to the database.

    ``options`` are those of the JDBC source, such as partitionColumn with its bounds.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns).distinct()
