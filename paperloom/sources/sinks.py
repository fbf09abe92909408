"""Sinks: delimited reports, nested documents, one file set per sheet."""

from __future__ import annotations

import posixpath
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a sheet of a workbook can have.
SHEET_ROWS = 1_048_576


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_documents(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in a folder per value of ``by``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def as_one_array(df: DataFrame) -> DataFrame:
    """One row with all rows as a JSON array; for results that are small by nature."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("json"))


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """Each sheet as a CSV folder of its own."""
    for title, df in sheets.items():
        write_report(df, f"{folder}/{title}")


def upload_tables(tables: dict[str, DataFrame], write) -> list[str]:
    """Hand each non-empty table to ``write(name, df)``; the names handed on."""
    done = []
    for name, df in tables.items():
        if not df.isEmpty():
            write(name, df)
            done.append(name)
    return done


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> int:
    """One file per row under ``folder`` (a path or URI that all executors reach): ``name`` may have
    folders, ``content`` is text or bytes. Written by the executors, each under a name of its own
    first, so a repeated task leaves whole files. Rows without a name or content are left out; of
    rows with one name any may stay. Returns the number of rows written."""

    def write(batches):
        from pyarrow import fs as pafs

        system, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        made = None
        for batch in batches:
            for path, data in zip(batch[name], batch[content]):
                target = f"{base}/{path}"
                if (above := posixpath.dirname(target)) != made:
                    system.create_dir(above, recursive=True)
                    made = above
                passing = f"{above}/.{uuid.uuid4().hex}"
                with system.open_output_stream(passing) as out:
                    out.write(data.encode() if isinstance(data, str) else bytes(data))
                system.move(passing, target)
            yield pd.DataFrame({"n": [len(batch)]})

    named = rows.select(name, content).where(F.col(name).isNotNull() & F.col(content).isNotNull())
    return named.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def copy_missing(files: DataFrame, have: DataFrame, folder: str) -> int:
    """Write those of ``files`` (name, content) whose name is not in ``have`` (name) under ``folder``."""
    return write_files(files.join(have.select("name").distinct(), "name", "left_anti"), folder)


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """An XLSX file with a sheet per table, headings first. For reports: rows are streamed through the
    driver, SHEET_ROWS at most, an error beyond."""
    cell = lambda v: (
        "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) and not isinstance(v, bool)
        else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
    )
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    office, package = "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for i, df in enumerate(sheets.values(), 1):
            with book.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                out.write(f"<worksheet {main}><sheetData>".encode())
                for n, row in enumerate(_with_heading(df)):
                    if n >= SHEET_ROWS:
                        raise ValueError(f"more than {SHEET_ROWS - 1} rows for one sheet")
                    out.write(f"<row>{''.join(map(cell, row))}</row>".encode())
                out.write(b"</sheetData></worksheet>")
        names = "".join(f'<sheet name="{escape(t)}" sheetId="{i}" r:id="r{i}"/>' for i, t in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{office}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{links}</Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                      f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')


def _with_heading(df: DataFrame):
    yield df.columns
    yield from df.toLocalIterator()
