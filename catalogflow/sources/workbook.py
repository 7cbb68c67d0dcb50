"""Monthly workbooks: one task per file, cells read with the standard library."""

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F

from .. import schemas

# fixed values: parts and namespace of the workbook format
NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
SHEET, STRINGS = "xl/worksheets/sheet1.xml", "xl/sharedStrings.xml"
EPOCH = dt.date(1899, 12, 30)


def _joined(node):
    return "".join(t.text or "" for t in node.iter(f"{NS}t"))


def sheet_rows(content):
    """First sheet of a workbook as dicts of cell text by header name."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if STRINGS in book.namelist():
            shared = [_joined(si) for si in ElementTree.fromstring(book.read(STRINGS)).iter(f"{NS}si")]
        header = None
        for row in ElementTree.fromstring(book.read(SHEET)).iter(f"{NS}row"):
            cells = {}
            for cell in row.iter(f"{NS}c"):
                column = re.match(r"[A-Z]+", cell.get("r")).group()
                value = cell.find(f"{NS}v")
                if cell.get("t") == "inlineStr":
                    cells[column] = _joined(cell)
                elif value is not None:
                    text = value.text
                    cells[column] = shared[int(text)] if cell.get("t") == "s" else text
            if header is None:
                header = cells
            elif cells:
                yield {name: cells.get(column) for column, name in header.items()}


def _day(text):
    """A cell date: a serial day number or an ISO date."""
    if text is None:
        return None
    try:
        return EPOCH + dt.timedelta(days=int(float(text)))
    except ValueError:
        try:
            return dt.date.fromisoformat(text[:10])
        except ValueError:
            return None


def read_workbooks(spark, path, required=("Title",)):
    """Metadata rows of all workbooks below a path, with the file name.

    A file that is no workbook, or lacks a required column, gives no rows.
    """
    names = schemas.RAW_METADATA.fieldNames()
    schema = "`file` string, `row_no` int, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_METADATA.fields
    )

    def load(batches):
        for pdf in batches:
            out = []
            for file, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows = list(sheet_rows(content))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    continue
                for number, row in enumerate(rows):
                    if all(c in row for c in required):
                        values = [_day(row.get(n)) if n == "Date MMDDYY" else row.get(n) for n in names]
                        out.append((file, number, *values))
            yield pd.DataFrame(out, columns=["file", "row_no", *names])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(load, schema).withColumn(
        "file", F.regexp_extract("file", r"([^/]+)$", 1)
    )
