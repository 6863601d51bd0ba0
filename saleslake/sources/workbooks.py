"""Branch workbooks (.xlsx) as one distributed table of rows.

Spark lists and reads the files and spreads them over tasks; the Python helper below only
turns the sheets of one workbook into rows. A sheet is parsed as a stream, once.
"""

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from saleslake.schemas import RAW

ROWS_PER_BATCH = 5_000
XLSX_GLOB = "*.[xX][lL][sS][xX]"

# Cell texts that the usual table readers take as missing.
MISSING_TEXTS = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}
# Built-in number formats of the file format that show a date or a time.
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def list_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes of all workbooks below a folder."""
    return _files(spark, root).select("path", "length", "modificationTime")


def read_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all sheets of all workbooks: header and cells of every row as arrays of texts, by column.

    Row 1 stands for the header (it has no cells), so a sheet without data rows is still seen by
    the audit; a sheet without any row has an empty header. An unreadable workbook or sheet is one
    row with its ``error``. Names, contract and clean-up are up to ``operators``.
    """
    return _files(spark, root).select("path", "content").mapInPandas(_rows, RAW)


def _files(spark: SparkSession, root: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", XLSX_GLOB)
    return reader.option("recursiveFileLookup", "true").load(root)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = RAW.fieldNames()
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            rows = []
            for record in _workbook_records(content):
                rows.append((path, *record))
                if len(rows) == ROWS_PER_BATCH:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def _workbook_records(content: bytes) -> Iterator[tuple]:
    """Values of the raw columns after the path, row by row of one workbook."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        strings = _shared_strings(archive)
        date_styles, epoch = _date_styles(archive), _epoch(archive)
        sheets = _sheets(archive)
    except Exception as e:
        yield None, None, None, f"unreadable_workbook: {type(e).__name__}", None, None
        return
    for number, (name, part) in enumerate(sheets):
        header = None
        try:
            for row_no, values in _sheet_rows(archive, part, strings, date_styles, epoch):
                texts = [values.get(i) for i in range(max(values, default=-1) + 1)]
                if header is None:
                    header = texts
                    yield name, number, 1, None, header, None
                else:
                    yield name, number, row_no, None, header, texts
            if header is None:
                yield name, number, 1, None, [], None
        except Exception as e:
            yield name, number, None, f"unreadable_sheet: {type(e).__name__}", None, None


def _sheet_rows(archive, part, strings, date_styles, epoch) -> Iterator[tuple[int, dict]]:
    """Row number and cell texts by column position, row by row from the zip stream."""
    with archive.open(part) as stream:
        row_no = 0
        for _, element in ElementTree.iterparse(stream):
            if element.tag != f"{_MAIN}row":
                continue
            row_no = int(element.get("r", row_no + 1))
            values, column = {}, -1
            for cell in element.iter(f"{_MAIN}c"):
                column = _column(cell.get("r")) if cell.get("r") else column + 1
                text = _cell_text(cell, strings, date_styles, epoch)
                if text is not None and text not in MISSING_TEXTS:
                    values[column] = text
            yield row_no, values
            element.clear()


def _column(reference: str) -> int:
    position = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        position = position * 26 + ord(letter) - ord("A") + 1
    return position - 1


def _cell_text(cell, strings, date_styles, epoch) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n":
        if int(cell.get("s", 0)) in date_styles:
            return _date_text(float(value), epoch)
        return _number_text(value)
    return value


def _number_text(value: str) -> str:
    if re.fullmatch(r"-?\d+", value):
        return value
    number = float(value)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _date_text(serial: float, epoch: datetime) -> str:
    moment = epoch + timedelta(seconds=round(serial * 86_400))
    return moment.strftime("%Y-%m-%d %H:%M:%S")


def _part(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(archive.read(name)) if name in archive.namelist() else None


def _shared_strings(archive) -> list[str]:
    table = _part(archive, "xl/sharedStrings.xml")
    if table is None:
        return []
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in table]


def _date_styles(archive) -> set[int]:
    """Positions of the cell styles whose number format shows a date."""
    styles = _part(archive, "xl/styles.xml")
    if styles is None:
        return set()
    date_ids = set(DATE_FORMAT_IDS)
    for custom in styles.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", custom.get("formatCode", ""))
        if re.search(r"[dmyhs]", code, re.IGNORECASE):
            date_ids.add(int(custom.get("numFmtId")))
    formats = styles.find(f"{_MAIN}cellXfs")
    if formats is None:
        return set()
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in date_ids}


def _epoch(archive) -> datetime:
    properties = _part(archive, "xl/workbook.xml").find(f"{_MAIN}workbookPr")
    since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)


def _sheets(archive) -> list[tuple[str, str]]:
    """Sheet names with their part names, in workbook order."""
    targets = {r.get("Id"): r.get("Target") for r in _part(archive, "xl/_rels/workbook.xml.rels")}
    sheets = []
    for sheet in _part(archive, "xl/workbook.xml").iter(f"{_MAIN}sheet"):
        target = targets[sheet.get(_REL)]
        sheets.append((sheet.get("name"), target[1:] if target.startswith("/") else f"xl/{target}"))
    return sheets
