"""Cell texts of a workbook's first sheet, for use inside a Spark task."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show a date or a time.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_NOT_LETTERS = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def first_sheet(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as texts; numbers and dates as a CSV has them.

    Trailing empty rows are left out, empty rows in between are kept.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        workbook = ET.fromstring(book.read("xl/workbook.xml"))
        properties = workbook.find(f"{_MAIN}workbookPr")
        since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        day_zero = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)
        strings = _shared_strings(book)
        date_styles = _date_styles(book)
        waiting = 0
        with book.open(_first_sheet_path(book, workbook)) as sheet:
            expected, table = 1, None
            for event, element in ET.iterparse(sheet, ("start", "end")):
                if event == "start":
                    table = element if element.tag == f"{_MAIN}sheetData" else table
                    continue
                if element.tag != f"{_MAIN}row":
                    continue
                number = int(element.get("r", expected))
                cells = _row(element, strings, date_styles, day_zero)
                waiting += number - expected
                expected = number + 1
                table.clear()  # rows done with, so that memory stays flat
                if all(c is None for c in cells):
                    waiting += 1
                    continue
                yield from ([] for _ in range(waiting))
                waiting = 0
                yield cells


def _first_sheet_path(book: zipfile.ZipFile, workbook: ET.Element) -> str:
    wanted = workbook.find(f"{_MAIN}sheets/{_MAIN}sheet").get(f"{_REL}id")
    for link in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == wanted:
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("workbook names no first sheet")


def _text(element: ET.Element) -> str:
    """All runs of a rich text, without its reading aids."""
    parts = []
    for child in element:
        if child.tag == f"{_MAIN}t":
            parts.append(child.text or "")
        elif child.tag == f"{_MAIN}r":
            parts.extend(t.text or "" for t in child.findall(f"{_MAIN}t"))
    return "".join(parts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return [_text(item) for item in ET.fromstring(book.read("xl/sharedStrings.xml"))]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Positions of the cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ET.fromstring(book.read("xl/styles.xml"))
    formats = set(_DATE_FORMATS)
    for custom in styles.iter(f"{_MAIN}numFmt"):
        if re.search("[dmhysDMHYS]", _NOT_LETTERS.sub("", custom.get("formatCode", ""))):
            formats.add(int(custom.get("numFmtId")))
    used = styles.findall(f"{_MAIN}cellXfs/{_MAIN}xf")
    return {i for i, xf in enumerate(used) if int(xf.get("numFmtId", 0)) in formats}


def _row(
    row: ET.Element, strings: list[str], date_styles: set[int], day_zero: dt.datetime
) -> list[str | None]:
    cells: list[str | None] = []
    for cell in row.findall(f"{_MAIN}c"):
        column = _column(cell.get("r")) if cell.get("r") else len(cells)
        cells.extend([None] * (column - len(cells)))
        cells.append(_value(cell, strings, date_styles, day_zero))
    return cells


def _column(reference: str) -> int:
    """0 for ``A7``, 27 for ``AB7``."""
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _value(
    cell: ET.Element, strings: list[str], date_styles: set[int], day_zero: dt.datetime
) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell.find(f"{_MAIN}is"))
    stored = cell.findtext(f"{_MAIN}v")
    if stored is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(stored)]
    if kind == "b":
        return "True" if stored == "1" else "False"
    if kind != "n":
        return stored
    number = float(stored)
    if int(cell.get("s", 0)) in date_styles:
        moment = day_zero + dt.timedelta(milliseconds=round(number * 86_400_000))
        return str(moment.date()) if moment.time() == dt.time() else str(moment.replace(microsecond=0))
    return str(int(number)) if number.is_integer() else repr(number)
