"""Workbooks (XLSX): one task reads one workbook, as its archive cannot be split, row by row."""

from __future__ import annotations

import datetime
import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspark.functions.shared import binary_parts

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows that a task hands on at once.
BATCH_ROWS = 2000
#: The number formats that need no declaration and show a date or a time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every workbook under ``path``, whatever folders they are in."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _root(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(z.read(name))


def _strings(z: zipfile.ZipFile) -> list[str]:
    """The shared strings, without phonetic hints; they are read piece by piece."""
    out: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as file:
            for _, e in ElementTree.iterparse(file):
                if e.tag == f"{_MAIN}si":
                    out.append(_plain(e))
                    e.clear()
    return out


def _plain(e: ElementTree.Element) -> str:
    return "".join(t.text or "" for x in [e, *e.iterfind(f"{_MAIN}r")] for t in x.iterfind(f"{_MAIN}t"))


def _shows_date(code: str) -> bool:
    """Whether a number format has a part of a date or a time outside quotes, escapes and brackets other than of elapsed time."""
    bare = re.sub(r'"[^"]*"|[\\_*].|\[(?!(?:h+|m+|s+)\])[^\]]*\]', "", code.split(";")[0], flags=re.I)
    return bool(re.search("[dmyhs]", bare, re.I))


def _date_styles(z: zipfile.ZipFile) -> list[str | None]:
    """For each cell style ``date`` or ``elapsed`` if its numbers are dates, times or spans of time, else None."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = _root(z, "xl/styles.xml")
    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iterfind(f"{_MAIN}numFmts/{_MAIN}numFmt")}
    kind = lambda n: ("elapsed" if re.search(r"\[(h+|m+|s+)\]", codes.get(n, ""), re.I) or n == 46 else "date") if n in DATE_FORMATS and n not in codes or _shows_date(codes.get(n, "")) else None
    return [kind(int(x.get("numFmtId", 0))) for x in root.iterfind(f"{_MAIN}cellXfs/{_MAIN}xf")]


def _moment(number: float, from_1904: bool) -> str:
    """The date, the time, or both, that a serial number stands for; day 60 of the older calendar never was."""
    if not from_1904 and 0 <= number < 1 or from_1904 and number == 0:
        return (datetime.datetime(1900, 1, 1) + datetime.timedelta(milliseconds=round(number * 86_400_000))).time().isoformat()
    first = datetime.datetime(1904, 1, 1) if from_1904 else datetime.datetime(1899, 12, 31 if number < 60 else 30)
    return (first + datetime.timedelta(milliseconds=round(number * 86_400_000))).isoformat(" ")


def _value(c: ElementTree.Element, shared: list[str], styles: list[str | None], from_1904: bool) -> tuple[str | None, str | None]:
    """(text, kind) of a cell: string, number, boolean, error, date or elapsed; both null if it is empty."""
    v, kind = c.find(f"{_MAIN}v"), c.get("t", "n")
    if kind == "inlineStr":
        own = c.find(f"{_MAIN}is")
        return ("" if own is None else _plain(own)), "string"
    if v is None or v.text is None:
        return None, None
    if kind == "s":
        return shared[int(v.text)], "string"
    if kind == "b":
        return ("TRUE" if v.text.strip() in ("1", "true") else "FALSE"), "boolean"
    if kind == "e":
        return v.text, "error"
    if kind == "d":
        return v.text.replace("T", " "), "date"
    style = int(c.get("s", 0))
    shown = styles[style] if kind == "n" and style < len(styles) else None
    try:
        if shown == "date":
            return _moment(float(v.text), from_1904), "date"
        if shown == "elapsed":
            return str(datetime.timedelta(milliseconds=round(float(v.text) * 86_400_000))), "elapsed"
    except (ValueError, OverflowError):
        pass  # no date that a calendar has: the number itself
    return v.text, "number" if kind == "n" else "string"


def _rows(content: bytes | io.BytesIO, active_only: bool) -> Iterator[tuple[str, int, list[str | None], list[str | None]]]:
    """(sheet, row number, cells, kinds), row by row: no sheet is held as a whole. A row ends with its last cell."""
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as z:
        shared, styles = _strings(z), _date_styles(z)
        book = _root(z, "xl/workbook.xml")
        about, view = book.find(f"{_MAIN}workbookPr"), book.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
        from_1904 = about is not None and about.get("date1904", "0") in ("1", "true")
        active = int(view.get("activeTab", 0)) if view is not None else 0
        targets = {r.get("Id"): r.get("Target") for r in _root(z, "xl/_rels/workbook.xml.rels")}
        for k, sheet in enumerate(book.iterfind(f"{_MAIN}sheets/{_MAIN}sheet")):
            target = targets[sheet.get(_REL)]
            if active_only and k != active or not (target.startswith("/xl/") or target.startswith("worksheets/")):
                continue
            last = -1
            with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as file:
                parents: list[ElementTree.Element] = []
                for event, e in ElementTree.iterparse(file, ("start", "end")):
                    if event == "start":
                        parents.append(e)
                        continue
                    parents.pop()
                    if e.tag != f"{_MAIN}row":
                        continue
                    cells: dict[int, tuple[str | None, str | None]] = {}
                    for c in e.iterfind(f"{_MAIN}c"):
                        cells[_column(c.get("r")) if c.get("r") else max(cells, default=-1) + 1] = _value(c, shared, styles, from_1904)
                    last = int(e.get("r", last + 2)) - 1
                    line = [cells.get(i, (None, None)) for i in range(max(cells, default=-1) + 1)]
                    yield sheet.get("name"), last, [v for v, _ in line], [t for _, t in line]
                    if parents:
                        parents[-1].remove(e)


def workbook_rows(books: DataFrame, active_only: bool = False, widen: bool = True) -> DataFrame:
    """(path, sheet, row_idx, cells, kinds) of each row of each sheet, or only of the active sheets.

    Cells are texts: numbers as they are stored, dates as ``2024-11-01 00:00:00``,
    booleans as TRUE or FALSE, errors as they are shown; ``kinds`` says which.
    Workbooks come to Python in parts, one of them is held at a time; its rows are
    read one by one and handed on in batches. With ``widen`` all rows of
    a sheet get the width of its widest, which takes a shuffle of widths.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, content = ["path", "sheet", "row_idx", "cells", "kinds"], io.BytesIO()
        for frame in frames:
            for path, part in zip(frame["path"], frame["part"], strict=True):
                if part is not None:
                    content.write(part)
                    continue
                rows, content = _rows(content, active_only), io.BytesIO()
                while batch := list(itertools.islice(rows, BATCH_ROWS)):
                    yield pd.DataFrame([(path, *r) for r in batch], columns=names)

    parts = books.select("path", F.explode_outer(binary_parts(F.col("content"))).alias("part"))
    rows = parts.mapInPandas(run, "path string, sheet string, row_idx int, cells array<string>, kinds array<string>")
    if not widen:
        return rows
    width = F.max(F.size("cells")).over(Window.partitionBy("path", "sheet"))
    wider = lambda c: F.concat(c, F.array_repeat(F.lit(None).cast("string"), F.col("nv_width") - F.size(c)))
    return rows.withColumn("nv_width", width).select("path", "sheet", "row_idx", wider("cells").alias("cells"), wider("kinds").alias("kinds"))


def _cell(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, datetime.datetime):
        return f'<c s="1"><v>{(v - datetime.datetime(1899, 12, 30)) / datetime.timedelta(days=1)!r}</v></c>'
    if isinstance(v, int | float):
        return f"<c><v>{v!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'


def write_workbook(sheets: dict[str, list[list[object]]]) -> bytes:
    """A minimal workbook of inline strings, numbers, booleans and dates (after February 1900)."""
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr(
            "[Content_Types].xml",
            f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            f'<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>',
        )
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        links = "".join(f'<Relationship Id="r{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}<Relationship Id="styles" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{_MAIN[1:-1]}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        names = "".join(f'<sheet name="{escape(s)}" sheetId="{k}" r:id="r{k}"/>' for k, s in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        for k, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{n}">' + "".join(map(_cell, row)) + "</row>" for n, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'{head}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def _distinct_titles(titles: Column) -> Column:
    """Titles of columns, repeated ones numbered so that no two are equal; null titles stay null."""

    def free(taken: Column, title: Column) -> Column:
        numbers = F.sequence(F.lit(1), F.size(taken) + 1)
        return F.array_min(F.filter(numbers, lambda k: ~F.array_contains(taken, F.concat(title, F.lit("."), k.cast("string")))))

    def add(done: Column, title: Column) -> Column:
        known = F.filter(F.concat(done, titles), lambda t: t.isNotNull())
        other = F.concat(title, F.lit("."), free(known, title).cast("string"))
        return F.concat(done, F.array(F.when(title.isNotNull() & F.array_contains(done, title), other).otherwise(title)))

    return F.aggregate(titles, F.array().cast("array<string>"), add)


def promote_header(rows: DataFrame) -> DataFrame:
    """(path, sheet, row_idx, record): each later row as a map from the texts of row 0 of its sheet.

    A title that stands there again gets a number: ``NAV``, ``NAV.1``, ``NAV.2``,
    the next that no other column has.
    """
    header = rows.where("row_idx = 0").select("path", "sheet", _distinct_titles(F.col("cells")).alias("header"))
    named = rows.where("row_idx > 0").join(header, ["path", "sheet"])
    known = F.filter(F.arrays_zip("header", "cells"), lambda x: x["header"].isNotNull())
    return named.select("path", "sheet", "row_idx", F.map_from_entries(F.transform(known, lambda x: F.struct(x["header"], x["cells"]))).alias("record"))
