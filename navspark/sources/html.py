"""HTML reports: files to table rows."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.functions import markup as M
from navspark.functions.shared import text_parts
from navspark.functions.text import missing_to_null, plain_number, strip

#: What a page says that has no report for its date.
NO_RECORDS = "No records to display"
#: The widest cell and the longest row span that HTML knows.
MAX_COLUMNS, MAX_ROWS = 1000, 65534


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, html) of every file under ``path``, whatever folders they are in."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("html"))


def non_empty(reports: DataFrame, body: str = "html", phrase: str = NO_RECORDS) -> DataFrame:
    """Reports with records; to be used before anything is parsed. A null body has none."""
    return reports.where(~F.col(body).contains(phrase))


def _values(cells: Column) -> Column:
    """Cell texts as values. Each step reads the array before it, so no chain is evaluated twice."""
    plain = F.transform(cells, lambda c: F.when(c.contains("&"), M.decode_references(c)).otherwise(c))
    single = F.transform(plain, lambda c: F.when(c.rlike(r"[\r\n]|(?U:\s{2})"), F.regexp_replace(c, r"(?U)[\r\n]+|\s{2,}", " ")).otherwise(c))
    trimmed = F.transform(single, lambda c: F.when(c.rlike(r"^[^!-~]|[^!-~]$"), strip(c)).otherwise(c))
    numbers = F.transform(trimmed, lambda c: F.when(c.contains(","), plain_number(c)).otherwise(c))
    return F.transform(numbers, missing_to_null)


def _columns(attributes: Column) -> Column:
    """How many columns a cell with these attributes takes."""
    found = F.regexp_extract(attributes, r"(?is)(?:^|[\s/\x22\x27])colspan\s*=\s*[\x22\x27]?\s*\+?(\d{1,9})", 1).try_cast("int")
    return F.when(attributes == "", 1).otherwise(F.least(F.greatest(F.coalesce(found, F.lit(1)), F.lit(1)), F.lit(MAX_COLUMNS)))


_SECTIONS = {"thead": 0, "tbody": 1, "tfoot": 3}
_TAG = re.compile(r"(?is)<(/?)(table|thead|tbody|tfoot|tr|td|th)\b((?:[^>\x22\x27]+|\x22[^\x22]*\x22|\x27[^\x27]*\x27)*)>")
_SPAN = re.compile(r"(?is)(?:^|[\s/\x22\x27])(col|row)span\s*=\s*[\x22\x27]?\s*\+?(\d{1,9})")


def _scan(page: str) -> list[list[str]]:
    """Rows of the first table of a page, by its tags: those inside a table in a cell only end where that table does."""
    parts: dict[int, list] = {0: [], 1: [], 2: [], 3: []}
    depth, rank, row, cell, at = 0, 2, None, None, 0
    for m in _TAG.finditer(page):
        if cell is not None:
            cell[0].append(page[at : m.start()])
        at, ends, name = m.end(), bool(m[1]), m[2].lower()
        if name == "table":
            depth = max(depth - 1, 0) if ends else depth + 1
            if ends and depth == 0 and any(parts.values()):
                return [line for part in (parts[0], parts[1] + parts[2], parts[3]) for line in _filled(part)]
        elif depth == 1 and name in ("td", "th"):
            cell = None
            if not ends:
                if row is None:
                    parts[rank].append(row := [])
                spans = {k.lower(): int(v) for k, v in reversed(_SPAN.findall(m[3]))}
                cell = ([], min(max(spans.get("col", 1), 1), MAX_COLUMNS), min(max(spans.get("row", 1), 1), MAX_ROWS))
                row.append(cell)
        elif depth == 1:
            cell = row = None
            if name == "tr" and not ends:
                parts[rank].append(row := [])
            elif name != "tr":
                rank = 2 if ends else _SECTIONS[name]
    if cell is not None:
        cell[0].append(page[at:])
    return [line for part in (parts[0], parts[1] + parts[2], parts[3]) for line in _filled(part)]


def _filled(rows: list) -> list[list[str]]:
    """Rows of a head, a body or a foot, in which a cell that spans rows keeps its columns in the rows below.

    Rows that only spans reach are added, rows without cells are none.
    """
    out: list[list[str]] = []
    held: list[tuple[int, int, str, int]] = []  # column, number, text, rows left: what spans put in the next row
    for row in rows:
        if row or held:
            held = _place(out, held, [("".join(texts), columns, spanned) for texts, columns, spanned in row])
    while held:
        held = _place(out, held, [])
    return out


def _place(out: list[list[str]], held: list[tuple[int, int, str, int]], cells: list[tuple[str, int, int]]) -> list[tuple[int, int, str, int]]:
    line: list[str] = []
    after: list[tuple[int, int, str, int]] = []

    def put(text: str, rows: int) -> None:
        if rows > 1:
            after.append((len(line), len(after), text, rows - 1))
        line.append(text)

    heapq.heapify(held)
    for text, columns, rows in cells:
        while held and held[0][0] <= len(line):
            put(*heapq.heappop(held)[2:])
        for _ in range(columns):
            put(text, rows)
    while held:
        put(*heapq.heappop(held)[2:])
    out.append(line)
    return after


_ROWS = pa.list_(pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of a page at the null behind its parts, else null; the parts of a page follow each other, one page is held at a time."""
    page: list[str] = []
    for batch in batches:
        made, n = [pa.nulls(0, _ROWS)], 0  # n: rows of the batch since those made
        for part in batch.to_pylist():
            if part is not None:
                page.append(part)
            elif page:
                made += [pa.nulls(n, _ROWS), pa.array([_scan("".join(page))], _ROWS)]
                page, n = [], -1
            n += 1
        yield pa.concat_arrays([*made, pa.nulls(n, _ROWS)])


_CELL = r"(?is)<t[dh]\b([^>]*)>(.*?)</t[dh]>"
#: A table row whose cells are all closed, without quotes that hold a bracket, and nothing beside them.
_PLAIN_ROW = r"(?is)^<tr\b[^>\x22\x27]*+>\s*+(?:<t[dh]\b(?:[^<>\x22\x27]++|\x22[^<>\x22]*+\x22|\x27[^<>\x27]*+\x27)*+>(?:[^<]++|<(?!/?t(?:[dhr]|able|head|body|foot)\b))*+</t[dh]>\s*+)++</tr>\s*+$"


def _with_plain_rows(pages: DataFrame) -> DataFrame:
    """``pages`` with nv_rows: the rows of a page's first table, and nv_plain: it is written out in full, without row spans or tables inside.

    Each column is used more than once above, so that Spark computes it once.
    """
    table = F.regexp_extract("nv_html", r"(?is)^(?:[^<]++|<(?!/?table\b))*+<table\b[^>\x22\x27]*+>\s*+(?:<tbody>)?(.*?)(?:</tbody>\s*+)?</table>", 1)
    cut = pages.withColumn("nv_rows", F.filter(F.split(table, r"(?i)(?=<tr\b)", -1), lambda p: ~p.rlike(r"^\s*$")))
    return cut.withColumn("nv_plain", F.coalesce((F.size("nv_rows") > 0) & ~F.col("nv_html").rlike("(?i)rowspan") & F.forall("nv_rows", lambda p: p.rlike(_PLAIN_ROW)), F.lit(False)))


def table_rows(reports: DataFrame, *keys: str) -> DataFrame:
    """``keys`` (``file`` if none are given), line_no and cells of the first table of each page.

    Lines count from 0 after the header row; rows without cells are none. Rows
    of a head come first, those of a foot last. A cell that spans columns or
    rows is repeated in each of them; missing texts become null. End tags may be
    left out, and a cell outside a row begins one. The text of a table inside a
    cell is part of that cell. Each row of ``reports`` is a page of its own. Pages
    that Python scans reach it in parts, so that its memory does not depend on
    how many pages there are.
    """
    keys = keys or ("file",)
    pages = _with_plain_rows(reports.select(*keys, M.visible(F.col("html")).alias("nv_html")))
    parts = F.explode_outer(text_parts(F.when(~F.col("nv_plain"), F.col("nv_html"))))
    parted = pages.select(*keys, F.when(F.col("nv_plain"), F.col("nv_rows")).alias("nv_rows"), parts.alias("nv_part"))
    item = "array<struct<row: string, texts: array<string>>>"
    plain = F.transform("nv_rows", lambda r: F.struct(r, F.lit(None))).cast(item)
    other = F.transform(_scanned("nv_part"), lambda t: F.struct(F.lit(None), t)).cast(item)
    items = parted.select(*keys, F.coalesce(plain, other).alias("nv_items"))
    rows = items.select(*keys, F.posexplode_outer("nv_items").alias("nv_pos", "nv_item")).where("nv_pos > 0")  # an inner one computes its input twice more
    rows = rows.select(*keys, (F.col("nv_pos") - 1).alias("line_no"), F.col("nv_item.row").alias("nv_row"), F.col("nv_item.texts").alias("nv_texts"))
    found = F.when(F.col("nv_row").isNotNull(), F.regexp_extract_all("nv_row", F.lit(_CELL), F.lit(2))).otherwise(F.col("nv_texts"))
    read = rows.select(*keys, "line_no", "nv_row", _values(F.transform(found, M.without_tags)).alias("nv_values"))
    widths = F.transform(F.regexp_extract_all("nv_row", F.lit(_CELL), F.lit(1)), _columns)
    spread = F.flatten(F.zip_with("nv_values", widths, F.array_repeat))
    return read.select(*keys, "line_no", F.when(F.col("nv_row").rlike("(?i)colspan"), spread).otherwise(F.col("nv_values")).alias("cells"))


def head_rows(lines: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order, by a distributed top-n."""
    return lines.orderBy(*order).limit(n)
