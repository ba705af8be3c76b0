"""Whole jobs, and tasks whose memory depends on one page or workbook, not on how many there are."""

import datetime
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navspark.functions.shared import PART, binary_parts, text_parts
from navspark.operators import calendar
from navspark.plans import registry
from navspark.sources import html


@pytest.fixture()
def small_batches(spark):
    """Batches of two rows for Python, so that a page or a workbook is never in one of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, 2)
    yield
    spark.conf.unset(name)


def test_calendar_of_every_key(spark, sf):
    day = datetime.date(2024, 3, 10)
    rows = [("a", datetime.datetime(2024, 3, 9, 5)), ("b", datetime.datetime(2024, 3, 10)), ("b", None), (None, datetime.datetime(2024, 3, 8))]
    df = spark.createDataFrame(rows, "k string, d timestamp_ntz")
    found = calendar.availability_calendar(df, "d", day, 2, ["k"]).collect()
    assert {(r.k, r.date.day): r.available for r in found} == {("a", 8): 0, ("a", 9): 1, ("b", 8): 0, ("b", 9): 0, (None, 8): 1, (None, 9): 0}
    assert len(found) == 6
    assert registry.availability_calendar(spark, sf).count() == 40 * 5


def test_parts(spark):
    texts = [None, "", "a", "é\n😀" * PART, "x" * (3 * PART), "y" * (3 * PART + 1)]
    df = spark.createDataFrame([(t, None if t is None else bytearray(t.encode())) for t in texts], "t string, b binary")
    for r in df.select("t", "b", text_parts(F.col("t")).alias("p"), binary_parts(F.col("b")).alias("q")).collect():
        for value, parts, empty in ((r.t, r.p, ""), (r.b, r.q, b"")):
            assert parts[-1] is None and None not in parts[:-1] and all(0 < len(x) <= PART for x in parts[:-1])
            assert empty.join(map(type(empty), parts[:-1])) == (value or empty)


def test_pages_in_parts(spark, small_batches):
    spanned = lambda k: "<table><tr><th>a<th>b" + "".join(f"<tr><td rowspan=2>{k}-{i}<td>x<tr><td>y" for i in range(200)) + "</table>"
    plain = "<table><tr><th>a</th></tr><tr><td>p</td></tr></table>"
    pages = [("n", None), ("e", ""), ("s1", spanned(1)), ("p1", plain), ("s2", spanned(2)), ("p2", plain), ("t", "no table")]
    got: dict[str, list] = {}
    for r in html.table_rows(spark.createDataFrame(pages, "file string, html string").coalesce(1)).orderBy("line_no").collect():
        got.setdefault(r.file, []).append((r.line_no, r.cells))
    want = {f"s{k}": [(2 * i + j, [f"{k}-{i}", "xy"[j]]) for i in range(200) for j in (0, 1)] for k in (1, 2)}
    assert got == want | {p: [(0, ["p"])] for p in ("p1", "p2")}


def test_many_pages_are_scanned_in_little_memory():
    page = "<table>" + "<tr><td rowspan=1>a<td>b" * 2000 + "</table>"
    parts = [page[i : i + PART] for i in range(0, len(page), PART)] + [None]
    tracemalloc.start()
    rows = sum(len(x) for array in html._scanned.func(pa.array(parts, pa.string()) for _ in range(60)) for x in array.drop_null())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60 * 2000 and peak < 8e6
