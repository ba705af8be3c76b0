"""Edge rows of the two report layouts, ISIN fields, headers, quarantine."""

import datetime
from html import unescape

import pytest
from pyspark.sql import functions as F

from navspark.functions import markup as M
from navspark.functions import text as X
from navspark.operators import calendar, contracts, links, messages, points, quotes, report, sheets
from navspark.sources import html, workbook
from navspark.streaming import messages as streams


def page(rows, columns, title="T"):
    def tr(cells):
        if isinstance(cells, str):
            return f'<TR><td colspan="{columns}">{cells}</td></TR>'
        return "<tr>" + "".join(f"<td>{'' if c is None else c}</td>" for c in cells) + "</tr>"

    return f"<table><tr>{f'<th>{title}</th>' * columns}</tr>{''.join(map(tr, rows))}</table>"


NAV = [
    ["9.9", None, None, "01-Nov-2024"],
    ["1.0", None, None, "01-Nov-2024"],
    "Alpha Mutual Fund",
    "Alpha Liquid",
    ["12.5", None, None, "01-Nov-2024"],
    ["13.0", "12.9", None, "01-Nov-2024"],
    ["N.A.", None, None, "01-Nov-2024"],
    [None, None, None, None],
    "Beta Mutual Fund",
    ["1,234.5", "&nbsp;", "NA", "01-Nov-2024"],
    ["NaN", None, None, "soon"],
]

SCHEMES = [
    "Open Ended Schemes ( Debt Scheme - Banking - X )",
    "Alpha Mutual Fund",
    ["Scheme NAV Name", "ISIN A", "ISIN B", "Net Asset Value", "Date"],
    ["S1", "INF1", None, "10.1", "01-Nov-2024"],
    ["Beta Mutual Fund", None, None, None, None],
    ["Close Ended Schemes ( Income )", None, None, None, None],
    ["S2", "INF2", "INF3", "11.2", "01-Nov-2024"],
    "Interval Fund Schemes",
]


@pytest.fixture(scope="module")
def nav(spark):
    pages = spark.createDataFrame([("a", page(NAV, 4)), ("b", page(NAV[:2], 4)), ("c", "No records to display"), ("d", None)], "file string, html string")
    return report.nav_report_flatten(html.table_rows(html.non_empty(pages)))


def test_nav_report(nav):
    rows = report.accepted(nav).where("file = 'a'").orderBy("id").select("id", "amc_mutual_fund", "mutual_fund_name", "nav").collect()
    assert [tuple(r) for r in rows] == [
        (0, "Alpha Mutual Fund", "Alpha Liquid", "12.5"),
        (1, "Alpha Mutual Fund", "Alpha Liquid", "N.A."),
        (2, "Alpha Mutual Fund", "Alpha Liquid", None),
        (3, "Beta Mutual Fund", "Alpha Liquid", "1234.5"),
        (4, "Beta Mutual Fund", "Alpha Liquid", None),
    ]
    assert sorted((r.file, r.nav, r.reject_reason) for r in report.rejected(nav).collect()) == [("a", "1.0", "no_context"), ("b", "1.0", "no_context")]


def test_points_and_quarantine(nav):
    made = points.nav_points(nav)
    assert sorted(r.nav for r in report.accepted(made).collect()) == [12.5, 1234.5]
    reasons = sorted(r.reject_reason for r in report.rejected(made).collect())
    assert reasons == ["nav_not_numeric"] * 3 + ["no_context"] * 2


def test_row_order_of_input_does_not_matter(spark, nav):
    lines = html.table_rows(spark.createDataFrame([("a", page(NAV, 4))], "file string, html string"))
    mixed = report.nav_report_flatten(lines.repartition(7).orderBy(F.rand(3)))
    key = lambda df: sorted(map(str, df.drop("timestamp").where("file = 'a'").collect()))
    assert key(mixed) == key(nav)


def test_scheme_report(spark):
    lines = html.table_rows(spark.createDataFrame([("a", page(SCHEMES, 5))], "file string, html string"))
    made = report.scheme_report_flatten(lines)
    rows = report.accepted(made).orderBy("line_no").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("Alpha Mutual Fund", "S1", "Open Ended Schemes", "Debt Scheme", "Banking", "INF1", None, "10.1", "01-Nov-2024"),
        ("Alpha Mutual Fund", "S2", "Close Ended Schemes", "Income", "", "INF2", "INF3", "11.2", "01-Nov-2024"),
    ]
    assert [r.reject_reason for r in report.rejected(made).collect()] == ["bad_fund_header"]
    info = contracts.scheme_info(report.accepted(made))
    assert {r.column_name: r.n_null for r in contracts.null_counts(info, contracts.SCHEME_INFO).collect()}.get("isin_div_reinv") == 0
    assert contracts.duplicate_keys(info, contracts.SCHEME_INFO_KEY).count() == 0
    with pytest.raises(ValueError):
        contracts.conform(info, contracts.NAV_VALUE)


def test_isin_split(spark):
    cases = [(None, 0, "", ""), ("", -1, "", ""), ("ABC", -1, "", ""), ("INF1", 1, "INF1", ""), ("x INF1", 1, "INF1", ""), ("INF1 INF2", 2, "INF1", "INF2"), ("INF1INF2INF3", -1, "", "")]
    rows = spark.createDataFrame([(c[0],) for c in cases], "v string").select(X.isin_split(F.col("v")).alias("s")).collect()
    assert [tuple(r.s) for r in rows] == [c[1:] for c in cases]


def test_strip_takes_any_space(spark):
    row = spark.createDataFrame([("\t a b \n",)], "v string").select(X.strip(F.col("v")).alias("v")).first()
    assert row.v == "a b"


T = "<table><tr><th>h<th>h</tr>{}</table>"
PAGES = {
    "omit": ("<p>x</p><table><tr><th>a<th>b<tr><td>1<td>2<tr><td>3<td>4</table><table><tr><td>no</table>", [["1", "2"], ["3", "4"]]),
    "nested": (T.format("<tr><td>a<table><tr><td>in<td>ner</tr></table>z</td><td>b</td></tr><tr><td>c</td><td>d</td></tr>"), [["ainnerz", "b"], ["c", "d"]]),
    "rows": (T.format('<tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td rowspan="3">e'), [["a", "b"], ["a", "c"], ["d", "e"], ["e"], ["e"]]),
    "both": (T.format("<tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<td>d"), [["a", "a", "b"], ["a", "a", "c", "d"]]),
    "middle": (T.format("<tr><td>a<td rowspan='2'>b<td>c</tr><tr><td>d</td><td>e</td></tr>"), [["a", "b", "c"], ["d", "b", "e"]]),
    "references": (T.format("<tr><td>a &#8211; b<td>caf&eacute; &amp;lt; &#x1F600; &#150; &copy 1 &foo; &nbsp;"), [["a – b", "café &lt; 😀 – © 1 &foo;"]]),
    "hidden": ("<!-- <table><tr><td>c</td></tr></table> --><script>'<table>'</script>" + T.format("<tr><td>1<!-- <td>x --><td>2"), [["1", "2"]]),
    "parts": ("<table><tfoot><tr><td>f</tfoot><thead><tr><th>h</thead><tbody><tr><td>1</tbody><tr><td>2</table>", [["1"], ["2"], ["f"]]),
    "no row": ("</table><table><td>h</td><tr><td>1</td></tr><td>2</td><td>3</td><tr></tr></table>", [["1"], ["2", "3"]]),
    "quoted": (T.format('<tr><td title="a > b" colspan=2>x  y\n z</td></tr>'), [["x y  z", "x y  z"]]),
    "plain": ("<TABLE border=1>\n<tbody><TR><TD>h</TD></TR>\n<tr class='x'><td><b>1</b></td>\n<td COLSPAN='2'>2,000</td></tr></tbody></table>", [["1", "2000", "2000"]]),
    "open": ("<table><tr><td>h<tr><td>1", [["1"]]),
    "none": ("nothing", []),
    "null": (None, []),
}


def test_tables_of_any_form(spark):
    df = spark.createDataFrame([(k, h, "x") for k, (h, _) in PAGES.items()] + [("omit", PAGES["both"][0], "y")], "file string, html string, note string")
    got = {}
    for r in html.table_rows(df, "file", "note").orderBy("line_no").collect():
        got.setdefault((r.file, r.note), []).append(r.cells)
    assert got == {**{(k, "x"): rows for k, (_, rows) in PAGES.items() if rows}, ("omit", "y"): PAGES["both"][1]}
    assert html.table_rows(df.limit(0)).count() == 0


def test_references(spark):
    texts = ["a &#8211; b", "&amp;lt;", "&#x1F600;", "&#150;", "&copy 1", "&notanentity", "&nbsp", "&#0;", "&#xD800;", "&AMP", "plain", "& &x; &#", "&Aacute;&aacute;", "&#99999999;", "&fjlig;"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(M.decode_references(F.col("t")).alias("v")).collect()
    assert [r.v for r in got] == [unescape(t) for t in texts]


def test_links_of_nested_elements(spark):
    pages = {
        1: "<div id=s><div>1</div>2<a href=/1>x</a></div><a href=/out>y</a>",
        2: "<a data-href=/no>n</a><div class='d' id='s'><p><a name=x>x</a><a title=' t &amp; u ' href = '/2?a=1&amp;b=2'>x</a><!--</div>--><a href='/3' title=''>e</a><a href>e</a></p>",
        3: "<table><tr><td id=s><table><tr><td><a href=/4>x</a></table><a href=/5>y</a><td><a href=/out>z</a></table>",
        4: "<div id=t><a href=/out>x</a></div>",
        5: None,
    }
    df = spark.createDataFrame(list(pages.items()), "k long, html string")
    of = lambda tag: sorted((r.k, r.title, r.href) for r in links.section_links(df, "k", F.col("html"), tag, "s").collect())
    assert of("div") == [(1, "No Title", "/1"), (2, "t & u", "/2?a=1&b=2")]
    assert of("td") == [(3, "No Title", "/4"), (3, "No Title", "/5")]
    assert {r.k: r.href for r in links.section_first_link(df, "k", F.col("html"), "div", "s").collect()} == {1: "/1", 2: "/2?a=1&b=2"}
    headed = spark.createDataFrame([(1, "<div id=s><a href=/0>o</a><div><h2>x <a data-href=/no>n</a><a href=/1>a</a></h2></div></div>")], "k long, html string")
    assert links.section_first_link(headed, "k", F.col("html"), "div", "s", "h2").first().href == "/1"
    assert {r.k: r.href for r in links.page_first_link(df, "k", F.col("html")).collect()} == {1: "/1", 2: "/2?a=1&b=2", 3: "/4", 4: "/out"}


def test_cells_inside_cells(spark):
    page_html = (
        "<table class='a t'><tr><td class=x><table><tr><td class='x y'>none<td><a href=/1>a</a></table><a href=/2>b</a>"
        "<td class=x><table><tr><td class=x><a data-href=/no>n</a><a href=/3>c</a></table></td><td><a href=/4>d</a></table><td class=x><a href=/out>o</a>"
    )
    df = spark.createDataFrame([(1, page_html)], "k long, html string")
    assert sorted(tuple(r) for r in links.cell_first_links(df, "k", F.col("html"), "t", "x").collect()) == [(1, 0, "/1"), (1, 2, "/3"), (1, 3, "/3")]


def test_ffill_chunked_equals_one_window(spark):
    rows = [(i, float(i) if i % 37 == 0 and i > 400 else None) for i in range(0, 3000, 3)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.f for r in report.ffill_chunked(df, "k", F.col("v"), "f", chunks=16).collect()}
    last, want = None, {}
    for k, v in rows:
        last = v if v is not None else last
        want[k] = last
    assert got == want
    assert report.ffill_chunked(df.limit(0), "k", F.col("v"), "f").count() == 0


def test_message_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 0, "a", None), (1, 1, None, 2.5)], "k long, i long, a string, b double")
    sent = messages.encode(df, ["k"], F.lit("x"), F.col("i"), ["a", "b"])
    assert sent.first().body == '{"0":{"a":"a","b":null},"1":{"a":null,"b":2.5}}'
    back = messages.decode(sent, "a string, b double").orderBy("idx").select("a", "b").collect()
    assert [tuple(r) for r in back] == [("a", None), (None, 2.5)]
    assert messages.route(sent, "y").count() == 0


def test_points_round_trip_prunes_partitions(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    rows = [(m, "f", 1, day + datetime.timedelta(hours=h), 1.0 * h) for m in ("A", "B") for h in (0, 12, 24)]
    made = spark.createDataFrame(rows, "measurement string, mutual_fund_name string, db_record_time long, time timestamp_ntz, nav double")
    points.write_points(made, str(tmp_path / "p"))
    read = points.nav_range_query(points.read_points(spark, str(tmp_path / "p")), "A", day + datetime.timedelta(days=1))
    assert sorted(r.nav for r in read.collect()) == [0.0, 12.0]
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan and "PushedFilters: [IsNotNull(time)" in plan


def test_instrument_names(spark):
    df = spark.createDataFrame([(" A",), ("A",), ("A",), (None,), ("Name of the Instrument",), (" B",)], f"`{sheets.INSTRUMENT}` string")
    assert sorted(r.name for r in sheets.instrument_names(df).collect()) == ["A", "A", "B"]
    assert sorted(r.name for r in sheets.instrument_names(df, dedup_after_strip=True).collect()) == ["A", "B"]
    with pytest.raises(ValueError):
        sheets.instrument_names(df.toDF("x"))


def test_workbook_forms(spark):
    content = workbook.write_workbook({"One": [["a", "b"], ["1 & 2", None]], "Two": [["x"]], "None": []})
    books = spark.createDataFrame([("w", bytearray(content))], "path string, content binary")
    rows = workbook.workbook_rows(books).orderBy("sheet", "row_idx").collect()
    assert [(r.sheet, r.row_idx, r.cells) for r in rows] == [("One", 0, ["a", "b"]), ("One", 1, ["1 & 2", None]), ("Two", 0, ["x"])]
    assert workbook.workbook_rows(books, active_only=True).count() == 2
    assert workbook.promote_header(workbook.workbook_rows(books)).first().record == {"a": "1 & 2", "b": None}


def test_calendar_and_quotes(spark):
    day = datetime.date(2024, 3, 10)
    df = spark.createDataFrame([(datetime.datetime(2024, 3, 9, 5),), (datetime.datetime(2024, 3, 10),), (None,)], "d timestamp_ntz")
    assert [r.available for r in calendar.availability_calendar(df, "d", day, 3).orderBy("date").collect()] == [0, 0, 1]
    q = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 1, 2, 6.0), ("b", 3, 1, 7.0)], "k string, t int, i int, v double")
    assert {r.k: r.nav for r in quotes.latest_quote(q, "k", "t", "i", "v").collect()} == {"a": 6.0, "b": 7.0}
    assert quotes.nav_history_json(q, "k", "a", "t", "v").first().history == '[{"time":1,"nav":5.0},{"time":1,"nav":6.0}]'


def test_first_link_of_every_cell(spark):
    cell = lambda kind, inner: f"<td class='{kind}'>{inner}</td>"
    body = cell("x", '<a href="/1">a</a><a href="/2">b</a>') + cell("y", '<a href="/3">c</a>') + cell("w x z", "<A HREF='/4'>d</A>") + cell("x", "none") + cell("xx", '<a href="/5">e</a>')
    page_html = f'<a href="/0">o</a><table><tr>{cell("x", "<a href=/9>n</a>")}</tr></table><table class="t"><tr>{body}</tr></table>'
    pages = spark.createDataFrame([(1, page_html), (2, "no table"), (3, None)], "k long, html string")
    assert [tuple(r) for r in links.cell_first_links(pages, "k", F.col("html"), "t", "x").collect()] == [(1, 0, "/1"), (1, 1, "/4")]


def test_shape_is_that_of_the_body(spark):
    sent = spark.createDataFrame([(1, '{"0":{"a":1,"b":null,"c":"x"},"1":{"a":2}}'), (2, "{}"), (3, "no json"), (4, None)], "k long, body string")
    got = {r.k: (r.n_rows, r.n_cols) for r in messages.shape(sent, "k").collect()}
    assert got[1] == (2, 3) and got[2] == (0, 0) and got[3][0] in (None, 0, -1)


def test_records_are_ordered_by_number(spark):
    df = spark.createDataFrame([(1, i) for i in (10, 2, 0, 1, 11)], "k long, i long")
    assert messages.encode(df, ["k"], F.lit("x"), F.col("i"), ["i"]).first().body == '{"0":{"i":0},"1":{"i":1},"2":{"i":2},"10":{"i":10},"11":{"i":11}}'


def test_stream_without_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, html.NO_RECORDS), (2, None)], "msg_id long, html string")
    pages.write.json(f"{tmp_path}/in")
    done = streams.stream_report_replace(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state")
    assert done.count() == 0 and "nav" in done.columns


def test_folders_of_reports_and_workbooks(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "r.html").write_text(page(NAV, 4) if name == "a" else html.NO_RECORDS)
        (tmp_path / name / "w.xlsx").write_bytes(workbook.write_workbook({"One": [["a"], [name]], "Two": [["x"]]}))
    books = workbook.workbook_rows(workbook.read_workbooks(spark, str(tmp_path)))
    assert sorted((r.path.split("/")[-2], r.sheet, r.cells[0]) for r in books.collect()) == sorted((n, *x) for n in "ab" for x in (("One", n), ("One", "a"), ("Two", "x")))
    reports = html.read_reports(spark, f"{tmp_path}/*/r.html")
    assert reports.count() == 2 and html.table_rows(html.non_empty(reports), "path").count() == len(NAV)
