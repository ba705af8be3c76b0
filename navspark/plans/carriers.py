"""Shared tables in the shape of reports and messages, so that operators run on them.

A rendered report or message holds a bounded number of rows (REPORT orders,
parts or events); their number grows with the table.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspark.sources import workbook

REPORT = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _td(*cells: Column | None) -> Column:
    parts: list[Column] = [F.lit("<tr>")]
    for c in cells:
        parts += [F.lit("<td>"), F.lit("") if c is None else c, F.lit("</td>")]
    return F.concat(*parts, F.lit("</tr>"))


def _banner(text: Column, columns: int) -> Column:
    return F.concat(F.lit(f'<tr><td colspan="{columns}"><b>'), text, F.lit("</b></td></tr>"))


def _page(rows: DataFrame, key: str, order: str, html: Column, columns: int, skipped: bool) -> DataFrame:
    head = "<html><body><table border=1><tr>" + "<th>Title</th>" * columns + "</tr>"
    if skipped:
        head += f'<tr><td colspan="{columns}">Open Ended Schemes &amp; more</td></tr>'
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), html.alias("h"))))  # at most REPORT rows
    body = F.array_join(F.transform(lines, lambda x: x["h"]), "\n")
    return rows.groupBy(key).agg(F.concat(F.lit(head), body, F.lit("</table></body></html>")).alias("html"))


def _changed(c: Column, key: str, order: str) -> Column:
    return ~c.eqNullSafe(F.lag(c).over(Window.partitionBy(key).orderBy(order)))


def order_reports(orders: DataFrame) -> DataFrame:
    """(file, html): NAV reports; house = priority, fund = status, NAV = total price."""
    house, fund = F.concat("o_orderpriority", F.lit(" Mutual Fund")), F.col("o_orderstatus")
    rows = orders.withColumn("file", F.concat(F.lit("r"), F.expr(f"o_orderkey div {REPORT}")))
    rows = rows.withColumns({"new_house": _changed(F.col("o_orderpriority"), "file", "o_orderkey"), "new_fund": _changed(fund, "file", "o_orderkey")})
    html = F.concat(
        F.when(F.col("new_house"), _banner(house, 4)).otherwise(""),
        F.when(F.col("new_fund"), _banner(fund, 4)).otherwise(""),
        _td(money(F.col("o_totalprice")), None, None, F.date_format("o_orderdate", "dd-MMM-yyyy")),
    )
    return _page(rows, "file", "o_orderkey", html, 4, True)


def part_reports(part: DataFrame) -> DataFrame:
    """(file, html): scheme reports; category from type and brand, house from size."""
    rows = part.withColumn("file", F.concat(F.lit("r"), F.expr(f"p_partkey div {REPORT}")))
    kind = F.concat(F.lit("Open Ended Schemes("), "p_type", F.lit(" - "), "p_brand", F.lit(")"))
    house = F.concat((F.col("p_size") % 5).cast("string"), F.lit(" Mutual Fund"))
    rows = rows.withColumns({"new_kind": _changed(kind, "file", "p_partkey"), "new_house": _changed(house, "file", "p_partkey")})
    growth = F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("INF"), F.col("p_partkey").cast("string"), F.lit("A")))
    reinv = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("INF"), F.col("p_partkey").cast("string"), F.lit("B")))
    html = F.concat(
        F.when(F.col("new_kind"), _banner(kind, 5)).otherwise(""),
        F.when(F.col("new_house"), _banner(house, 5)).otherwise(""),
        _td(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")), growth, reinv, money(F.col("p_retailprice")), F.lit("01-Nov-2024")),
    )
    return _page(rows, "file", "p_partkey", html, 5, False)


def event_navs(events: DataFrame) -> DataFrame:
    """Flat NAV rows: house = type, fund = user, NAV = value."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("amc_mutual_fund"),
        F.col("user_id").cast("string").alias("mutual_fund_name"),
        F.col("value").cast("string").alias("nav"),
        F.date_format("ts", "dd-MMM-yyyy").alias("nav_upload_date_time"),
        F.col("ts").alias("timestamp"),
    )


def spoiled_navs(events: DataFrame) -> DataFrame:
    """The same rows with a NAV that is no number in one of ten, and a date that is none in another."""
    return event_navs(events).withColumns(
        {
            "nav": F.when(F.col("id") % 10 == 0, "N.A.").otherwise(F.col("nav")),
            "nav_upload_date_time": F.when(F.col("id") % 10 == 1, "today").otherwise(F.col("nav_upload_date_time")),
        }
    )


def disclosure_pages(supplier: DataFrame) -> DataFrame:
    """(nation, html): a page for each nation, its suppliers in a table inside a section, under a menu and beside another section."""
    key, name = F.col("s_suppkey").cast("string"), F.replace("s_name", F.lit("#"), F.lit(" &amp; "))
    title = F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit(' title=" '), name, F.lit(' "'))).otherwise("")
    link = F.concat(F.lit('<a href=" /fund/'), key, F.lit('"'), title, F.lit(">x</a> <a href='/more/"), key, F.lit("'>y</a>"))
    cell = F.when(F.col("s_suppkey") % 5 == 0, F.lit("none")).otherwise(link)
    row = F.concat(F.lit('<tr><td class="wide fund">'), cell, F.lit('</td><td class="other"><a href="/other">o</a></td></tr>'))
    rows = F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("o"), row.alias("h"))))
    table = F.concat(F.lit('<table class="funds">'), F.array_join(F.transform(rows, lambda x: x["h"]), "\n"), F.lit("</table>"))
    menu = '<body><ul><li><a href="/menu">m</a></li></ul><table class="x"><tr><td class="fund"><a href="/no">n</a></td></tr></table>'
    list_file = F.concat(F.lit('<section id="tab2"><h2><a href="/list-'), F.col("nation").cast("string"), F.lit('.xlsx">l</a> <a href="/b">b</a></h2></section>'))
    page = F.concat(F.lit(menu + '<div id="divMonthlyPortfolio">'), table, F.lit("</div>"), list_file, F.lit('<a href="/end">e</a></body>'))
    return supplier.withColumn("nation", F.col("s_nationkey")).groupBy("nation").agg(page.alias("html"))


def nested_pages(supplier: DataFrame) -> DataFrame:
    """(nation, html): a section with sections inside and a table with tables in its cells; most end tags and quotes are left out."""
    key = F.col("s_suppkey").cast("string")
    block = F.concat(
        F.lit("<div><div>1</div><a href=/fund/"), key, F.lit("> x</a><!-- <a href=/no>n</a> --></div><a data-href=/no name=n>n</a><A title='"),
        F.col("s_name"), F.lit(" &gt; x' HREF=/more/"), key, F.lit(">y</A>"),
    )
    cell = F.concat(
        F.lit('<tr><td class="fund wide"><table><tr><td class=fun><a data-href=/no>n</a><a href=/fund/'), key,
        F.lit(">x</a><td class='fund'><a href='/more/"), key, F.lit("'>y</a></table><td><a href=/other>o</a>"),
    )
    rows = F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("o"), block.alias("b"), cell.alias("c"))))
    joined = lambda part: F.array_join(F.transform("rows", lambda x: x[part]), "\n")
    grouped = supplier.withColumn("nation", F.col("s_nationkey")).groupBy("nation").agg(rows.alias("rows"))
    head, table = "<body><a href=/menu>m</a></div><div class=x id=divMonthlyPortfolio>", "</div><a href=/after>a</a><table class='a funds'>"
    return grouped.select("nation", F.concat(F.lit(head), joined("b"), F.lit(table), joined("c"), F.lit("</table><div><a href=/end>e</a>")).alias("html"))


def spanned_pages(orders: DataFrame) -> DataFrame:
    """(file, html): tables of the orders of some customers, the customer in a cell that spans its rows."""
    rows = orders.withColumn("file", F.concat(F.lit("r"), F.expr(f"o_custkey div {REPORT // 10}")))
    own = Window.partitionBy("file", "o_custkey")
    first = F.row_number().over(own.orderBy("o_orderkey")) == 1
    span = F.when(F.count("*").over(own) == 1, "").otherwise(F.concat(F.lit(" rowspan="), F.count("*").over(own).cast("string")))
    name = F.when(first, F.concat(F.lit("<td"), span, F.lit(">&eacute;"), F.col("o_custkey").cast("string"))).otherwise("")
    note = F.when(F.col("o_orderkey") % 3 == 0, "<!-- <td>x -->").otherwise("")
    line = F.concat(F.lit("<tr>"), name, F.lit("<td>"), "o_orderpriority", F.lit(" &#8211; "), F.col("o_orderkey").cast("string"), note, F.lit("<td colspan='2'>"), money(F.col("o_totalprice")))
    made = rows.select("file", F.struct("o_custkey", "o_orderkey", line.alias("h")).alias("x"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), "\n")
    return made.groupBy("file").agg(F.concat(F.lit("<p>x<table><tr><th>c<th>o<th>p<th>q"), lines, F.lit("</table><table><tr><td>no</table>")).alias("html"))


def write_books(rows: DataFrame, folder: str, name: str, order: list[str], sheets: Callable[[list[dict]], dict[str, list[list[object]]]]) -> None:
    """Writes a workbook of the shared folder for each value of ``name``, with the ``sheets`` of its rows; a task holds the rows of one workbook."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder) if "://" in folder else (LocalFileSystem(), folder.removeprefix("file:"))
        fs.create_dir(root, recursive=True)
        each = (row for batch in batches for row in batch.to_pylist())
        for book, own in itertools.groupby(each, key=lambda row: row[name]):
            with fs.open_output_stream(f"{root}/{book}.xlsx") as out:
                out.write(workbook.write_workbook(sheets(list(own))))
            yield pa.record_batch({"name": [book]})

    rows.repartition(name).sortWithinPartitions(name, *order).mapInArrow(run, "name string").count()
