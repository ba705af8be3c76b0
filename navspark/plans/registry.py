"""Registered queries and, for each, the same result in DuckDB SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.functions import text as X
from navspark.functions.shared import new_folder
from navspark.operators import calendar, contracts, links, messages, points, quotes, report, sheets
from navspark.plans.carriers import (
    REPORT,
    disclosure_pages,
    event_navs,
    money,
    nested_pages,
    order_reports,
    part_reports,
    spanned_pages,
    spoiled_navs,
    table,
    write_books,
)
from navspark.sources import html, tabular, workbook
from navspark.streaming import messages as streams

AS_OF = datetime.datetime(2024, 1, 30)
CALENDAR_DAY = datetime.date(1998, 12, 1)
URL = "https://example.org/nav"
HOST = "https://www.example.org"
CATEGORY = "ECONOMY"
PROMPT = "List the instruments in the text below, separated by commas."


def html_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.table_rows(html.non_empty(order_reports(table(spark, sf_dir, "orders"))))
    return rows.select("file", F.col("line_no").cast("long").alias("line_no"), *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)])


def report_folder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports, landed as one file each and read as a folder."""
    folder = new_folder(spark, "reports")
    pages = order_reports(table(spark, sf_dir, "orders"))
    pages.select(F.col("html").alias("value"), F.col("file").alias("report")).write.partitionBy("report").text(folder)
    landed = html.read_reports(spark, folder).withColumn("file", F.regexp_extract("path", "report=([^/]+)", 1))
    return html.table_rows(html.non_empty(landed)).select(
        "file", F.col("line_no").cast("long").alias("line_no"), *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)]
    )


def nav_value_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = html.table_rows(order_reports(table(spark, sf_dir, "orders")))
    return contracts.nav_value(report.accepted(report.nav_report_flatten(lines, as_of=F.lit(AS_OF).cast("timestamp_ntz"))))


def _nav_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.nav_report_flatten(html.table_rows(html.non_empty(order_reports(table(spark, sf_dir, "orders")))))


def nav_report_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.accepted(_nav_report(spark, sf_dir)).drop("timestamp")


def ffill_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", F.col("value"))
    return report.ffill_chunked(events.select("event_id", "event_type", "value"), "event_id", value, "last_error").select("event_id", "last_error")


def _schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.scheme_report_flatten(html.table_rows(part_reports(table(spark, sf_dir, "part"))))


def scheme_report_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.accepted(_schemes(spark, sf_dir)).drop("line_no")


def scheme_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "scheme-csv")
    nation = table(spark, sf_dir, "nation")
    nation.write.option("header", True).csv(folder)
    return tabular.read_scheme_csv(spark, folder, nation.columns)


def _codes(custkey: Column) -> Column:
    key = custkey.cast("string")
    code = lambda i: F.concat(F.lit(f" INF{i}X"), key)
    kind = custkey % 5
    return (
        F.when(kind == 1, F.concat(F.lit("none"), key)).when(kind == 2, code(1)).when(kind == 3, F.concat(code(1), code(2))).when(kind == 4, F.concat(code(1), code(2), code(3)))
    )


def scheme_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "scheme-master")
    customer = table(spark, sf_dir, "customer")
    columns = [*report.SCHEME_MASTER, report.SCHEME_MASTER_CODES]
    customer.select(
        "c_mktsegment", "c_custkey", "c_name", F.concat("c_name", F.lit(" - Growth")), F.concat(F.lit("Open Ended ("), "c_mktsegment", F.lit(")")), _codes(F.col("c_custkey"))
    ).toDF(*columns).write.option("header", True).csv(folder)
    made = report.scheme_master(tabular.read_scheme_csv(spark, folder, columns))
    return made.toDF("amc", "code", "scheme_name", "scheme_nav_name", "scheme_category", "isin_div_growth", "isin_div_reinv")


def scheme_isin_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", X.isin_split(_codes(F.col("c_custkey"))).alias("s"))
    return rows.select("c_custkey", "s.*")


def fund_header_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    dash = F.concat(F.lit(" Open Ended Schemes ( "), "p_type", F.lit(" - "), "p_brand", F.lit(" )"))
    plain = F.concat(F.lit("Close Ended Schemes("), "p_type", F.lit(")"))
    rows = table(spark, sf_dir, "part").select("p_partkey", X.fund_header(F.when(F.col("p_partkey") % 2 == 0, dash).otherwise(plain)).alias("h"))
    return rows.select("p_partkey", "h.*")


def empty_report_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.non_empty(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "token").select("doc_id")


def nav_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.accepted(points.nav_points(event_navs(table(spark, sf_dir, "events"))))


def nav_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of one house within a day, as the flagship path asks for: the filter reaches the scan."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("measurement"), F.col("user_id").cast("string").alias("mutual_fund_name"), F.col("ts").alias("time"), F.col("value").alias("nav")
    )
    return points.nav_range_query(rows, "error", AS_OF)


def nav_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("amc_mutual_fund"),
        F.col("o_orderstatus").alias("mutual_fund_name"),
        F.when(F.col("o_orderkey") % 10 == 0, "N.A.").when(F.col("o_orderkey") % 10 == 1, "NaN").otherwise(money(F.col("o_totalprice"))).alias("nav"),
        F.when(F.col("o_orderkey") % 10 == 2, "today").otherwise(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("nav_upload_date_time"),
        F.col("o_orderdate").alias("timestamp"),
    )
    return report.rejected(points.nav_points(rows)).groupBy("reject_reason").agg(F.count("*").alias("n_rows"))


def replace_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "replace-table")
    supplier = table(spark, sf_dir, "supplier")
    tabular.replace_table(supplier.where("s_suppkey % 2 = 0"), folder)
    return tabular.replace_table(supplier, folder)


def scheme_info_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.scheme_info(report.accepted(_schemes(spark, sf_dir))).drop("id")


def constraint_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return contracts.null_counts(events, ["event_id", "user_id", "value"])


def constraint_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_TURN = "turn bigint, role string, text string"


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") % 3 != 0, F.col("text")))
    return messages.encode(rows, ["conv_id"], F.lit("conversation"), F.col("turn"), ["turn", "role", "text"])


def message_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversations(spark, sf_dir).select("conv_id", "body")


def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(_conversations(spark, sf_dir), _TURN).select("conv_id", "turn", "role", "text")


def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("routing_key"), F.col("props").alias("body"), "event_id")
    return messages.route(rows, "purchase")


def message_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.shape(_two_shapes(spark, sf_dir), "conv_id")


def _two_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as messages: of two columns where the id is odd, else of three."""
    rows = table(spark, sf_dir, "conversations")
    three = messages.encode(rows.where("conv_id % 2 = 0"), ["conv_id"], F.lit("conversation"), F.col("turn"), ["turn", "role", "text"])
    return three.unionByName(messages.encode(rows.where("conv_id % 2 != 0"), ["conv_id"], F.lit("conversation"), F.col("turn"), ["turn", "role"]))


def stream_message_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "shape-messages")
    messages.publish(_two_shapes(spark, sf_dir), f"{folder}/in")
    return streams.stream_message_shape(spark, f"{folder}/in", "conversation", f"{folder}/out", f"{folder}/state")


def _streamed(spark: SparkSession, navs: DataFrame) -> tuple[DataFrame, DataFrame]:
    folder = new_folder(spark, "nav-messages")
    navs = navs.withColumn("timestamp", F.unix_millis(F.col("timestamp").cast("timestamp")))
    navs = navs.withColumn("part", F.expr(f"id div {REPORT}"))
    record = ["id", "amc_mutual_fund", "mutual_fund_name", "nav", "nav_upload_date_time", "timestamp"]
    messages.publish(messages.encode(navs, ["part"], F.lit("daily_nav_data"), F.col("id"), record), f"{folder}/in")
    return streams.stream_nav_points(spark, f"{folder}/in", "daily_nav_data", f"{folder}/out", f"{folder}/state")


def stream_nav_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, _ = _streamed(spark, event_navs(table(spark, sf_dir, "events")))
    return done.select("measurement", "mutual_fund_name", "db_record_time", "time", "nav")


def stream_nav_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = _streamed(spark, spoiled_navs(table(spark, sf_dir, "events")))
    return rejected.select("measurement", "mutual_fund_name", "nav", "reject_reason")


def stream_report_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "report-messages")
    pages = order_reports(table(spark, sf_dir, "orders"))
    pages.select(F.substring("file", 2, 20).cast("long").alias("msg_id"), "html").write.json(f"{folder}/in")
    return streams.stream_report_replace(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state").select("msg_id", "id", "amc_mutual_fund", "mutual_fund_name", "nav")


def availability_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar for each priority."""
    return calendar.availability_calendar(table(spark, sf_dir, "orders"), "o_orderdate", CALENDAR_DAY, keys=["o_orderpriority"])


def report_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.report_fetch_plan(table(spark, sf_dir, "orders"), "o_orderdate", URL)


def scheme_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.scheme_codes(table(spark, sf_dir, "part"), "p_brand", "p_name")


def latest_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.latest_quote(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "value")


def nav_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.nav_history(table(spark, sf_dir, "events"), "user_id", 8, "ts", "value")


def trailing_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.trailing_return(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey", 12)


def scheme_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-ended schemes of one category: parts, with the prices of their order lines as NAVs."""
    header = F.concat(F.lit("Open Ended Schemes("), "p_type", F.lit(" - "), "p_brand", F.lit(")"))
    schemes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), X.fund_header(header).alias("h")).select("l_partkey", "h.*")
    navs = table(spark, sf_dir, "lineitem").withColumn("tie", F.struct("l_orderkey", "l_linenumber", "l_extendedprice"))
    returns = quotes.trailing_return(navs, "l_partkey", "l_shipdate", "l_extendedprice", "tie", 12)
    made = quotes.scheme_performance(schemes, returns, "l_partkey", "Open Ended Schemes", CATEGORY)
    return made.select("fund_sub_category", "n_schemes", F.round("mean_return", 6).alias("mean_return"), F.round("best_return", 6).alias("best_return"))


def _workbooks(spark: SparkSession, sf_dir: str, name: str, active_only: bool = False) -> DataFrame:
    """Rows of a table put in workbooks of at most REPORT rows (under a header) and a second sheet, read back from a folder as rows of cells."""
    rows = table(spark, sf_dir, name)
    key, columns = rows.columns[0], rows.columns
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    lines = rows.select(F.concat(F.lit("b"), F.expr(f"{key} div {REPORT}")).alias("book"), F.col(key).alias("o"), cells.alias("cells"))
    folder = new_folder(spark, "workbooks")
    write_books(lines, folder, "book", ["o", "cells"], lambda x: {"Sheet": [columns, *[r["cells"] for r in x]], "Count & more": [["rows"], [str(len(x))]]})
    rows = workbook.workbook_rows(workbook.read_workbooks(spark, folder), active_only)
    return rows.withColumn("path", F.regexp_extract("path", r"([^/]+)\.xlsx$", 1))


def xlsx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every sheet."""
    rows = _workbooks(spark, sf_dir, "customer")
    return rows.select("path", "sheet", F.col("row_idx").cast("long").alias("row_idx"), F.get("cells", F.lit(0)).alias("c0"), F.get("cells", F.lit(1)).alias("c1"))


def xlsx_active_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _workbooks(spark, sf_dir, "supplier", active_only=True)
    return rows.select("path", "sheet", F.get("cells", F.lit(0)).alias("c0"), F.get("cells", F.lit(1)).alias("c1"))


def xlsx_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, dates and booleans in cells: orders in workbooks of at most REPORT rows, read back as texts with their kinds."""
    book = F.concat(F.lit("b"), F.expr(f"o_orderkey div {REPORT}"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), book.alias("book"))
    folder = new_folder(spark, "typed-workbooks")
    write_books(rows, folder, "book", ["o_orderkey", "o_orderdate"], lambda x: {"Orders": [[r["o_orderkey"], r["o_orderdate"], r["o_orderkey"] % 2 == 0] for r in x]})
    made = workbook.workbook_rows(workbook.read_workbooks(spark, folder), widen=False)
    return made.select(*[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(3)], F.concat_ws(",", "kinds").alias("kinds"))


def points_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of points after one of three was sent again with another NAV, and all of those once more."""
    folder, navs = new_folder(spark, "points-merge"), event_navs(table(spark, sf_dir, "events"))
    points.merge_points(report.accepted(points.nav_points(navs)), folder, 1)
    again = navs.where("id % 3 = 0").withColumn("nav", (F.col("nav").cast("double") + 1).cast("string"))
    for written in (2, 2):
        points.merge_points(report.accepted(points.nav_points(again)), folder, written)
    return points.read_points(spark, folder).select("measurement", "mutual_fund_name", "db_record_time", "time", "nav")


def nav_store_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of one house within a day, from a store that is clustered by day."""
    folder = new_folder(spark, "points-store")
    points.write_points(
        table(spark, sf_dir, "events").select(
            F.col("event_type").alias("measurement"), F.col("user_id").cast("string").alias("mutual_fund_name"), F.lit(0).cast("long").alias("db_record_time"), F.col("ts").alias("time"), F.col("value").alias("nav")
        ),
        folder,
    )
    return points.nav_range_query(points.read_points(spark, folder), "error", AS_OF).select("measurement", "mutual_fund_name", "time", "nav")


def queue_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives in one of three queues, bound to two keys, one of which another queue is bound to as well."""
    folder = new_folder(spark, "queues")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("routing_key"), F.concat_ws(":", "event_id", "props").alias("body"))
    messages.publish_to_queues(rows, [("purchase", "sales"), ("purchase", "all queue"), ("error", "all queue"), ("none", "idle")], folder)
    return spark.read.schema("routing_key string, body string").json(messages.queue_path(folder, "all queue"))


def message_decode_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two record types, decoded without naming a field."""
    return messages.decode_any(_two_shapes(spark, sf_dir)).select("conv_id", "idx", "turn", "role", "text")


def stream_report_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML messages, those whose number three divides in a later run: older ones among them replace nothing."""
    folder = new_folder(spark, "late-messages")
    pages = order_reports(table(spark, sf_dir, "orders")).select(F.substring("file", 2, 20).cast("long").alias("msg_id"), "html")
    for late in (False, True):
        pages.where((F.col("msg_id") % 3 == 0) == F.lit(late)).write.mode("append").json(f"{folder}/in")
        done = streams.stream_report_replace(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state")
    return done.select("msg_id", "id", "amc_mutual_fund", "mutual_fund_name", "nav")


def header_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = workbook.promote_header(_workbooks(spark, sf_dir, "nation", active_only=True))
    return named.select(*[F.try_element_at("record", F.lit(c)).alias(c) for c in ("n_nationkey", "n_name", "n_regionkey")])


def sheet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.sheet_text(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", ["turn", "role", "text"])


def instrument_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), "p_name")).when(F.col("p_partkey") % 3 == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("  ")))
    return sheets.instrument_names(table(spark, sf_dir, "part").select(padded.alias(sheets.INSTRUMENT)))


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.prompt_render(table(spark, sf_dir, "documents").select("doc_id", "text"), PROMPT).select("doc_id", "prompt")


def answer_to_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.answer_to_names(table(spark, sf_dir, "documents"), ["doc_id"], "text")


def batch_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        return lambda prompts: [str(len(p)) for p in prompts]

    return sheets.batch_infer(table(spark, sf_dir, "documents"), ["doc_id"], "text", make)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.page_links(table(spark, sf_dir, "pages"), "page_id", F.col("html"))
    return found.select("page_id", F.col("pos").cast("long").alias("pos"), "title", "href", X.absolute_link(HOST, F.col("href")).alias("url"))


def section_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.section_links(disclosure_pages(table(spark, sf_dir, "supplier")), "nation", F.col("html"), "div", "divMonthlyPortfolio")
    return found.select("nation", "title", "href")


def section_first_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.section_first_link(disclosure_pages(table(spark, sf_dir, "supplier")), "nation", F.col("html"), "section", "tab2", "h2")


def cell_first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.cell_first_links(disclosure_pages(table(spark, sf_dir, "supplier")), "nation", F.col("html"), "funds", "fund")
    return found.select("nation", F.col("cell").cast("long").alias("cell"), "href")


def nested_section_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a section with sections inside, without quotes and with attributes that only look like links."""
    found = links.section_links(nested_pages(table(spark, sf_dir, "supplier")), "nation", F.col("html"), "div", "divMonthlyPortfolio")
    return found.select("nation", F.col("pos").cast("long").alias("pos"), "title", "href")


def nested_cell_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First links of cells, some of them inside a table in another cell, without end tags."""
    found = links.cell_first_links(nested_pages(table(spark, sf_dir, "supplier")), "nation", F.col("html"), "funds", "fund")
    return found.select("nation", F.col("cell").cast("long").alias("cell"), "href")


def spanned_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables without end tags, whose first cell spans the rows of one customer, with references and notes inside cells."""
    rows = html.table_rows(spanned_pages(table(spark, sf_dir, "orders")))
    return rows.select("file", F.col("line_no").cast("long").alias("line_no"), *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)])


def page_first_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.page_first_link(table(spark, sf_dir, "pages"), "page_id", F.col("html"))


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.head_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reports to the NAVs of one house in the 400 days before a date: scan, flatten, points, range query."""
    made = report.accepted(points.nav_points(_nav_report(spark, sf_dir)))
    return points.nav_range_query(made, "2-HIGH Mutual Fund", datetime.datetime(1998, 12, 1), datetime.timedelta(days=400)).drop("db_record_time")


QUERIES = {
    f.__name__: f
    for f in (
        html_table_rows, nav_report_flatten, ffill_chunked, scheme_report_flatten, scheme_csv_scan, scheme_isin_clean, fund_header_split,
        empty_report_filter, nav_points, nav_range_query, nav_quarantine, replace_table_roundtrip, scheme_info_table, constraint_not_null,
        constraint_pk, message_encode, message_decode, route_messages, message_shape, stream_nav_points, stream_report_replace,
        availability_calendar, report_fetch_plan, scheme_codes, latest_quote, nav_history, trailing_return, xlsx_rows, header_promote,
        report_folder_rows, nav_value_table, scheme_master, scheme_performance, stream_message_shape, stream_nav_rejects, xlsx_active_rows,
        section_links, section_first_link, cell_first_links, nested_section_links, nested_cell_links, spanned_table_rows,
        xlsx_typed_rows, points_merge, nav_store_query, queue_fan_out, message_decode_any, stream_report_late, sheet_text, instrument_names, prompt_render, answer_to_names, batch_infer, page_links, page_first_link, head_rows, flagship,
    )
}

_ORDERS = f"""o AS (SELECT *, 'r' || (o_orderkey // {REPORT}) AS file,
        row_number() OVER (PARTITION BY o_orderkey // {REPORT} ORDER BY o_orderkey) - 1 AS i,
        o_orderpriority IS DISTINCT FROM lag(o_orderpriority) OVER (PARTITION BY o_orderkey // {REPORT} ORDER BY o_orderkey) AS new_house,
        o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER (PARTITION BY o_orderkey // {REPORT} ORDER BY o_orderkey) AS new_fund
    FROM orders)"""
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_DAY = "strftime(o_orderdate, '%d-%b-%Y')"
_SCHEMES = f"""SELECT 'r' || (p_partkey // {REPORT}) AS file, (p_size % 5) || ' Mutual Fund' AS mutual_fund_name, p_name || ' ' || p_partkey AS scheme_nav_name,
        'Open Ended Schemes' AS fund_type, p_type AS fund_category, p_brand AS fund_sub_category,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'INF' || p_partkey || 'A' END AS isin_div_growth,
        CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'INF' || p_partkey || 'B' END AS isin_div_reinv,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS nav, '01-Nov-2024' AS date FROM part"""
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"

SQL = {
    "html_table_rows": f"""
        WITH {_ORDERS}, l AS (
            SELECT file, -1 AS i, 0 AS k, 'Open Ended Schemes & more' AS c0, 'Open Ended Schemes & more' AS c1, 'Open Ended Schemes & more' AS c2, 'Open Ended Schemes & more' AS c3
            FROM (SELECT DISTINCT file FROM o)
            UNION ALL SELECT file, i, 0, h, h, h, h FROM (SELECT file, i, o_orderpriority || ' Mutual Fund' AS h FROM o WHERE new_house)
            UNION ALL SELECT file, i, 1, h, h, h, h FROM (SELECT file, i, o_orderstatus AS h FROM o WHERE new_fund)
            UNION ALL SELECT file, i, 2, {_PRICE}, NULL, NULL, {_DAY} FROM o)
        SELECT file, row_number() OVER (PARTITION BY file ORDER BY i, k) - 1 AS line_no, c0, c1, c2, c3 FROM l""",
    "nav_report_flatten": f"""
        WITH {_ORDERS} SELECT file, i AS id, o_orderpriority || ' Mutual Fund' AS amc_mutual_fund, o_orderstatus AS mutual_fund_name,
            {_PRICE} AS nav, {_DAY} AS nav_upload_date_time FROM o""",
    "ffill_chunked": """
        SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS)
            OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error FROM events""",
    "scheme_report_flatten": _SCHEMES,
    "scheme_csv_scan": "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation",
    "scheme_isin_clean": """
        SELECT c_custkey, CAST(CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE -1 END AS INTEGER) AS status,
            CASE WHEN c_custkey % 5 IN (2, 3) THEN 'INF1X' || c_custkey ELSE '' END AS isin_div_growth,
            CASE WHEN c_custkey % 5 = 3 THEN 'INF2X' || c_custkey ELSE '' END AS isin_div_reinv FROM customer""",
    "fund_header_split": """
        SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Open Ended Schemes' ELSE 'Close Ended Schemes' END AS fund_type,
            p_type AS fund_category, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS fund_sub_category FROM part""",
    "empty_report_filter": "SELECT doc_id FROM documents WHERE NOT contains(text, 'token')",
    "nav_points": """
        SELECT event_type AS measurement, user_id::VARCHAR AS mutual_fund_name, epoch_us(ts) // 1000 AS db_record_time,
            CAST(date_trunc('day', ts) AS TIMESTAMP) AS time, value AS nav FROM events WHERE value IS NOT NULL""",
    "nav_range_query": """
        SELECT event_type AS measurement, user_id::VARCHAR AS mutual_fund_name, ts AS time, value AS nav FROM events
        WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-30 00:00:00'""",
    "nav_quarantine": """
        SELECT CASE WHEN o_orderkey % 10 IN (0, 1) THEN 'nav_not_numeric' ELSE 'bad_date' END AS reject_reason, count(*) AS n_rows
        FROM orders WHERE o_orderkey % 10 IN (0, 1, 2) GROUP BY 1""",
    "replace_table_roundtrip": "SELECT * FROM supplier",
    "scheme_info_table": f"""
        SELECT mutual_fund_name, scheme_nav_name AS scheme_name, fund_type, fund_category, fund_sub_category,
            coalesce(isin_div_growth, '') AS isin_div_growth, coalesce(isin_div_reinv, '') AS isin_div_reinv,
            TIMESTAMP '2024-11-01 00:00:00' AS record_date FROM ({_SCHEMES})""",
    "constraint_not_null": """
        SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS n_null FROM events
        UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM events
        UNION ALL SELECT 'value', count(*) FILTER (event_type = 'error' OR value IS NULL) FROM events""",
    "constraint_pk": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "message_encode": """
        SELECT conv_id, '{' || string_agg('"' || turn || '":{"turn":' || turn || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"text":'
            || CASE WHEN turn % 3 <> 0 AND text IS NOT NULL THEN CAST(to_json(text) AS VARCHAR) ELSE 'null' END || '}', ',' ORDER BY turn) || '}' AS body
        FROM conversations GROUP BY conv_id""",
    "message_decode": "SELECT conv_id, turn, role, CASE WHEN turn % 3 <> 0 THEN text END AS text FROM conversations",
    "route_messages": "SELECT event_type AS routing_key, props AS body, event_id FROM events WHERE event_type = 'purchase'",
    "message_shape": "SELECT conv_id, count(*) AS n_rows, CAST(CASE WHEN conv_id % 2 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_cols FROM conversations GROUP BY conv_id",
    "stream_message_shape": "SELECT count(*) AS n_rows, CAST(CASE WHEN conv_id % 2 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_cols FROM conversations GROUP BY conv_id",
    "stream_nav_rejects": """
        SELECT event_type AS measurement, user_id::VARCHAR AS mutual_fund_name, CASE WHEN event_id % 10 = 1 THEN value END AS nav,
            CASE WHEN event_id % 10 = 1 AND value IS NOT NULL THEN 'bad_date' ELSE 'nav_not_numeric' END AS reject_reason
        FROM events WHERE event_id % 10 IN (0, 1) OR value IS NULL""",
    "nav_value_table": f"""
        WITH {_ORDERS} SELECT i AS id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS nav, o_orderpriority || ' Mutual Fund' AS amc_mutual_fund,
            md5(o_orderpriority || ' Mutual Fund' || chr(31) || o_orderstatus) AS mutual_fund_id, o_orderstatus AS mutual_fund_name,
            TIMESTAMP '2024-01-30 00:00:00' AS timestamp, {_DAY} AS nav_upload_date_time FROM o""",
    "scheme_master": """
        SELECT c_mktsegment AS amc, c_custkey::VARCHAR AS code, c_name AS scheme_name, c_name || ' - Growth' AS scheme_nav_name,
            'Open Ended (' || c_mktsegment || ')' AS scheme_category,
            CASE WHEN c_custkey % 5 IN (2, 3) THEN 'INF1X' || c_custkey ELSE '' END AS isin_div_growth,
            CASE WHEN c_custkey % 5 = 3 THEN 'INF2X' || c_custkey ELSE '' END AS isin_div_reinv FROM customer""",
    "scheme_performance": f"""
        WITH n AS (SELECT l_partkey, l_shipdate AS t, l_extendedprice AS v, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS k FROM lineitem),
        l AS (SELECT l_partkey, max(t) AS t1, arg_max(v, k) AS latest FROM n GROUP BY l_partkey),
        b AS (SELECT n.l_partkey, arg_max(v, k) AS base FROM n JOIN l USING (l_partkey) WHERE t <= t1 - INTERVAL 12 MONTH GROUP BY n.l_partkey)
        SELECT p_brand AS fund_sub_category, count(*) AS n_schemes, round(avg(latest / base - 1), 6) AS mean_return, round(max(latest / base - 1), 6) AS best_return
        FROM part JOIN l ON l.l_partkey = p_partkey JOIN b ON b.l_partkey = p_partkey WHERE p_type = '{CATEGORY}' GROUP BY p_brand""",
    "stream_report_replace": f"""
        WITH {_ORDERS} SELECT o_orderkey // {REPORT} AS msg_id, i AS id, o_orderpriority || ' Mutual Fund' AS amc_mutual_fund,
            o_orderstatus AS mutual_fund_name, {_PRICE} AS nav FROM o WHERE o_orderkey // {REPORT} = (SELECT max(o_orderkey // {REPORT}) FROM orders)""",
    "availability_calendar": """
        SELECT p AS o_orderpriority, CAST(d AS DATE) AS date,
            CAST(EXISTS (SELECT 1 FROM orders WHERE o_orderpriority IS NOT DISTINCT FROM p AND CAST(o_orderdate AS DATE) = CAST(d AS DATE)) AS INTEGER) AS available
        FROM (SELECT DISTINCT o_orderpriority AS p FROM orders), range(DATE '1998-10-22', DATE '1998-12-01', INTERVAL 1 DAY) t(d)""",
    "report_fetch_plan": f"SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, '{URL}?fDate=' || strftime(o_orderdate, '%Y-%b-%d') AS url FROM orders",
    "scheme_codes": "SELECT DISTINCT p_brand AS code, p_name AS scheme_name FROM part",
    "latest_quote": "SELECT user_id, arg_max(ts, (ts, event_id)) AS time, arg_max(value, (ts, event_id)) AS nav FROM events GROUP BY user_id",
    "nav_history": "SELECT user_id, ts AS time, value AS nav FROM events WHERE user_id = 8",
    "trailing_return": """
        WITH l AS (SELECT o_custkey, max(o_orderdate) AS t, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS latest_nav FROM orders GROUP BY o_custkey),
        b AS (SELECT o.o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS base_nav FROM orders o JOIN l USING (o_custkey)
              WHERE o_orderdate <= t - INTERVAL 12 MONTH GROUP BY o.o_custkey)
        SELECT o_custkey, latest_nav, base_nav, latest_nav / base_nav - 1 AS trailing_return FROM l JOIN b USING (o_custkey)""",
    "xlsx_rows": f"""
        WITH c AS (SELECT *, 'b' || (c_custkey // {REPORT}) AS path FROM customer)
        SELECT path, 'Sheet' AS sheet, row_number() OVER (PARTITION BY path ORDER BY c_custkey) AS row_idx, c_custkey::VARCHAR AS c0, c_name AS c1 FROM c
        UNION ALL SELECT DISTINCT path, 'Sheet', 0, 'c_custkey', 'c_name' FROM c
        UNION ALL SELECT DISTINCT path, 'Count & more', 0, 'rows', NULL FROM c
        UNION ALL SELECT path, 'Count & more', 1, count(*)::VARCHAR, NULL FROM c GROUP BY path""",
    "xlsx_active_rows": f"""
        SELECT 'b' || (s_suppkey // {REPORT}) AS path, 'Sheet' AS sheet, s_suppkey::VARCHAR AS c0, s_name AS c1 FROM supplier
        UNION ALL SELECT DISTINCT 'b' || (s_suppkey // {REPORT}), 'Sheet', 's_suppkey', 's_name' FROM supplier""",
    "xlsx_typed_rows": """
        SELECT o_orderkey::VARCHAR AS c0, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS c1, CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS c2,
            'number,date,boolean' AS kinds FROM orders""",
    "points_merge": """
        WITH p AS (SELECT event_type AS measurement, user_id::VARCHAR AS mutual_fund_name, epoch_us(ts) // 1000 AS db_record_time,
            CAST(date_trunc('day', ts) AS TIMESTAMP) AS time, value, event_id % 3 = 0 AS again FROM events WHERE value IS NOT NULL)
        SELECT measurement, mutual_fund_name, db_record_time, time, coalesce(max(value + 1) FILTER (again), max(value)) AS nav FROM p GROUP BY ALL""",
    "queue_fan_out": "SELECT event_type AS routing_key, concat_ws(':', event_id, props) AS body FROM events WHERE event_type IN ('purchase', 'error')",
    "message_decode_any": "SELECT conv_id, turn::VARCHAR AS idx, turn, role, CASE WHEN conv_id % 2 = 0 THEN text END AS text FROM conversations",
    "header_promote": "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation",
    "sheet_text": r"""
        SELECT conv_id, 'turn' || chr(9) || 'role' || chr(9) || 'text' || chr(10) || string_agg(turn || chr(9) || coalesce(role, '') || chr(9) || coalesce(text, ''), chr(10) ORDER BY turn) AS text
        FROM conversations GROUP BY conv_id""",
    "instrument_names": """
        SELECT trim(name) AS name FROM (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN ' ' || p_name WHEN 1 THEN p_name ELSE p_name || '  ' END AS name FROM part) WHERE name IS NOT NULL""",
    "prompt_render": rf"""
        SELECT doc_id, '{PROMPT}' || chr(10) || chr(10) || array_to_string(string_split_regex(text, '\s+')[1:512], ' ') AS prompt FROM documents""",
    "answer_to_names": rf"""
        SELECT * FROM (SELECT doc_id, {_STRIP.format("name")} AS name FROM (SELECT doc_id, unnest(string_split(text, ',')) AS name FROM documents)) WHERE name <> ''""",
    "batch_infer": "SELECT doc_id, CAST(length(coalesce(text, '')) AS VARCHAR) AS answer FROM documents",
    "page_links": r"""
        WITH t AS (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>', 1) AS hs FROM pages)
        SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, 'No Title' AS title, hs[i] AS href, CASE WHEN starts_with(hs[i], '/') THEN 'https://www.example.org' ELSE '' END || hs[i] AS url
        FROM (SELECT page_id, hs, unnest(range(1, len(hs) + 1)) AS i FROM t) WHERE trim(hs[i]) <> ''""",
    "section_links": """
        WITH s AS (SELECT * FROM supplier WHERE s_suppkey % 5 <> 0)
        SELECT s_nationkey AS nation, CASE WHEN s_suppkey % 3 <> 0 THEN replace(s_name, '#', ' & ') ELSE 'No Title' END AS title, '/fund/' || s_suppkey AS href FROM s
        UNION ALL SELECT s_nationkey, 'No Title', '/more/' || s_suppkey FROM s UNION ALL SELECT s_nationkey, 'No Title', '/other' FROM supplier""",
    "section_first_link": "SELECT DISTINCT s_nationkey AS nation, '/list-' || s_nationkey || '.xlsx' AS href FROM supplier",
    "cell_first_links": """
        SELECT nation, cell, href FROM (SELECT s_nationkey AS nation, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS cell,
            ' /fund/' || s_suppkey AS href, s_suppkey FROM supplier) WHERE s_suppkey % 5 <> 0""",
    "nested_section_links": """
        WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i FROM supplier)
        SELECT s_nationkey AS nation, 2 * i AS pos, 'No Title' AS title, '/fund/' || s_suppkey AS href FROM s
        UNION ALL SELECT s_nationkey, 2 * i + 1, s_name || ' > x', '/more/' || s_suppkey FROM s""",
    "nested_cell_links": """
        WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i FROM supplier)
        SELECT s_nationkey AS nation, 2 * i AS cell, '/fund/' || s_suppkey AS href FROM s
        UNION ALL SELECT s_nationkey, 2 * i + 1, '/more/' || s_suppkey FROM s""",
    "spanned_table_rows": f"""
        WITH o AS (SELECT *, 'r' || (o_custkey // {REPORT // 10}) AS file FROM orders)
        SELECT file, row_number() OVER (PARTITION BY file ORDER BY o_custkey, o_orderkey) - 1 AS line_no, 'é' || o_custkey AS c0, o_orderpriority || ' – ' || o_orderkey AS c1,
            {_PRICE} AS c2, {_PRICE} AS c3 FROM o""",
    "page_first_link": r"""
        SELECT page_id, regexp_extract(html, '<a\s[^>]*href="([^"]*)"[^>]*>', 1) AS href FROM pages WHERE regexp_matches(html, '<a\s[^>]*href="')""",
    "head_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "flagship": f"""
        SELECT o_orderpriority || ' Mutual Fund' AS measurement, o_orderstatus AS mutual_fund_name, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS time,
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS nav FROM orders
        WHERE o_orderpriority = '2-HIGH' AND date_trunc('day', o_orderdate) >= TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 400 DAY
            AND date_trunc('day', o_orderdate) < TIMESTAMP '1998-12-01 00:00:00'""",
}
SQL["nav_store_query"] = SQL["nav_range_query"]
SQL["stream_report_late"] = SQL["stream_report_replace"]
SQL["stream_nav_points"] = SQL["nav_points"]
SQL["report_folder_rows"] = SQL["html_table_rows"]
