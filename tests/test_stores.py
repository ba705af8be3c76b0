"""Stores, versions, queues, unknown fields, typed workbooks: what happens twice, late, or halfway."""

import datetime
import io
import time
import tracemalloc
import zipfile

from pyspark.sql import functions as F

from navspark.functions.shared import exists
from navspark.operators import messages, points, report
from navspark.sources import tabular, workbook
from navspark.streaming import messages as streams

POINT = "measurement string, mutual_fund_name string, db_record_time long, time timestamp_ntz, nav double"
DAY = datetime.datetime(2024, 1, 1)


def made(spark, rows):
    return spark.createDataFrame([(m, f, 1, DAY + datetime.timedelta(hours=h), v) for m, f, h, v in rows], POINT)


def stored(spark, path):
    return sorted((r.measurement, r.mutual_fund_name or "", (r.time - DAY).total_seconds() // 3600 if r.time else -1, r.nav) for r in points.read_points(spark, path).collect())


def test_points_have_one_row_for_each_identity(spark, tmp_path):
    path = str(tmp_path / "p")
    points.merge_points(made(spark, [("A", "f", 0, 1.0), ("A", "f", 0, 2.0), ("A", "g", 0, 3.0), ("A", "f", 30, 4.0), ("B/ x", None, 0, 5.0)]), path, 1)
    first = [("A", "f", 0, 2.0), ("A", "f", 30, 4.0), ("A", "g", 0, 3.0), ("B/ x", "", 0, 5.0)]
    assert stored(spark, path) == first
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "p" / "measurement=A" / "day=2024-01-02").iterdir()}
    points.merge_points(made(spark, [("A", "f", 0, 9.0), ("A", "h", 1, 7.0)]), path, 2)
    points.merge_points(made(spark, [("A", "f", 0, 1.5)]), path, 1)  # an older one comes late
    after = [("A", "f", 0, 9.0), ("A", "f", 30, 4.0), ("A", "g", 0, 3.0), ("A", "h", 1, 7.0), ("B/ x", "", 0, 5.0)]
    assert stored(spark, path) == after
    assert {f: f.stat().st_mtime_ns for f in untouched} == untouched
    points.merge_points(made(spark, []), path, 3)
    assert stored(spark, path) == after


def test_a_merge_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    points.merge_points(made(spark, [("A", "f", 0, 1.0)]), path, 1)
    with monkeypatch.context() as m:
        m.setattr(points, "_put", lambda *_: None)  # staged, not yet put in place
        points.merge_points(made(spark, [("A", "f", 0, 2.0), ("A", "g", 0, 2.0)]), path, 2)
    assert stored(spark, path) == [("A", "f", 0, 1.0)] and exists(spark, f"{path}-staged/_SUCCESS")
    points.merge_points(made(spark, [("B", "f", 0, 3.0)]), path, 3)
    assert stored(spark, path) == [("A", "f", 0, 2.0), ("A", "g", 0, 2.0), ("B", "f", 0, 3.0)] and not exists(spark, f"{path}-staged")


def test_one_day_query_reads_files_of_that_day(spark, tmp_path):
    path = str(tmp_path / "p")
    points.write_points(made(spark, [(m, "f", 24 * d, 1.0 * d) for m in ("A", "B") for d in range(20)]), path)
    found = points.nav_range_query(points.read_points(spark, path), "A", DAY + datetime.timedelta(days=5))
    assert [r.nav for r in found.collect()] == [4.0]
    read = [f for f in found.inputFiles() if "measurement=A" in f]
    assert len(read) == 20  # the files of the relation; the plan prunes them
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan and "day#" in plan.split("PartitionFilters: ")[1].split("]")[0] + plan.split("PartitionFilters: ")[1]
    scan = found._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() <= 2


def test_merged_stream_adds_no_point_for_messages_sent_again(spark, tmp_path):
    rows = [(k, "H", f"f{k}", str(k), "01-Nov-2024", 1000) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, amc_mutual_fund string, mutual_fund_name string, nav string, nav_upload_date_time string, timestamp long")
    sent = messages.encode(df.withColumn("m", F.lit(1)), ["m"], F.lit("nav"), F.col("id"), df.columns)
    for again in range(2):
        messages.publish(sent, f"{tmp_path}/in")
        done, _ = streams.stream_nav_points(spark, f"{tmp_path}/in", "nav", f"{tmp_path}/out", f"{tmp_path}/state", merged=True)
        assert sorted(r.nav for r in done.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0], again


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tabular.table_version(spark, path) is None and tabular.read_version(spark, path, "id long").count() == 0
    assert tabular.replace_version(spark.range(3), path, 5) and not tabular.replace_version(spark.range(9), path, 4)
    (tmp_path / "t" / "version=7").mkdir()
    (tmp_path / "t" / "version=7" / "part-0.parquet").write_bytes(b"broken off")
    assert tabular.table_version(spark, path) == 5 and tabular.read_version(spark, path, "id long").count() == 3
    assert tabular.replace_version(spark.range(4), path, 7) and tabular.replace_version(spark.range(2), path, 8)
    assert tabular.read_version(spark, path, "id long").count() == 2 and sorted(p.name for p in (tmp_path / "t").iterdir()) == ["version=7", "version=8"]


def test_queues(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), (None, "4"), ("a", "5")], "routing_key string, body string")
    bindings = [("a", "x"), ("a", "y/z"), ("b", "y/z"), ("a", "x"), ("d", "w")]
    assert messages.fan_out(df, bindings).count() == 5
    messages.publish_to_queues(df, bindings, f"{tmp_path}/q")
    read = lambda q: sorted(r.body for r in spark.read.schema("routing_key string, body string").json(messages.queue_path(f"{tmp_path}/q", q)).collect())
    assert read("x") == ["1", "5"] and read("y/z") == ["1", "2", "5"]


def test_unknown_fields(spark):
    bodies = [
        '{"0":{"a":1,"b":"x","odd name":null},"1":{"a":2.5,"c":[1,2]}}', '{"7":{"a":null,"c":{"d":1},"it\'s":true}}', "{}", "no json", '{"0":3,"1":null}', '["a"]', None,
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "k long, body string")
    got = {(r.k, r.idx): r.asDict() for r in messages.decode_any(df).collect()}
    assert set(got) == {(0, "0"), (0, "1"), (1, "7")} and set(got[0, "0"]) == {"k", "idx", "a", "b", "c", "it's", "odd name"}
    assert float(got[0, "0"]["a"]) == 1 and float(got[0, "1"]["a"]) == 2.5 and got[0, "1"]["c"] == "[1,2]" and got[1, "7"]["c"] == '{"d":1}' and got[1, "7"]["it's"] is True
    assert messages.decode_any(df.where("k > 1")).columns == ["k", "idx"] and messages.decode_any(df.limit(0)).count() == 0


def test_republishing(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "routing_key string, body string")
    query = streams.republish(df, f"{tmp_path}/c", f"{tmp_path}/s", "1 second")
    end = time.time() + 40
    while time.time() < end and (not exists(spark, f"{tmp_path}/c") or spark.read.schema("routing_key string, body string").json(f"{tmp_path}/c").count() < 2):
        time.sleep(1)
    query.stop()
    assert spark.read.schema("routing_key string, body string").json(f"{tmp_path}/c").count() >= 2


def test_chunks_hold_as_many_rows_each(spark):
    rows = [(k, float(k) if k % 50 == 0 else None) for k in range(1000)] + [(10**12, None), (None, 7.0)]
    df = spark.createDataFrame(rows, "k long, v double")
    done = report.ffill_chunked(df, "k", F.col("v"), "f", chunks=16)
    got = {r.k: r.f for r in done.collect()}
    assert got == {**{k: float(k - k % 50) for k in range(1000)}, 10**12: 950.0, None: 7.0}
    sizes = [r["count"] for r in done.sparkSession.createDataFrame(rows[:1001], "k long, v double").selectExpr("k").groupBy(F.lit(1)).count().collect()]
    assert sizes == [1001]


def book(sheet, styles="", about="", strings=""):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">{about}<sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{strings}</sst>")
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
    return out.getvalue()


def test_typed_cells(spark):
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd;@"/><numFmt numFmtId="165" formatCode="[Red]0.0 &quot;days&quot;"/><numFmt numFmtId="166" formatCode="[h]:mm"/></numFmts>'
        "<cellXfs>" + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 164, 165, 166, 21)) + "</cellXfs>"
    )
    cell = lambda s, v, t="": f'<c s="{s}"{t}><v>{v}</v></c>'
    sheet = (
        "<row>" + cell(0, 45597) + cell(1, 45597) + cell(2, 45597.5) + cell(3, 4.5) + cell(4, 1.5) + cell(5, 0.25) + cell(0, 1, ' t="b"') + cell(0, "#N/A", ' t="e"') + cell(0, 0, ' t="s"') + "</row>"
        '<row r="4"><c r="B4" t="str"><f>A1</f><v>x</v></c><c r="C4" t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r><rPh><t>no</t></rPh></is></c>' + cell(1, 59) + cell(1, -5) + cell(1, 1e300) + "</row>"
    )
    strings = "<si><t>one</t><rPh><t>no</t></rPh></si>"
    df = spark.createDataFrame([("w", bytearray(book(sheet, styles, strings=strings))), ("v", bytearray(book(f"<row>{cell(1, 0)}{cell(1, 1.5)}</row>", styles, '<workbookPr date1904="1"/>')))], "path string, content binary")
    got = {(r.path, r.row_idx): (r.cells, r.kinds) for r in workbook.workbook_rows(df).collect()}
    assert got["w", 0][0] == ["45597", "2024-11-01 00:00:00", "2024-11-01 12:00:00", "4.5", "1 day, 12:00:00", "06:00:00", "TRUE", "#N/A", "one"]
    assert got["w", 0][1] == ["number", "date", "date", "number", "elapsed", "date", "boolean", "error", "string"]
    assert got["w", 3][0][:6] == [None, "x", "ab", "1900-02-28 00:00:00", "1899-12-26 00:00:00", "1e+300"] and len(got["w", 3][0]) == 9
    assert got["v", 0][0] == ["00:00:00", "1904-01-02 12:00:00"]


def test_large_sheets_in_bounded_memory():
    content = book("".join(f'<row r="{n}"><c><v>{n}</v></c><c t="str"><v>text {n}</v></c></row>' for n in range(1, 200_001)))
    tracemalloc.start()
    count = sum(len(cells) for _, _, cells, _ in workbook._rows(content, False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 400_000 and peak < 8 << 20


def test_repeated_titles(spark):
    content = workbook.write_workbook({"One": [["NAV", "NAV", "NAV.1", None, "NAV", "x"], ["1", "2", "3", "4", "5", "6"]], "Two": [["a"], ["1"]]})
    rows = workbook.workbook_rows(spark.createDataFrame([("w", bytearray(content))], "path string, content binary"))
    got = {r.sheet: r.record for r in workbook.promote_header(rows).collect()}
    assert got == {"One": {"NAV": "1", "NAV.2": "2", "NAV.1": "3", "NAV.3": "5", "x": "6"}, "Two": {"a": "1"}}
