"""Workbooks written and read one at a time, whatever the batches of rows are."""

import pytest
from pyspark.sql import functions as F

from navspark.functions.shared import PART, new_folder
from navspark.plans.carriers import write_books
from navspark.sources import workbook


@pytest.fixture()
def small_batches(spark):
    """Batches of two rows for Python, so that a workbook is never in one of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, 2)
    yield
    spark.conf.unset(name)


def test_workbooks_in_parts(spark, small_batches):
    folder = new_folder(spark, "books")
    rows = spark.range(3000).select((F.col("id") % 3).cast("string").alias("book"), F.col("id"))
    write_books(rows, folder, "book", ["id"], lambda own: {"S": [[r["id"], f"{r['id']} of {len(own)}"] for r in own]})
    books = workbook.read_workbooks(spark, folder)
    assert books.count() == 3 and books.select(F.min(F.length("content"))).first()[0] > 2 * PART
    found = workbook.workbook_rows(books.coalesce(1)).select(F.regexp_extract("path", r"([0-9])\.xlsx$", 1), "row_idx", "cells").collect()
    assert sorted(map(tuple, found)) == [(str(b), i, [str(3 * i + b), f"{3 * i + b} of 1000"]) for b in range(3) for i in range(1000)]
