"""Which reports to fetch, and which are there."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.functions.text import report_url


def availability_calendar(reports: DataFrame, day: str, as_of: datetime.date, days: int = 40, keys: Sequence[str] = ()) -> DataFrame:
    """(``keys``, date, available): 1 for each of the last ``days`` days before ``as_of`` that has a report, else 0.

    With ``keys`` each combination of their values has a calendar of its own, also
    one whose reports are all of other days.
    """
    first = as_of - datetime.timedelta(days=days)
    inside = (F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(as_of))
    seen = F.collect_set(F.when(inside, F.to_date(day)))  # at most ``days`` dates
    found = (reports if keys else reports.where(inside)).groupBy(*keys).agg(seen.alias("nv_seen"))
    spine = F.sequence(F.date_sub(F.lit(as_of), days), F.date_sub(F.lit(as_of), 1))
    return found.select(*keys, F.explode(spine).alias("date"), "nv_seen").select(*keys, "date", F.array_contains("nv_seen", F.col("date")).cast("int").alias("available"))


def report_fetch_plan(dates: DataFrame, day: str, base: str) -> DataFrame:
    """(date, url) of every distinct date."""
    return dates.select(F.to_date(day).alias("date")).distinct().withColumn("url", report_url(base, F.col("date")))
