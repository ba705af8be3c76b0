"""Time-series points of NAVs: a measurement, two tags, a time and one field."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.functions.shared import delete, exists
from navspark.functions.text import finite, plain_number

DATE_FORMAT = "dd-MMM-yyyy"


def nav_points(flat: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Points of flat NAV rows; rows that cannot be points keep a reject_reason."""
    nav = finite(plain_number(F.col("nav")))
    time = F.try_to_timestamp("nav_upload_date_time", F.lit(date_format)).cast("timestamp_ntz")
    own = F.col("reject_reason") if "reject_reason" in flat.columns else F.lit(None).cast("string")
    reason = F.coalesce(own, F.when(nav.isNull(), "nav_not_numeric").when(time.isNull(), "bad_date").when(F.col("amc_mutual_fund").isNull(), "no_context"))
    return flat.select(
        F.col("amc_mutual_fund").alias("measurement"),
        "mutual_fund_name",
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("db_record_time"),
        time.alias("time"),
        nav.alias("nav"),
        reason.alias("reject_reason"),
    )


#: What makes two points the same: the measurement, the tags and the time.
IDENTITY = ["measurement", "mutual_fund_name", "db_record_time", "time"]
_STORED = "mutual_fund_name string, db_record_time long, time timestamp_ntz, nav double, written long, measurement string, day date"


def _by_day(points: DataFrame) -> DataFrame:
    return points.withColumn("day", F.to_date("time")).repartition("measurement", "day")


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet partitioned by measurement and day, so that a query of one house and some days reads only their files."""
    _by_day(points).write.mode(mode).partitionBy("measurement", "day").parquet(path)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Stored points with their day, by which ``nav_range_query`` prunes."""
    return spark.read.schema(_STORED).parquet(path).drop("written") if exists(spark, path) else spark.createDataFrame([], _STORED).drop("written")


def _put(spark: SparkSession, staged: str, path: str) -> None:
    rows = spark.read.schema(_STORED).parquet(staged)
    rows.repartition("measurement", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("measurement", "day").parquet(path)
    delete(spark, staged)


def merge_points(points: DataFrame, path: str, written: int) -> None:
    """Writes points so that the store has one of each IDENTITY: that of the largest ``written``, then of the largest NAV.

    Only the partitions (measurement, day) that the points fall in are read and
    written anew. They are first put beside the store: a write that breaks off
    while they replace the old ones is finished by the next merge. The same
    points merged again, as after a batch is run again, change nothing.
    """
    spark, staged = points.sparkSession, f"{path.rstrip('/')}-staged"
    if exists(spark, f"{staged}/_SUCCESS"):
        _put(spark, staged, path)
    new = points.select(*IDENTITY, "nav").withColumns({"written": F.lit(written).cast("long"), "day": F.to_date("time")})
    rows = new
    if exists(spark, path):
        touched = new.select("measurement", "day").distinct()
        stored = spark.read.schema(_STORED).parquet(path).alias("s").join(touched.alias("t"), F.expr("s.measurement <=> t.measurement AND s.day <=> t.day"), "left_semi")
        rows = new.unionByName(stored)
    last = F.max(F.struct("written", "nav")).alias("last")
    merged = rows.groupBy(*IDENTITY, "day").agg(last).select(*IDENTITY, "day", "last.nav", "last.written")
    merged.write.mode("overwrite").parquet(staged)
    _put(spark, staged, path)


def nav_range_query(points: DataFrame, measurement: str, as_of: datetime.datetime, lookback: datetime.timedelta = datetime.timedelta(days=1)) -> DataFrame:
    """Points of one measurement from ``as_of - lookback`` up to, but not at, ``as_of``; of stored points only the files of those days are read."""
    inside = (F.col("time") >= F.lit(as_of - lookback).cast("timestamp_ntz")) & (F.col("time") < F.lit(as_of).cast("timestamp_ntz"))
    rows = points.where((F.col("measurement") == measurement) & inside)
    return rows.where(F.col("day").between(F.lit((as_of - lookback).date()), F.lit(as_of.date()))).drop("day") if "day" in points.columns else rows
