"""Table contracts: columns and types, not-null columns, unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.functions.text import finite, plain_number

# Columns and types of the two tables.
NAV_VALUE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("nav", T.DoubleType(), False),
        T.StructField("amc_mutual_fund", T.StringType(), True),
        T.StructField("mutual_fund_id", T.StringType(), False),
        T.StructField("mutual_fund_name", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("nav_upload_date_time", T.StringType(), False),
    ]
)
SCHEME_INFO = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("mutual_fund_name", T.StringType(), False),
        T.StructField("scheme_name", T.StringType(), False),
        T.StructField("fund_type", T.StringType(), False),
        T.StructField("fund_category", T.StringType(), False),
        T.StructField("fund_sub_category", T.StringType(), False),
        T.StructField("isin_div_growth", T.StringType(), False),
        T.StructField("isin_div_reinv", T.StringType(), False),
        T.StructField("record_date", T.TimestampNTZType(), False),
    ]
)
NAV_VALUE_KEY = ["id", "mutual_fund_id"]
SCHEME_INFO_KEY = ["scheme_name"]


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns with its types; an absent column is an error."""
    absent = [f.name for f in contract if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} are missing")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def null_counts(df: DataFrame, contract: T.StructType | list[str]) -> DataFrame:
    """(column_name, n_null) of each not-null column, in one pass."""
    names = contract if isinstance(contract, list) else [f.name for f in contract if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_null")) for n in names])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def nav_value(flat: DataFrame) -> DataFrame:
    """Flat NAV rows in the form of the NAV contract.

    Rows do not bring the fund's id; it is derived from the names of house and fund.
    """
    name = F.concat_ws("\x1f", "amc_mutual_fund", "mutual_fund_name")
    rows = flat.withColumns({"nav": finite(plain_number(F.col("nav"))), "mutual_fund_id": F.md5(name.cast("binary"))})
    return conform(rows, NAV_VALUE)


def scheme_info(schemes: DataFrame, date_format: str = "dd-MMM-yyyy") -> DataFrame:
    """The scheme table in the form of its contract; a missing code is written as empty text.

    The id is unique but has gaps: rows are numbered inside the reports they come from.
    """
    rows = schemes.select(
        F.xxhash64("file", "line_no").alias("id"),
        "mutual_fund_name",
        F.col("scheme_nav_name").alias("scheme_name"),
        "fund_type",
        "fund_category",
        "fund_sub_category",
        F.coalesce("isin_div_growth", F.lit("")).alias("isin_div_growth"),
        F.coalesce("isin_div_reinv", F.lit("")).alias("isin_div_reinv"),
        F.try_to_timestamp("date", F.lit(date_format)).cast("timestamp_ntz").alias("record_date"),
    )
    return conform(rows, SCHEME_INFO)
