"""Reports whose banner rows name what the data rows below them belong to."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navspark.functions.text import CATEGORY_WORDS, HOUSE_WORD, contains_any, fund_header, isin_split, strip

NAV_HEADER_LITERAL = "Scheme NAV Name"


def _cells(lines: DataFrame, n: int) -> DataFrame:
    return lines.select("*", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(n)]).drop("cells")


def nav_report_flatten(lines: DataFrame, file: str = "file", first_data_line: int = 1, as_of: Column | None = None) -> DataFrame:
    """One row per data row of a NAV report, in file order.

    A banner has one text in all four cells; one that names a fund house sets
    the house, any other the fund, and neither clears the other. A data row has
    nothing in its second and third cell. Rows before both banners carry
    reject_reason ``no_context`` and no id.
    """
    rows = _cells(lines.where(F.col("line_no") >= first_data_line), 4)
    banner = (F.col("c0") == F.col("c1")) & (F.col("c1") == F.col("c2")) & (F.col("c2") == F.col("c3"))
    house = F.col("c0").contains(HOUSE_WORD)
    above = Window.partitionBy(file).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumns(
        {
            "amc_mutual_fund": F.last(F.when(banner & house, F.col("c0")), ignorenulls=True).over(above),
            "mutual_fund_name": F.last(F.when(banner & ~house, F.col("c0")), ignorenulls=True).over(above),
        }
    ).where(F.col("c1").isNull() & F.col("c2").isNull())
    ready = F.col("amc_mutual_fund").isNotNull() & F.col("mutual_fund_name").isNotNull()
    marked = carried.withColumn("reject_reason", F.when(~ready, "no_context"))
    number = F.row_number().over(Window.partitionBy(file, "reject_reason").orderBy("line_no")) - 1
    return marked.select(
        file,
        F.when(ready, number).cast("long").alias("id"),
        "amc_mutual_fund",
        "mutual_fund_name",
        F.col("c0").alias("nav"),
        F.col("c3").alias("nav_upload_date_time"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
        "reject_reason",
    )


def scheme_report_flatten(lines: DataFrame, file: str = "file", first_data_line: int = 0) -> DataFrame:
    """One row per scheme of a scheme report, with house and category from the banners above.

    Rows that are no data are dropped, but for banners whose header cannot be
    split: they carry reject_reason ``bad_fund_header``.
    """
    rows = _cells(lines.where(F.col("line_no") >= first_data_line), 5)
    empty = F.col("c1").isNull() & F.col("c2").isNull() & F.col("c3").isNull()
    equal = F.coalesce((F.col("c1") == F.col("c2")) & (F.col("c2") == F.col("c3")), F.lit(False))
    category = contains_any(F.col("c0"), CATEGORY_WORDS)
    kind = (
        F.when(empty, F.when(category, "category"))
        .when(equal, F.when(category, "category").when(F.col("c0").contains(HOUSE_WORD) & (F.col("c0") == F.col("c1")), "house"))
        .when(strip(F.col("c0")) != NAV_HEADER_LITERAL, "data")
    )
    above = Window.partitionBy(file).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    classed = rows.withColumn("kind", kind).withColumn("header", F.when(F.col("kind") == "category", fund_header(F.col("c0"))))
    carried = classed.withColumns(
        {
            "carried": F.last("header", ignorenulls=True).over(above),
            "mutual_fund_name": F.last(F.when(F.col("kind") == "house", F.col("c0")), ignorenulls=True).over(above),
        }
    )
    part = lambda n: F.col(f"header.{n}").isNull()
    bad = (F.col("kind") == "category") & (part("fund_category") | part("fund_sub_category"))
    data = F.col("kind") == "data"
    lost = data & (F.col("carried").isNull() | F.col("mutual_fund_name").isNull())
    return (
        carried.withColumn("reject_reason", F.when(bad, "bad_fund_header").when(lost, "no_context"))
        .where(data | bad)
        .select(
            file,
            "line_no",
            "mutual_fund_name",
            F.col("c0").alias("scheme_nav_name"),
            "carried.fund_type",
            "carried.fund_category",
            "carried.fund_sub_category",
            F.when(data, F.col("c1")).alias("isin_div_growth"),
            F.when(data, F.col("c2")).alias("isin_div_reinv"),
            F.when(data, F.col("c3")).alias("nav"),
            F.when(data, F.col("c4")).alias("date"),
            "reject_reason",
        )
    )


# The columns of the scheme master, and its field of codes that are run together.
SCHEME_MASTER = ["AMC", "Code", "Scheme Name", "Scheme NAV Name", "Scheme Category"]
SCHEME_MASTER_CODES = "ISIN Div Payout/ ISIN GrowthISIN Div Reinvestment"


def scheme_master(rows: DataFrame) -> DataFrame:
    """The scheme master with its field of codes split in two: seven columns, the split's status and the field itself dropped."""
    return rows.withColumn("nv_codes", isin_split(F.col(f"`{SCHEME_MASTER_CODES}`"))).select(
        *SCHEME_MASTER, "nv_codes.isin_div_growth", "nv_codes.isin_div_reinv"
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where("reject_reason IS NULL").drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where("reject_reason IS NOT NULL")


#: Chunks of one oversized sequence; the table of their last values has so many rows, whatever the input.
CHUNKS = 4096


def ffill_chunked(df: DataFrame, order: str, value: Column, name: str, chunks: int = CHUNKS) -> DataFrame:
    """``df`` with ``name``: the last non-null ``value`` up to each row of one long sequence.

    The sequence is cut into ranges of about as many rows each, by sampled
    quantiles of the (numeric) order column; each is filled by itself, and what
    the ranges before it end with is carried over a table of one row per range.
    """
    at = F.col(order).cast("double")
    shares = ", ".join(f"{k / chunks}D" for k in range(1, chunks))  # as text: a call to the JVM for each takes seconds
    quantiles = F.expr(f"percentile_approx(nv_at, array({shares}), {chunks})")
    bounds = df.select(at.alias("nv_at")).agg(quantiles).first()[0] if chunks > 1 else []
    inner = sorted({b for b in bounds or [] if abs(b) != float("inf")})
    bucket = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="nv_at", outputCol="nv_chunk", handleInvalid="keep")
    placed = bucket.transform(df.withColumns({"nv_value": value, "nv_at": at})) if inner else df.withColumns({"nv_value": value, "nv_at": at, "nv_chunk": F.lit(0)})
    cut = placed.withColumn("nv_chunk", F.when(F.col("nv_at").isNotNull(), F.col("nv_chunk").cast("long"))).drop("nv_at")
    ends = cut.where("nv_value IS NOT NULL").groupBy("nv_chunk").agg(F.max_by("nv_value", order).alias("nv_end"))
    spine = df.sparkSession.range(chunks).toDF("nv_chunk").join(ends, "nv_chunk", "left")
    before = Window.orderBy("nv_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = spine.select("nv_chunk", F.last("nv_end", ignorenulls=True).over(before).alias("nv_carry"))
    above = Window.partitionBy("nv_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = cut.withColumn("nv_own", F.last("nv_value", ignorenulls=True).over(above))
    joined = filled.join(F.broadcast(carry), "nv_chunk", "left")  # CHUNKS rows
    return joined.withColumn(name, F.coalesce("nv_own", "nv_carry")).drop("nv_value", "nv_chunk", "nv_own", "nv_carry")
