"""Questions about schemes and their NAV histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scheme_codes(schemes: DataFrame, code: str, name: str) -> DataFrame:
    return schemes.select(F.col(code).alias("code"), F.col(name).alias("scheme_name")).distinct()


def latest_quote(points: DataFrame, key: str, time: str, tie: str, nav: str, only: object | None = None) -> DataFrame:
    """(key, time, nav) of the last point of each scheme, or of one; the larger ``tie`` wins at equal times."""
    rows = points if only is None else points.where(F.col(key) == only)
    last = F.max_by(F.struct(F.col(time).alias("time"), F.col(nav).alias("nav")), F.struct(time, tie))
    return rows.groupBy(key).agg(last.alias("q")).select(key, "q.time", "q.nav")


def nav_history(points: DataFrame, key: str, only: object, time: str, nav: str) -> DataFrame:
    return points.where(F.col(key) == only).select(key, F.col(time).alias("time"), F.col(nav).alias("nav"))


def nav_history_json(points: DataFrame, key: str, only: object, time: str, nav: str) -> DataFrame:
    """The same history of the one scheme as a JSON array in time order."""
    rows = nav_history(points, key, only, time, nav)
    return rows.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct("time", "nav")))).alias("history"))


def trailing_return(points: DataFrame, key: str, time: str, nav: str, tie: str, months: int, keep: Column | None = None) -> DataFrame:
    """(key, latest_nav, base_nav, trailing_return): last NAV against the last one at least ``months`` months before it.

    Both are picked by aggregation, so nothing but one small row per scheme is
    joined. Schemes without an earlier point are left out.
    """
    rows = points if keep is None else points.where(keep)
    order = F.struct(time, tie)
    last = rows.groupBy(key).agg(F.max(time).alias("last_time"), F.max_by(nav, order).alias("latest_nav"))
    before = rows.join(last, key).where(F.col(time) <= F.add_months("last_time", -months))
    base = before.groupBy(key).agg(F.max_by(nav, order).alias("base_nav"), F.max("latest_nav").alias("latest_nav"))
    return base.select(key, "latest_nav", "base_nav", (F.col("latest_nav") / F.col("base_nav") - 1).alias("trailing_return"))


def scheme_performance(schemes: DataFrame, returns: DataFrame, key: str, fund_type: str, category: str) -> DataFrame:
    """(fund_sub_category, n_schemes, mean_return, best_return) of the schemes of one type and category, by sub-category.

    ``returns`` has ``key`` and trailing_return; schemes without a return are not counted.
    """
    asked = schemes.where((F.col("fund_type") == fund_type) & (F.col("fund_category") == category)).select(key, "fund_sub_category")
    found = asked.join(returns.select(key, "trailing_return"), key)
    return found.groupBy("fund_sub_category").agg(
        F.count("*").alias("n_schemes"), F.avg("trailing_return").alias("mean_return"), F.max("trailing_return").alias("best_return")
    )
