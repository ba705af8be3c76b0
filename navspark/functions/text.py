"""Text helpers. All of them are built-in expressions and safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell texts that public pandas readers take as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Words that mark a fund category and a fund house in a report.
CATEGORY_WORDS = ["Open Ended", "Close Ended", "Interval Fund Schemes"]
HOUSE_WORD = "Mutual Fund"

# Entities that a cell is decoded for, the ampersand last.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(MISSING), c)


def plain_number(c: Column) -> Column:
    """A number written with thousands commas loses them; other text is unchanged."""
    return F.when(c.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d*)?$"), F.replace(c, F.lit(","), F.lit(""))).otherwise(c)


def finite(c: Column) -> Column:
    """As a double; null for text that is no finite number."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def contains_any(c: Column, words: list[str]) -> Column:
    out = c.contains(words[0])
    for w in words[1:]:
        out = out | c.contains(w)
    return out


def isin_split(c: Column) -> Column:
    """Struct (status, isin_div_growth, isin_div_reinv) of a field that holds up to two codes run together.

    Status 0 for null, 1 or 2 for so many codes, else -1. What stands before
    the first code is dropped.
    """
    parts = F.split(c, "INF")
    code = lambda i: F.concat(F.lit("INF"), strip(F.get(parts, F.lit(i))))
    n = F.size(parts)
    return F.struct(
        F.when(c.isNull(), 0).when(n == 2, 1).when(n == 3, 2).otherwise(-1).alias("status"),
        F.when(n.isin(2, 3), code(1)).otherwise("").alias("isin_div_growth"),
        F.when(n == 3, code(2)).otherwise("").alias("isin_div_reinv"),
    )


def fund_header(c: Column) -> Column:
    """Struct (fund_type, fund_category, fund_sub_category) of a category banner; a missing part is null."""
    inner = F.get(F.split(F.get(F.split(c, r"\("), F.lit(1)), r"\)"), F.lit(0))
    pieces = F.split(inner, "-")
    dash = c.contains("-")
    return F.struct(
        strip(F.get(F.split(c, r"\("), F.lit(0))).alias("fund_type"),
        F.when(dash, strip(F.get(pieces, F.lit(0)))).otherwise(strip(inner)).alias("fund_category"),
        F.when(dash, strip(F.get(pieces, F.lit(1)))).when(inner.isNotNull(), F.lit("")).alias("fund_sub_category"),
    )


def report_url(base: str, day: Column) -> Column:
    return F.concat(F.lit(f"{base}?fDate="), F.date_format(day, "yyyy-MMM-dd"))


def absolute_link(host: str, href: Column) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)
