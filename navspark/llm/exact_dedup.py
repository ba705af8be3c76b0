"""Exact dedup by a heavy-hitter split, in DataFrame operations only.

Texts are equal when identical after white space (``[\\x20\\x09-\\x0D]``) is
deleted. Digests that hold more than ``support`` of all rows are found with the
Misra-Gries summary behind ``freqItems``, verified with exact counts, and their
winners (at most ``1 / support``) are broadcast, so rows of large groups are
settled where they are read. All other digests, whose groups hold at most that
share of the rows, are aggregated by an ordinary shuffle, with partial sums
before it, and joined to their rows.

Defined results: null text counts as empty, and empty texts are equal to each
other. Of equal texts the row with the most code points in the original text
stays, then the smallest doc_id (a null id comes last), then one of the rows
that repeat both. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.common import cut, keep_rows

#: A digest with more than this share of all rows is a heavy one: at most 1,000 of them.
SUPPORT = 0.001


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without white space; null counts as empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")
    return F.unhex(F.sha2(bare.cast("binary"), 256))


def exact_groups(docs: DataFrame, support: float = SUPPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, kept."""
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            text_digest(F.col(text_col)).alias("digest"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("size"),
            F.monotonically_increasing_id().alias("rid"),
        ).withColumn("h", F.xxhash64("digest"))
    )
    total = rows.count()
    first = F.struct((-F.col("size")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    frequent = rows.stat.freqItems(["h"], support).select(F.explode("h_freqItems").alias("h"))
    heavy = (
        rows.join(F.broadcast(frequent), "h")  # at most 1 / support numbers
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
        .where(F.col("group_size") > support * total)
    )
    heavy = cut(heavy)  # at most 1 / support rows, used twice
    settled = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    rest = rest.join(rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(first).alias("first")), "digest")
    return settled.select(*rest.columns).unionByName(rest).select(
        "doc_id",
        "digest",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged."""
    groups = exact_groups(docs, support).groupBy("doc_id", "digest").agg(F.max(F.col("kept").cast("int")).alias("one"), F.count("*").alias("n"))
    kept = groups.where("one = 1").select("doc_id", F.col("digest").alias("key"), "n")
    return keep_rows(docs, kept, text_digest(F.col("text")))
