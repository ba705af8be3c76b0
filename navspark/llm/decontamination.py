"""Benchmark decontamination: windows of test words in a broadcast hash set.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.
A test item's windows are its runs of 10 consecutive words; an item of fewer
words is one window. Document windows are hashed where the text is read, looked
up in the hash set of test windows, and hits are verified word by word. A
document word inside any occurrence of a window is hit.

Only DataFrame operations are used. Of a test set of more than BROADCAST_WINDOWS
distinct windows only a Bloom filter is broadcast; what it lets through is
shuffled with its ten words, never with the document.

Defined results: a null or wordless text has no words and no hits; a null
item text has no windows; a null item_id adds hits but no item. Repeated rows
are each judged. An empty test set hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.common import bloom_block, bloom_mask, cut, fresh

WINDOW = 10
#: Up to so many distinct windows (some 200 bytes each) are broadcast.
BROADCAST_WINDOWS = 500_000
#: The words and item ids of the windows that are broadcast have at most so many bytes, each window counted as WINDOW_BYTES more.
BROADCAST_BYTES, WINDOW_BYTES = 128 << 20, 200
#: The Bloom filter of a larger test set has at most so many blocks of 64 bits.
MAX_BLOCKS = 1 << 20

_BREAKS = "".join(chr(c) for c in range(128) if not (chr(c).isdigit() or chr(c).isalpha()))
_UPPER = "".join(chr(c) for c in range(65, 91))
_FROM = _BREAKS + _UPPER
_TO = " " * len(_BREAKS) + _UPPER.lower()


def words(text: Column) -> Column:
    """Array of normalised words; empty for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO), " "), "")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the test items: words w, length m, array of item ids."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ws") - (window - 1)))
    rows = items.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("ws"), i, window))).alias("w"))
    return rows.groupBy("w").agg(F.collect_set("item").alias("items")).select("w", F.size("w").alias("m"), "items")


def _hashed(df: DataFrame, lengths: list[int]) -> DataFrame:
    """``df`` with nv_h{m} for each m of ``lengths``: the hash of every m consecutive words of nv_ws.

    Every word is hashed once; hashes of longer windows are made from pairs of
    hashes of shorter ones, by doubling.
    """
    made = {1}
    df = df.withColumn("nv_h1", F.transform("nv_ws", lambda x: F.xxhash64(x)))

    def join(left: int, right: int) -> None:
        nonlocal df
        if left + right not in made:
            count = F.greatest(F.size("nv_ws") - (left + right - 1), F.lit(0))
            pair = F.zip_with(F.slice(f"nv_h{left}", 1, count), F.slice(f"nv_h{right}", left + 1, count), lambda x, y: F.xxhash64(x, y))
            df = df.withColumn(f"nv_h{left + right}", pair)
            made.add(left + right)

    for m in sorted(lengths):
        whole = 0
        for part in (1 << k for k in reversed(range(m.bit_length())) if m >> k & 1):
            for k in range(1, part.bit_length()):
                join(1 << (k - 1), 1 << (k - 1))
            if whole:
                join(whole, part)
            whole += part
    return df.select(*[c for c in df.columns if c not in {f"nv_h{m}" for m in made - set(lengths)}])


def window_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: ``keys``, n_words, spans (sorted array of (pos, len)), items (sorted array)."""
    tests = cut(test_windows(benchmark, window))
    held = sum(F.octet_length(F.array_join(c, " ")).cast("long") for c in ("w", "items")) + WINDOW_BYTES
    sizes = tests.groupBy("m").agg(F.count("*").alias("n"), F.sum(held).alias("bytes")).collect()  # at most ``window`` rows
    lengths = sorted((r["m"] for r in sizes), reverse=True)
    total, size = sum(r["n"] for r in sizes), sum(r["bytes"] for r in sizes)
    own = F.lit(None).cast("long")
    for m in lengths:
        own = F.when(F.col("t_len") == m, F.get(f"nv_h{m}", F.lit(0))).otherwise(own)
    tests = _hashed(tests.select(F.col("w").alias("nv_ws"), F.col("m").alias("t_len"), F.col("items").alias("t_items")), lengths)
    tests = tests.select(own.alias("t_h"), "t_len", F.col("nv_ws").alias("t_w"), "t_items")
    base = _hashed(docs.select(*keys, F.monotonically_increasing_id().alias("nv_rid"), words(F.col("text")).alias("nv_ws")), lengths)

    # One array of hashes per document. Place 0 is empty and stands for the
    # document itself; then come the windows of each length that occurs.
    n = F.size("nv_ws")
    coded = F.concat(F.array(F.lit(None).cast("long")), *[F.col(f"nv_h{m}") for m in lengths])
    rows = base.select(*keys, "nv_rid", "nv_ws", F.posexplode(coded).alias("nv_p", "nv_h"))
    pos, length, before = F.lit(0), F.lit(0), F.lit(1)
    for m in lengths:
        count = F.greatest(F.lit(0), n - (m - 1))
        here = (F.col("nv_p") >= before) & (F.col("nv_p") < before + count)
        pos = F.when(here, F.col("nv_p") - before).otherwise(pos)
        length = F.when(here, F.lit(m)).otherwise(length)
        before = before + count
    rows = rows.select(*keys, "nv_rid", "nv_ws", "nv_p", "nv_h", pos.alias("nv_pos"), length.alias("nv_len"))
    there = F.slice(F.col("nv_ws"), F.col("nv_pos") + 1, F.col("nv_len"))
    hit = (F.col("nv_h") == F.col("t_h")) & (F.col("nv_len") == F.col("t_len"))
    if total <= BROADCAST_WINDOWS and size <= BROADCAST_BYTES:
        seen = rows.join(F.broadcast(tests), hit & (there == F.col("t_w")), "left")
    else:
        # Only places that a Bloom filter lets through are shuffled, each with its own words.
        blocks = min(MAX_BLOCKS, 1 << (total // 4).bit_length())
        bloom = tests.groupBy(bloom_block(F.col("t_h"), blocks).alias("b_block")).agg(F.bit_or(bloom_mask(F.col("t_h"))).alias("b_bits"))
        mask = bloom_mask(F.col("nv_h"))
        may = (F.col("b_block") == bloom_block(F.col("nv_h"), blocks)) & (F.col("b_bits").bitwiseAND(mask) == mask)
        slim = rows.join(F.broadcast(bloom), may, "left").where((F.col("nv_p") == 0) | F.col("b_block").isNotNull())  # at most MAX_BLOCKS rows
        slim = slim.select(*keys, "nv_rid", "nv_p", "nv_h", "nv_pos", "nv_len", there.alias("nv_w"), n.alias("nv_n"))
        seen = slim.join(tests, hit & (F.col("nv_w") == F.col("t_w")), "left")
        n = F.col("nv_n")
    seen = seen.where((F.col("nv_p") == 0) | F.col("t_h").isNotNull())
    span = F.when(F.col("t_h").isNotNull(), F.struct(F.col("nv_pos").alias("pos"), F.col("nv_len").alias("len")))
    seen = seen.select(*keys, "nv_rid", F.when(F.col("nv_p") == 0, n).alias("nv_n"), span.alias("nv_span"), "t_items")
    return seen.groupBy("nv_rid", *keys).agg(
        F.max("nv_n").cast("long").alias("n_words"),
        F.sort_array(F.collect_set("nv_span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("t_items")))).alias("items"),
    ).drop("nv_rid")


def covered(spans: Column) -> Column:
    """How many places the sorted spans cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        end = x["pos"] + x["len"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], x["pos"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"].cast("long"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a test window, columns unchanged."""
    id_key, text_key = fresh(docs, "nv_id", "nv_text")
    keyed = docs.withColumns({id_key: F.col("doc_id"), text_key: F.xxhash64("text")})
    hit = window_hits(keyed.select(id_key, text_key, "text"), benchmark, window, (id_key, text_key))
    hit = hit.where(F.size("spans") > 0).select(F.col(id_key).alias("h_id"), F.col(text_key).alias("h_text")).distinct()
    hit = cut(hit)
    hit = F.broadcast(hit) if hit.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else hit
    same = reduce(lambda a, b: a & b, [F.col(id_key).eqNullSafe(F.col("h_id")), F.col(text_key) == F.col("h_text")])
    return keyed.join(hit, same, "left_anti").drop(id_key, text_key)
