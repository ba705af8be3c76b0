"""Exact substring dedup: every byte covered by a 200-byte string that starts anywhere else.

Prefix doubling over sampled positions. Every window of LENGTH bytes has an
anchor: the leftmost of its KEY-byte strings with the least hash. Equal windows
have their anchors at the same place inside them, so only positions with the
same anchor string need to be compared, and the windows that share an anchor
form one row (the anchor position and a range of distances d from window start
to anchor). Rows are ranked by the string around the anchor that all their
windows have in common, and each round Spark groups the rows of one rank by the
pair of that rank and the name of a longer string:

* a row whose common string occurs once is unique, so are all its windows: it leaves;
* a row whose whole range of windows occurs again is repeated: it leaves;
* any other row (the end of a repeated passage lies in its range) is split into
  ranges of fewer distances, whose common string is longer (40, 160, 192 and at
  last 200 bytes), and goes to the next round.

Names of strings are 64-bit polynomial hashes; all decisions rest on two of
them. A first pass counts anchor strings, so that rows of unique ones are never
made, by a Bloom filter of bounded size (beyond its bound the rows are simply
all made). Groups are counted with partial aggregation and joined back, never
gathered; texts travel compressed.

Defined results: null text counts as empty; shorter texts keep everything.
Matches never cross documents. Repeated rows are texts that repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.arrow_text import runs, text_bytes
from navspark.llm.common import cut, drop_stored, stored

LENGTH = 200
KEY = 40
#: Distances that a range holds after each round; the string they have in common is LENGTH - size + 1 bytes long.
SIZES = (41, 9, 1)
#: The Bloom filter of repeated anchor strings has at most so many words of 64 bits (16 MB), 16 bits a string.
MAX_WORDS = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOW = np.uint64(22)  # positions in a run of texts have at most so many bits
_RUN_BYTES = 1 << 20
#: A longer text is cut into segments that overlap by a window less one byte, so that its positions fit.
_SEGMENT = 1 << 21


def _table() -> np.ndarray:
    return np.random.RandomState(3).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Names:
    """64-bit names of the substrings of some bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.n = n
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_table()[data] * _powers(_BASE, n), out=self.sums[1:])
        self.inverse = _powers(_UNDO, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, key: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor, nearest distance, farthest distance, names of the anchor string and of all its windows)."""
    wide = length - key + 1
    size = np.diff(offsets)
    enough = size >= length
    if not enough.any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, empty
    names = Names(data)
    at = np.arange(names.n - key + 1)
    hashed = names.of(at, at + key)
    least = (hashed >> _LOW << _LOW) | at.astype(np.uint64)  # of equal hashes the leftmost
    step = 1
    while step * 2 <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < wide:
        least = np.minimum(least[: len(least) - (wide - step)], least[wide - step :])
    inside = np.zeros(names.n + 2, np.int64)
    np.add.at(inside, offsets[:-1][enough], 1)
    np.add.at(inside, offsets[1:][enough] - length + 1, -1)
    inside = np.cumsum(inside)[: len(least)] > 0
    number = np.repeat(np.arange(len(size)), size)[: len(least)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(least)) - 1
    first, last = first[inside[first]], last[inside[first]]
    anchor = (least[first] & ((np.uint64(1) << _LOW) - np.uint64(1))).astype(np.int64)
    return number[first], anchor, anchor - last, anchor - first, hashed[anchor], names.of(first, last + length)


def _bit(name: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bits) of a name: four bits in one word."""
    bits = np.zeros(len(name), np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((name >> np.uint64(40 + 6 * k)) & np.uint64(63))
    return (name & np.uint64(words - 1)).astype(np.int64), bits


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """(first text, offsets in the piece, start of the piece, its start in the first text): every window of every text is in one piece."""
    for i, j in runs(offsets, _RUN_BYTES):
        start, end = int(offsets[i]), int(offsets[j])
        if end - start <= _SEGMENT:
            yield i, offsets[i : j + 1] - start, start, 0
        else:  # one long text
            for k in range(0, end - start - length + 1, _SEGMENT):
                yield i, np.array([0, min(_SEGMENT + length - 1, end - start - k)]), start + k, k


def _rows(docs: DataFrame, length: int, key: int, bloom: np.ndarray | None, only_names: bool) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]
    schema = "name long" if only_names else f"doc_id {kind}, th long, name long, u long, a int, lo int, hi int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, begin, start, shift in _pieces(offsets, length):
                text, a, lo, hi, name, u = anchors(data[start : start + begin[-1]], begin, length, key)
                if not len(text):
                    continue
                if bloom is not None:
                    word, bits = _bit(name, len(bloom))
                    may = np.flatnonzero(bloom[word] & bits == bits)
                    text, a, lo, hi, name, u = (x[may] for x in (text, a, lo, hi, name, u))
                if only_names:
                    yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], ["name"])
                    continue
                of = pa.array(text + i)
                small = [pa.array(x.astype(np.int32)) for x in (a - begin[text] + shift, lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(of), batch.column("th").take(of), pa.array(name.view(np.int64)), pa.array(u.view(np.int64)), *small],
                    ["doc_id", "th", "name", "u", "a", "lo", "hi"],
                )

    return docs.mapInArrow(run, schema)


def _bloom(docs: DataFrame, length: int, key: int) -> np.ndarray | None:
    """Filter of the anchor strings that occur more than once; None beyond its bound."""
    repeated = cut(_rows(docs, length, key, None, True).groupBy("name").count().where("count > 1").select("name"))
    n = repeated.count()
    words = 1 << max(4, (n // 4).bit_length())
    if words > MAX_WORDS:
        return None
    mask = F.lit(0).cast("long")
    for k in range(4):
        bit = F.shiftrightunsigned("name", 40 + 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    word = F.col("name").bitwiseAND(F.lit(words - 1)).cast("int")
    found = repeated.groupBy(word.alias("w")).agg(F.bit_or(mask).alias("b")).toPandas()
    out = np.zeros(words, np.uint64)
    out[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64).view(np.uint64)
    return out


def _settle(rows: DataFrame, group: list[str], variant: list[str], rep: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(repeated rows, what the next round compares, the stored table that both are read from).

    ``rows`` has ``single``: whether the row stands for text that is still open
    (else it is only there to be compared with). The second result has a row
    for each variant of a group that has an open one: its representative, and
    whether it is that open one.
    """
    variants = rows.groupBy(*group, *variant).agg(
        F.count("*").alias("m"), F.max(F.col("single").cast("int")).alias("s"), F.min(F.struct(*rep)).alias("rep")
    )
    variants = stored(variants)
    groups = variants.groupBy(*group).agg(
        F.sum("m").alias("n"), F.max(F.when((F.col("m") == 1) & (F.col("s") == 1), 1).otherwise(0)).alias("open")
    )
    repeated = variants.where((F.col("m") > 1) & (F.col("s") == 1)).select(*group, *variant)
    left = variants.join(groups.where("n > 1 AND open = 1").select(*group), group)
    left = left.select(*group, *variant, "rep.*", ((F.col("m") == 1) & (F.col("s") == 1)).alias("single"))
    return rows.where("single").join(repeated, [*group, *variant], "left_semi"), left, variants


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, th, z: texts as compressed UTF-8, to be shuffled."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            z = [press.compress(raw[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(z, pa.binary())], ["doc_id", "th", "z"])

    return docs.mapInArrow(run, f"doc_id {kind}, th long, z binary")


def _contexts(docs: DataFrame, left: DataFrame, length: int) -> DataFrame:
    """The bytes around the anchors of ``left``: name, u, lo, hi, single, doc_id, th, a, back, ctx."""
    kind = dict(docs.dtypes)["doc_id"]
    wanted = left.groupBy("doc_id", "th").agg(F.collect_list(F.struct("name", "u", "lo", "hi", "single", "a")).alias("rows"))  # bounded by one text
    wanted = wanted.select(F.col("doc_id").alias("w_id"), F.col("th").alias("w_th"), "rows")
    joined = _packed(docs).join(wanted, (F.col("th") == F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("w_id"))).select("doc_id", "th", "z", "rows")
    schema = f"name long, u long, lo int, hi int, single boolean, doc_id {kind}, th long, a int, back int, ctx binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = batch.column("rows")
            owner = rows.value_parent_indices()
            flat = rows.flatten()
            lo, hi, a = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("lo", "hi", "a"))
            texts = [press.decompress(z) for z in batch.column("z").to_pylist()]
            ctx = [texts[t][k - h : k - w + length] for t, k, h, w in zip(owner.to_pylist(), a.tolist(), hi.tolist(), lo.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [flat.field(n) for n in ("name", "u", "lo", "hi", "single")]
                + [batch.column("doc_id").take(owner), batch.column("th").take(owner), flat.field("a"), flat.field("hi"), pa.array(ctx, pa.binary())],
                ["name", "u", "lo", "hi", "single", "doc_id", "th", "a", "back", "ctx"],
            )

    # Equal rows of the input bring the same anchor twice.
    return joined.mapInArrow(run, schema).dropDuplicates(["name", "u", "lo", "hi"])


_ROW = "name long, u long, lo int, hi int, single boolean, a int, d int, part_lo int, part_hi int, core long, part long, doc_id {kind}, th long"


def _split(open_ranges: DataFrame, size: int, length: int) -> DataFrame:
    """Ranges of ``size`` distances inside each range, with the names of their common string and of all their windows."""
    kind = dict(open_ranges.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)
            near, far, back = column("part_lo"), column("part_hi"), column("back")
            data, offsets = text_bytes(batch.column("ctx"))
            first = near // size  # ranges start at multiples of their size in every row
            count = far // size - first + 1
            owner = np.repeat(np.arange(len(near)), count)
            d = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]) * size
            lo, hi = np.maximum(d, near[owner]), np.minimum(d + size - 1, far[owner])
            names = Names(data)
            anchor = offsets[:-1][owner] + back[owner]
            core = names.of(anchor - d, anchor - (d + size - 1) + length)
            part = names.of(anchor - hi, anchor - lo + length)
            of = pa.array(owner)
            took = [batch.column(n).take(of) for n in ("name", "u", "lo", "hi", "single", "a")]
            small = [pa.array(x.astype(np.int32)) for x in (d, lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [*took, *small, pa.array(core.view(np.int64)), pa.array(part.view(np.int64)), batch.column("doc_id").take(of), batch.column("th").take(of)],
                ["name", "u", "lo", "hi", "single", "a", "d", "part_lo", "part_hi", "core", "part", "doc_id", "th"],
            )

    return open_ranges.mapInArrow(run, _ROW.format(kind=kind))


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: int = KEY, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """doc_id, th, start, end of byte ranges whose windows occur elsewhere; ``docs`` has doc_id, text, th.

    Tables of a round are deleted once the next one has read them.
    """
    rows = stored(_rows(docs, length, key, _bloom(docs, length, key), False).withColumn("single", F.lit(True)))
    repeated, left, variants = _settle(rows, ["name"], ["lo", "hi", "u"], ["doc_id", "th", "a"])
    spans = [stored(repeated.select("doc_id", "th", (F.col("a") - F.col("hi")).alias("start"), (F.col("a") - F.col("lo") + length).alias("end")))]
    contexts = stored(_contexts(docs, left, length))
    drop_stored(rows, variants)
    ranges = contexts.withColumns({"part_lo": F.col("lo"), "part_hi": F.col("hi")})
    same = ["name", "u", "lo", "hi"]
    behind = []
    for size in sizes:
        parts = _split(ranges, size, length)
        repeated, left, variants = _settle(parts, ["name", "d", "core"], ["part_lo", "part_hi", "part"], ["u", "lo", "hi"])
        ends = [(F.col("a") - F.col("part_hi")).alias("start"), (F.col("a") - F.col("part_lo") + length).alias("end")]
        spans.append(stored(repeated.select("doc_id", "th", *ends)))
        drop_stored(*behind)
        behind = [variants]
        if size > 1:
            ranges = contexts.drop("single").join(left.select(*same, "part_lo", "part_hi", "single"), same)
    drop_stored(contexts, *behind)
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, removed (array of byte ranges, maximal and sorted), kept (the remaining bytes) for each row of ``docs``."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    kind = dict(docs.dtypes)["doc_id"]
    spans = repeated_spans(docs, length).groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # bounded by one text
    spans = spans.select(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th"), "spans")
    joined = _packed(docs).join(spans, (F.col("th") == F.col("s_th")) & F.col("doc_id").eqNullSafe(F.col("s_id")), "left").select("doc_id", "z", "spans")
    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, kept = [], [], []
            for z, found in zip(batch.column("z").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                text = press.decompress(z)
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in found or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *(x for pair in merged for x in pair), len(text)]
                kept.append(b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
                removed.append([{"start": s, "end": e} for s, e in merged])
                sizes.append(len(text))
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kinds), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    return joined.mapInArrow(run, schema)
