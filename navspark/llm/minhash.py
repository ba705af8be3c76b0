"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with its number of
occurrence, so that no two are equal. An Order MinHash bucket is made of the
LEAST smallest labelled shingles under a random order, taken in the order they
have in the text; a random order is split into PARTS ranges of hashes, and each
range gives a bucket of its own. Texts in a bucket are candidates; a candidate
pair is verified by aligning the two shingle sequences within the band that the
threshold allows. The similarity is ``common / (n + m - common)`` for the longest
common subsequence of the labelled shingles.

Texts with the same words are collapsed first. Within a bucket a text is
compared with a representative, not with every other text: first with the one
it shares most buckets with. Then, in each of ROUNDS rounds, DRAWS members of
each component in a bucket are compared with members of one of them, all drawn
at random. That settles most buckets at little cost; those that still hold
several components are finished exactly. A text can be at the threshold with one
of another component only if that share of its shingles occurs in other
components at all; counting that takes one pass over the shingles, and only the
texts that pass it are compared further: the open buckets that connect them make
a cluster, a cluster is dealt to blocks, and every pair of blocks is compared in
one task, all pairs of texts of different components. A pair is passed over only
if its lengths or the bits of its shingles rule out the threshold.

At similarity 0.8 two texts share each of the 32 buckets with a probability of
about 0.8 ** 5, so a pair is missed with a probability of 3e-6, and less above.

Defined results: words are as in ``decontamination`` (A-Z lower-cased, runs of
letters, digits and non-ASCII characters). A text of fewer than five words is
one shingle. A text without words, or null, is a class of its own. Repeated
rows belong to one class. The class is named by its smallest doc_id (null if
all are null).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.arrow_text import begin_task, give_back, runs, text_bytes
from navspark.llm.common import drop_stored, keep_rows, small, stored

SHINGLE = 5
THRESHOLD = 0.8
ORDERS, PARTS, LEAST = 8, 4, 5
#: How often the components that meet in a bucket are compared there.
ROUNDS = 2
#: How many members of a component are drawn each time.
DRAWS = 3
#: A block of the exact finish has about so many texts and shingles at most (but one text at least).
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 500_000
#: Bits that stand for the shingles of a text there, at most.
MAX_BITS = 1 << 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(int(_BASE), -1, 1 << 64))
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_RUN_BYTES = 1 << 20
#: Words of more bytes are hashed by themselves.
LONG_WORD = 64
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(hash of each byte after lower-casing, whether it is part of a word)."""
    byte = np.arange(256)
    low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    word = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    return np.random.RandomState(11).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)[low], word


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of ``values``, the same wherever the run stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=sums[1:])
    return _mix((sums[end] - sums[start]) * _powers(_UNDO, len(values) + 1)[start])


def _word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of every word, which bytes are part of words)."""
    _, word = _tables()
    inside = word[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before[edge] = False
    after[edge - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1, inside


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    value, _ = _tables()
    out = _spans(value[data], start, end)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():  # sums of powers tell long texts of two letters badly apart
        out[i] = xxhash.xxh3_64_intdigest(_LOW[data[start[i] : end[i]]].tobytes())
    return out


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each text among them)."""
    start, end, _ = _word_spans(data, offsets)
    return _word_hashes(data, start, end), np.searchsorted(start, offsets)


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labelled shingle of every place, offsets of each text among them)."""
    size = np.diff(offsets)
    count = np.where(size > 0, np.maximum(size - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(size)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][owner]
    plain = _spans(words, start, np.minimum(start + SHINGLE, offsets[1:][owner]))
    keyed = plain ^ _mix(owner.astype(np.uint64) * _BASE)
    order = np.argsort(keyed, kind="stable")
    same = np.zeros(len(order), np.int64)
    if len(order):
        new = np.append(True, keyed[order][1:] != keyed[order][:-1])
        first = np.flatnonzero(new)
        same[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return _mix(plain + same.astype(np.uint64) * _FOLD), np.append(0, np.cumsum(count))


def sketch(labelled: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Buckets of each text: an array of ORDERS * PARTS hashes, 0 where a part has no shingle."""
    texts = len(offsets) - 1
    out = np.zeros((texts, ORDERS * PARTS), np.uint64)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(texts, dtype=np.uint64), size)
    place = np.arange(len(owner), dtype=np.uint64)
    for o in range(ORDERS):
        value = _mix(labelled ^ _mix(np.array([o + 1], np.uint64) * _FOLD)) >> np.uint64(32)
        # text, part (the first bits of the hash), hash, place: sorted as one number
        if len(owner) <= 1 << 20:
            key = np.sort((owner << np.uint64(52)) | (value << np.uint64(20)) | place)
            group, places = key >> np.uint64(50), (key & np.uint64((1 << 20) - 1)).astype(np.int64)
        else:  # a long text has places that the number has no room for
            places = np.lexsort((value, owner))
            group = ((owner << np.uint64(2)) | (value >> np.uint64(30)))[places]
        begin = np.searchsorted(group, np.arange(texts * PARTS, dtype=np.uint64))
        end = np.append(begin[1:], len(places))
        at = begin[:, None] + np.arange(LEAST)
        there = at < end[:, None]
        where = places[np.minimum(at, max(len(places) - 1, 0))] if len(places) else np.zeros(at.shape, np.int64)
        where = np.sort(np.where(there, where, 1 << 40), axis=1)  # back to the order of the text
        there = where < 1 << 40
        bucket = np.full(len(begin), np.uint64(0))
        for k in range(LEAST):
            bucket = np.where(there[:, k], _mix(bucket * _BASE + labelled[np.minimum(where[:, k], max(len(labelled) - 1, 0))]) if len(labelled) else bucket, bucket)
        number = np.tile(np.arange(PARTS, dtype=np.uint64), texts) + np.uint64(o * PARTS + 1)
        out[:, o * PARTS : (o + 1) * PARTS] = np.where(there[:, 0], _mix(bucket ^ (number * _FOLD)) | np.uint64(1), np.uint64(0)).reshape(texts, PARTS)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, rid, th (hash of the text), k1, k2 (128 bits of the SHA-256 of its words), n_words, buckets for each row."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"), F.xxhash64("text").alias("th"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in _short_runs(offsets):
                k1, k2, n, words, begin = _identity(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                buckets = sketch(*shingles(words, begin))
                flat = pa.array(buckets.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * buckets.shape[1]), flat)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in ("doc_id", "rid", "th")), pa.array(k1), pa.array(k2), pa.array(n), lists],
                    ["doc_id", "rid", "th", "k1", "k2", "n_words", "buckets"],
                )
            give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, rid long, th long, k1 long, k2 long, n_words long, buckets array<long>")


def _short_runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of at most 4096 texts, as the sort key of a sketch has room for no more."""
    for i, j in runs(offsets, _RUN_BYTES):
        for k in range(i, j, 4096):
            yield k, min(k + 4096, j)


def _identity(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(two halves of a digest of each text's words joined by a space, number of words, word hashes, offsets of each text among them)."""
    start, end, inside = _word_spans(data, offsets)
    begin = np.searchsorted(start, offsets)
    again = np.ones(len(start), bool)
    again[begin[1:][np.diff(begin) > 0] - 1] = False  # the last word of a text has none after it
    kept = inside.copy()
    kept[end[again]] = True
    plain = np.where(inside, _LOW[data], 0x20)[kept].astype(np.uint8)
    at = np.append(0, np.cumsum(kept))[offsets]
    digests = b"".join(hashlib.sha256(plain[a:b]).digest()[:16] for a, b in zip(at[:-1], at[1:], strict=True))
    halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy(), np.diff(begin).astype(np.int64), _word_hashes(data, start, end), begin


def _texts(docs: DataFrame) -> DataFrame:
    """k1, k2, z: texts, compressed, by the digest of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in _short_runs(offsets):
                k1, k2, *_ = _identity(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                z = [press.compress(data[a:b]) for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(z, pa.binary())], ["k1", "k2", "z"])
            give_back()

    return docs.select("text").mapInArrow(run, "k1 long, k2 long, z binary")


def similarity(a: np.ndarray, b: np.ndarray, least: float = THRESHOLD) -> float:
    """Banded alignment of two labelled shingle sequences; 0 where it is certainly below ``least``."""
    n, m = len(a), len(b)
    need = least * (n + m) / (1 + least)
    if min(n, m) < need - 1e-9:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    band = n + m - 2 * need
    at_b = at_b[np.abs(at_a - at_b) <= band]
    if len(at_b) < need - 1e-9:
        return 0.0
    if (np.diff(at_b) > 0).all():
        common = len(at_b)
    else:  # labels are unique, so the longest common subsequence is the longest increasing run of places
        tails: list[int] = []
        for x in at_b.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        common = len(tails)
    return common / (n + m - common)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, sim for the distinct pairs (a, b), as a stored table; only texts of pairs are shuffled."""
    pairs = stored(pairs.select("a", "b"))
    n = pairs.count()
    left = texts.toDF("b", "zb").join(small(pairs, n), "b")
    right = texts.toDF("a", "za").join(small(pairs.select("a").distinct(), n), "a", "left_semi")
    both = left.join(right, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()

        @lru_cache(maxsize=32)
        def sequence(z: bytes) -> np.ndarray:
            raw = np.frombuffer(press.decompress(z), np.uint8)
            return shingles(*text_words(raw, np.array([0, len(raw)])))[0]

        for batch in batches:
            sims = [similarity(sequence(x), sequence(y)) for x, y in zip(batch.column("za").to_pylist(), batch.column("zb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], ["a", "b", "sim"])
        sequence.cache_clear()
        give_back()

    out = stored(both.select("a", "b", "za", "zb").mapInArrow(run, "a long, b long, sim double"))
    drop_stored(pairs)
    return out


def merge_components(labels: DataFrame, n_labels: int, links: DataFrame) -> DataFrame:
    """(node, comp), stored, after joining the components at the ends of each link (a, b): larger ones hook to the least neighbour.

    ``links`` is read several times. Only the table of hooks meets the labels, and only once a round.
    """
    n = links.count()
    near = labels.toDF("a", "ca").join(small(links.select("a", "b"), n), "a")
    both = labels.toDF("b", "cb").join(small(near, n), "b")
    edges = stored(both.select(F.greatest("ca", "cb").alias("x"), F.least("ca", "cb").alias("y")).where("x != y").distinct(), n)
    kept = []
    while (n := edges.count()) > 0:
        hook = stored(edges.groupBy("x").agg(F.min("y").alias("p")), n)
        jump = stored(hook.join(small(hook.toDF("p", "q"), n), "p", "left").select("x", F.coalesce("q", "p").alias("p")), n)
        labels = labels.join(small(jump.toDF("comp", "p"), n), "comp", "left").select("node", F.coalesce("p", "comp").alias("comp"))
        moved = edges.join(small(jump.toDF("x", "px"), n), "x", "left").join(small(jump.toDF("y", "py"), n), "y", "left")
        moved = moved.select(F.coalesce("px", "x").alias("u"), F.coalesce("py", "y").alias("v")).where("u != v")
        left = stored(moved.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y")).distinct(), n)
        drop_stored(edges, hook)
        kept.append(jump)
        edges = left
    out = stored(labels, n_labels)
    drop_stored(edges, *kept)
    return out


def _candidates(live: DataFrame, number: int) -> DataFrame:
    """(a, b): in each bucket DRAWS members of each component against as many of all, drawn anew by ``number``."""
    draws = range(number * DRAWS, number * DRAWS + DRAWS)
    pick = lambda node: [F.min_by(node(k), F.xxhash64(node(k), "bucket", F.lit(k))) for k in draws]
    each = live.groupBy("bucket", "comp").agg(*[c.alias(f"n{k}") for k, c in zip(draws, pick(lambda _: F.col("node")), strict=True)])
    head = each.groupBy("bucket").agg(F.count("*").alias("comps"), *[c.alias(f"o{k}") for k, c in zip(draws, pick(lambda k: F.col(f"n{k}")), strict=True)])
    met = each.join(head.where("comps > 1"), "bucket")
    rows = met.select(F.explode(F.array(*[F.struct(F.col(f"n{k}").alias("n"), F.col(f"o{k}").alias("o")) for k in draws])).alias("x")).where("x.n != x.o")
    return rows.select(F.least("x.n", "x.o").alias("a"), F.greatest("x.n", "x.o").alias("b")).distinct()


def _bits(sequences: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each sequence: those that its shingles hash to."""
    longest = max(len(x) for x in sequences)
    width = min(max(1 << (16 * longest).bit_length(), 64), MAX_BITS)
    out = np.zeros((len(sequences), width // 64), np.uint64)
    for row, own in zip(out, sequences, strict=True):
        at = _mix(own) & np.uint64(width - 1)
        np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def _block_links(group: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Pairs of nodes at ``threshold`` or above that join the components of a block, or of two blocks, wherever such pairs do."""
    press = zstandard.ZstdDecompressor()
    texts = [press.decompress(z) for z in group.column("z").to_pylist()]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    sequences: list[np.ndarray] = []
    for i, j in _short_runs(offsets):
        data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        labelled, begin = shingles(*text_words(data, offsets[i : j + 1] - offsets[i]))
        sequences += [labelled[x:y] for x, y in zip(begin[:-1], begin[1:], strict=True)]
    node, comp, second = (group.column(c).to_numpy() for c in ("node", "comp", "second"))
    comp = comp.copy()
    size, bits = np.array([len(x) for x in sequences]), _bits(sequences)
    two = bool(second.any())
    links = []
    for a in np.flatnonzero(~second) if two else range(len(node)):
        need = threshold * (size[a] + size) / (1 + threshold) - 1e-9
        may = (comp != comp[a]) & (np.minimum(size, size[a]) >= need)
        may[: a + 1] &= two
        if two:
            may &= second
        for b in np.array_split(at := np.flatnonzero(may), len(at) // 256 + 1):
            # A bit of one text that the other lacks stands for a shingle, or more, that the other lacks.
            b = b[size[a] - np.bitwise_count(bits[a] & ~bits[b]).sum(1, dtype=np.int64) >= need[b]]
            b = b[size[b] - np.bitwise_count(bits[b] & ~bits[a]).sum(1, dtype=np.int64) >= need[b]]
            for k in b.tolist():
                if comp[k] != comp[a] and similarity(sequences[a], sequences[k], threshold) >= threshold:
                    links.append((int(node[a]), int(node[k])))
                    comp[comp == comp[k]] = comp[a]
    return links


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """(node, comp, n, s): every labelled shingle of the texts (node, comp, z), n of them in a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for node, comp, z in zip(*(batch.column(c).to_pylist() for c in ("node", "comp", "z")), strict=True):
                raw = np.frombuffer(press.decompress(z), np.uint8)
                s = shingles(*text_words(raw, np.array([0, len(raw)])))[0].view(np.int64)
                same = [pa.array(np.full(len(s), x)) for x in (node, comp, len(s))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(s)], ["node", "comp", "n", "s"])

    return texts.select("node", "comp", "z").mapInArrow(run, "node long, comp long, n long, s long")


def _linkable(star: DataFrame, labels: DataFrame, n_labels: int, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, comp, z, n: its shingles), stored, of the nodes of ``star`` that may be at ``threshold`` with a text of another component.

    At least the threshold's share of such a text's shingles occur in other
    components. Texts that share less with all of them together, most of those
    that merely met in a bucket, leave here.
    """
    nodes = star.select(F.col("b").alias("node")).distinct()
    opened = stored(texts.join(small(nodes, n_labels), "node").join(small(labels, n_labels), "node").select("node", "comp", "z"))
    rows = _shingle_rows(opened)
    shared = rows.groupBy("s").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2").select("s")
    enough = rows.join(shared, "s").groupBy("node", "n").agg(F.count("*").alias("m")).where(F.col("m") >= threshold * F.col("n") - 1e-9)
    out = stored(opened.join(small(enough.select("node", "n"), n_labels), "node"))
    drop_stored(opened)
    return out


def _exact_links(buckets: DataFrame, labels: DataFrame, n_labels: int, tested: DataFrame, texts: DataFrame, threshold: float) -> DataFrame | None:
    """(a, b), stored, that join all components with a pair at ``threshold`` or above in a bucket; None if no bucket is open."""
    live = buckets.join(small(labels, n_labels), "node")
    mixed = live.groupBy("bucket").agg(
        F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")
    )
    mixed = stored(mixed.where("c1 != c2").select("bucket", "n", "a", "b"))
    pairs = mixed.where("n = 2").join(tested.select("a", "b"), ["a", "b"], "left_anti").select("bucket", "a")
    left = mixed.where("n > 2").select("bucket", "a").unionByName(pairs)
    star = stored(buckets.join(small(left, mixed.count()), "bucket").select("a", F.col("node").alias("b")).distinct())
    drop_stored(mixed)
    if star.isEmpty():
        drop_stored(star)
        return None
    nodes = _linkable(star, labels, n_labels, texts, threshold)
    # What is left of a bucket is connected through its least node, whether that may link or not.
    known = star.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    alone = stored(known.withColumn("comp", F.col("node")), n_labels)
    ends = stored(star.join(small(nodes.select(F.col("node").alias("b")), n_labels), "b", "left_semi").where("a != b"), n_labels)
    clusters = merge_components(alone, n_labels, ends)
    sized = nodes.select("node", "comp", "n")
    placed = stored(sized.join(small(clusters.toDF("node", "cluster"), n_labels), "node"), n_labels)
    blocks = placed.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"), F.min("comp").alias("c1"), F.max("comp").alias("c2")
    )
    blocks = blocks.where("c1 != c2").select("cluster", "blocks")
    own, other = F.pmod(F.xxhash64("node"), "blocks").cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.join(small(blocks, n_labels), "cluster").select("cluster", "node", own.alias("own"), other.alias("other"))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "second": F.col("own") > F.col("other")})

    def run(group: pa.Table) -> pa.Table:
        links = _block_links(group, threshold)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    both = dealt.join(nodes.select("node", "comp", "z"), "node").select("cluster", "i", "j", "node", "comp", "second", "z")
    out = stored(both.groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long"))
    drop_stored(star, alone, ends, clusters, placed, nodes)
    return out


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, th (xxhash64 of the text), class_id, class_size, first for each row of ``docs``.

    ``first`` marks one row of each class: that of the smallest doc_id.
    """
    rows = stored(signatures(docs))
    words = F.col("n_words") > 0
    same = rows.where(words).groupBy("k1", "k2").agg(F.min("rid").alias("node"))
    members = rows.where(words).select("doc_id", "rid", "th", "k1", "k2").join(same, ["k1", "k2"])
    members = stored(members.unionByName(rows.where(~words).select("k1", "k2", "doc_id", "rid", "th", F.col("rid").alias("node"))))
    firsts = members.where("rid = node").select("rid")
    nodes = rows.where(words).join(firsts, "rid", "left_semi")
    every = nodes.select(F.col("rid").alias("node"), F.explode(F.array_remove("buckets", 0)).alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("a")).where("n > 1").select("bucket", "a")
    met = stored(every.join(shared, "bucket"))
    buckets = met.select("node", "bucket")
    n = buckets.select("node").distinct().count()
    labels = stored(buckets.select("node").distinct().withColumn("comp", F.col("node")), n)
    wanted = members.where("rid = node").select("k1", "k2", "node").join(small(labels.select("node"), n), "node", "left_semi")
    texts = stored(_texts(docs).join(small(wanted, n), ["k1", "k2"]).groupBy("node").agg(F.first("z").alias("z")))

    drop_stored(rows)
    # The first candidate of a text is the one it shares most buckets with; that settles most texts.
    pairs = met.where("node != a").groupBy("node", "a").agg(F.count("*").alias("n"))
    best = pairs.groupBy("node").agg(F.max(F.struct("n", (-F.col("a")).alias("m"))).alias("best"))
    tested = _verified(best.select((-F.col("best.m")).alias("a"), F.col("node").alias("b")), texts)
    links = tested.where(F.col("sim") >= threshold)
    first, labels = labels, merge_components(labels, n, links)
    drop_stored(first)
    for number in range(ROUNDS):
        live = buckets.join(small(labels, n), "node")
        known = tested.count()
        found = _verified(_candidates(live, number).join(small(tested.select("a", "b"), known), ["a", "b"], "left_anti"), texts)
        more = found.count()
        links = stored(found.where(F.col("sim") >= threshold), more)
        old = [labels, tested, found, links]
        tested = stored(tested.unionByName(found), known + more)
        labels = merge_components(labels, n, links)
        drop_stored(*old)
    links = _exact_links(buckets, labels, n, tested, texts, threshold)
    drop_stored(met, tested, texts)
    if links is not None:
        old = [labels, links]
        labels = merge_components(labels, n, links)
        drop_stored(*old)
    whole = members.join(small(labels, n), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    named = whole.groupBy("comp").agg(F.min(order).alias("head"), F.count("*").alias("class_size"))
    return whole.join(named, "comp").select(
        "doc_id", "th", F.col("head.id").alias("class_id"), "class_size", (F.col("rid") == F.col("head.rid")).alias("first")
    )


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, columns unchanged."""
    found = near_duplicates(docs, threshold).groupBy("doc_id", "th").agg(F.max(F.col("first").cast("int")).alias("one"), F.count("*").alias("n"))
    return keep_rows(docs, found.where("one = 1").select("doc_id", F.col("th").alias("key"), "n"), F.xxhash64("text"))
