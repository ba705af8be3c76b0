"""Best-fit packing of tokenized documents into sequences of bounded capacity.

A document is its token ids followed by id 0. Longer documents than a sequence
are cut into full pieces behind a shorter first one. Pieces are dealt at random
into groups of about GROUP pieces; inside a group they are placed, longest
first, by vector best fit: a sequence has three residual capacities (tokens,
documents, attention cost as the sum of squared lengths) and a piece goes to
the open sequence that can take it in all three and is left with the smallest
weighted residual norm (or has the largest weighted dot product). The number of
groups grows with the input, a group does not; each costs at most about one
half-filled sequence.

Token ids come from a byte-level BPE in the ``tokenizers`` JSON format whose
path is a parameter. Its vocabulary is loaded once in each Python worker;
stretches between plain spaces are looked up in a bounded cache and encoded
only when new, which gives the same ids since the tokenizer never merges across
such a space.

Defined results: null text is an empty document of the single id 0; so every
row gives at least one piece. Repeated rows are packed each for itself. An
empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.arrow_text import give_back, runs, text_bytes
from navspark.llm.common import cut

CAPACITY = 2048
#: Pieces that are packed together in one task.
GROUP = 8192
#: Distinct stretches that a worker remembers.
CACHE = 250_000
RUN_BYTES = 1 << 20

# Fixed value: how the byte-level BPE of this vocabulary splits text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of UTF-8 texts by the tokenizer in a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.known: dict[bytes, int] = {}  # place in the pool << 32 | number of ids
        self.pool = array("I")
        self.specials = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self._whole = None
        self._path = path
        self._encode = self._bpe(spec) or self._by_library

    @staticmethod
    def _bpe(spec: dict):
        """An encoder for a plain byte-level BPE whose merges are in the order of their ids, else None."""
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not plain:
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        added = {t["content"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        merged = [ranks[bytes(byte[c] for c in "".join(m))] for m in pairs]
        if merged != sorted(merged):
            return None
        return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _by_library(self, text: str) -> list[int]:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._path)
        return self._whole.encode(text, add_special_tokens=False).ids

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text among them)."""
        raw = data.tobytes()
        start, begins = self._stretches(data, offsets)
        end = np.append(start[1:], len(data))
        first, which = _distinct(data, start, end)
        packed = np.zeros(len(first), np.int64)
        spare = array("I")  # ids of stretches beyond what the cache may hold
        for k, (i, j) in enumerate(zip(start[first].tolist(), end[first].tolist(), strict=True)):
            piece = raw[i:j]
            found = self.known.get(piece)
            if found is None:
                text = piece.decode("utf-8")
                special = self.specials and any(s in piece for s in self.specials)
                made = self._by_library(text) if special else self._encode(text)
                if len(self.known) < CACHE:
                    found = self.known[piece] = len(self.pool) << 32 | len(made)
                    self.pool.extend(made)
                else:
                    found = (-1 - len(spare)) << 32 | len(made)
                    spare.extend(made)
            packed[k] = found
        place, size = packed >> 32, packed & 0xFFFFFFFF
        place = np.where(place < 0, len(self.pool) - 1 - place, place)
        pool = np.concatenate([np.frombuffer(x, np.uint32) if len(x) else np.zeros(0, np.uint32) for x in (self.pool, spare)])
        each = size[which]
        ends = np.cumsum(each)
        at = np.repeat(place[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        return pool[at], np.append(0, ends)[begins]

    @staticmethod
    def _stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts of stretches, number of stretches before each text): a text breaks before a single space between visible characters."""
        ok = (data > 0x20) & (data != 0x7F)
        for lead in (0xC2, 0xE1, 0xE2, 0xE3):  # first bytes of all white space beyond ASCII
            at = np.flatnonzero(data == lead)
            for k in range(3):
                ok[np.minimum(at + k, len(data) - 1)] = False
        cut_here = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            cut_here[1:-2] = (data[1:-1] == 0x20) & ok[:-2] & ok[2:]
        texts = offsets[:-1][np.diff(offsets) > 0]
        cut_here[np.clip(offsets, 0, len(data))] = False
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        cut_here[ends] = False  # the space that ends a text has nothing behind it
        cut_here[texts] = True
        start = np.flatnonzero(cut_here[: len(data)])
        return start, np.searchsorted(start, offsets)


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a stretch of each kind, the kind of every stretch); equal hashes are one kind only where the bytes are equal."""
    _, first, which = np.unique(_hashes(data, start, end), return_index=True, return_inverse=True)
    like = first[which]
    size = end - start
    same = size == size[like]
    length = np.where(same, size, 0)
    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    differ = data[inner + np.repeat(start, length)] != data[inner + np.repeat(start[like], length)]
    if differ.any():
        same[np.repeat(np.arange(len(start)), length)[differ]] = False
    lone = np.flatnonzero(~same)
    which[lone] = len(first) + np.arange(len(lone))
    return np.append(first, lone), which


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes, its length included."""
    with np.errstate(over="ignore"):
        table = np.random.RandomState(5).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        at = np.arange(len(data)) - np.repeat(start, end - start)
        longest = int((end - start).max()) if len(start) else 0
        powers = np.ones(longest + 1, np.uint64)
        np.multiply.accumulate(np.full(longest, base), out=powers[1:])
        total = np.append(np.uint64(0), np.cumsum(table[data] * powers[at]))
        h = total[end] - total[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for ``path``; it outlives a task."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, rid, piece, start, length, ids_crc32."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, rid long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in runs(offsets, RUN_BYTES):
                ids, begin = enc.ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total = np.diff(begin) + 1
                count = -(-total // capacity)
                owner = np.repeat(np.arange(len(total)), count)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                short = total - (count - 1) * capacity
                start = np.where(number > 0, short[owner] + (number - 1) * capacity, 0)
                length = np.where(number > 0, capacity, short[owner])
                little = ids.astype("<u4")
                crc = np.empty(len(owner), np.int64)
                for k, (d, s, n) in enumerate(zip(owner.tolist(), start.tolist(), length.tolist(), strict=True)):
                    at = begin[d] + s
                    last = s + n == total[d]
                    crc[k] = zlib.crc32(b"\0\0\0\0", zlib.crc32(little[at : at + n - 1])) if last else zlib.crc32(little[at : at + n])
                take = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("rid").take(take), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                    ["doc_id", "rid", "piece", "start", "length", "ids_crc32"],
                )
            give_back()

    return rows.mapInArrow(run, schema)


def vector_best_fit(
    length: np.ndarray,
    capacity: int = CAPACITY,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; no bin exceeds any of the three capacities."""
    full = np.array([capacity, max_documents or capacity, max_attention or capacity * capacity], np.float64)
    w = np.array(weights)
    order = np.argsort(-length, kind="stable")
    least = int(length.min()) if len(length) else 0
    where = np.zeros(len(length), np.int64)
    offset = np.zeros(len(length), np.int64)
    rest = np.zeros((3, len(length)))  # residual capacities of the open bins
    names = np.zeros(len(length), np.int64)
    opened = live = 0
    for n, i in enumerate(order):
        need = np.array([length[i], 1.0, float(length[i]) ** 2])
        if (need > full).any():
            raise ValueError(f"a piece of {length[i]} tokens fits no sequence")
        if n % 128 == 0 and live:  # bins that can take nothing more are closed
            stay = np.flatnonzero((rest[0, :live] >= least) & (rest[1, :live] >= 1) & (rest[2, :live] >= least * least))
            rest[:, : len(stay)], names[: len(stay)], live = rest[:, stay], names[stay], len(stay)
        left = rest[:, :live] - need[:, None]
        fit = np.flatnonzero((left >= 0).all(axis=0))
        if len(fit):
            if rule == "norm":
                at = fit[np.argmin(w @ (left[:, fit] / full[:, None]) ** 2)]
            else:
                at = fit[np.argmax((w * need / full) @ (rest[:, fit] / full[:, None]))]
        else:
            at = live
            rest[:, at], names[at] = full, opened
            opened, live = opened + 1, live + 1
        where[i], offset[i] = names[at], capacity - rest[0, at]
        rest[:, at] -= need
    return where, offset


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **limits: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    made = cut(pieces(docs, tokenizer, capacity))
    groups = max(1, -(-made.count() // GROUP))
    dealt = made.withColumn("nv_group", F.pmod(F.xxhash64("rid", "piece"), F.lit(groups)))
    kind = dict(made.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rid", "ascending"), ("piece", "ascending")])
        where, offset = vector_best_fit(table.column("length").to_numpy(), capacity, **limits)
        group = table.column("nv_group")[0].as_py()
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        table = table.append_column("sequence_id", pa.array(where + (group << 32)))
        return table.append_column("offset", pa.array(offset))

    return dealt.groupBy("nv_group").applyInArrow(place, schema)
