"""Runs of periodic words inside texts, found with a dictionary of basic factors.

A run is a longest stretch of words in which words ``period`` apart are equal,
``period`` being the smallest such number, of at least two periods and LEAST
words. For each length 1, 2, 4, ... every stretch of that many words (a factor)
has a number, made of the numbers of its halves; stretches that occur once in
their text leave, as nothing longer around them can recur. For each length m the
occurrences of a factor are walked from one to its successors less than 2 m
away. Occurrences at most m / 2 apart are an arithmetic progression whose step is
the factor's own period. The distances that propose periods of m to 2 m - 1 are
those to the first member of a progression, and those from the last member of
one: a run of such a period always has one of both kinds, however its words
repeat inside a period, so no others are tried. Each proposal is extended both
ways as far as the words agree; the same stretch keeps its smallest period.

Spark deals the texts out; no row needs another, so nothing is shuffled. A task
takes texts together up to some megabytes, and a longer text by itself, in
memory of about ten times its size.

Defined results: words are stretches without any of ``[\\x20\\x09-\\x0D]``. A
null, empty or blank text has no words, no runs and an empty collapsed text.
Repeated rows, null ids and ids that repeat give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from navspark.llm.arrow_text import runs, text_bytes

#: A run has so many words at least.
LEAST = 12
#: Words that are compared at once on either side of a proposal; those that agree for longer are followed by themselves.
NEAR = 32
_BLOCK = 1 << 15


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of every word among the bytes, offsets of each text among the words)."""
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One number for each different word."""
    size = np.append(0, np.cumsum(end - start))
    packed = data[np.repeat(start - size[:-1], end - start) + np.arange(size[-1])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _near_pairs(place: np.ndarray, factor: np.ndarray, ends: np.ndarray, step: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, distance) of each of ``ends`` and the occurrences of its factor m to 2 m - 1 away, after it or (step -1) before it."""
    other = ends + step
    while len(ends):
        there = (other >= 0) & (other < len(place))
        ends, other = ends[there], other[there]
        away = np.abs(place[other] - place[ends])
        near = (factor[other] == factor[ends]) & (away < 2 * m)
        ends, other, away = ends[near], other[near], away[near]
        far = away >= m
        yield np.minimum(place[ends], place[other])[far], away[far]
        other = other + step


def proposals(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): at each place as many words as the largest power of two up to the period recur a period later."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, number = np.arange(len(words)), np.full(len(words), -1)
    key, m = owner * (words.max(initial=0) + 1) + words, 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        factor = np.cumsum(np.append(False, key[1:] != key[:-1]))
        again = np.bincount(factor)[factor] > 1
        place, factor = at[again], factor[again]
        close = (factor[1:] == factor[:-1]) & (2 * np.diff(place) <= m)
        first, last = np.flatnonzero(np.append(True, ~close)[: len(place)]), np.flatnonzero(np.append(~close, True)[: len(place)])
        found += _near_pairs(place, factor, first, -1, m)
        found += _near_pairs(place, factor, last, 1, m)
        number[place] = factor
        at = np.sort(place[place + m < len(words)])
        at = at[number[at + m] >= 0]
        key = number[at] * len(words) + number[at + m]
        number[place] = -1
        m *= 2
    return np.concatenate([x for x, _ in found]), np.concatenate([q for _, q in found])


def _agreeing(words: np.ndarray, x: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, step: int) -> np.ndarray:
    """How many of the NEAR words from each x on (step -1: down) agree with those q later, inside the text."""
    out = np.empty(len(x), np.int64)
    for i in range(0, len(x), _BLOCK):
        part = slice(i, i + _BLOCK)
        at = x[part, None] + step * np.arange(NEAR)
        inside = (at >= low[part, None]) & (at + q[part, None] < high[part, None])
        at = np.where(inside, at, 0)
        differ = ~inside | (words[at] != words[np.where(inside, at + q[part, None], 0)])
        out[part] = np.where(differ.any(1), differ.argmax(1), NEAR)
    return out


def _agree_on(words: np.ndarray, x: int, q: int, low: int, high: int) -> tuple[int, int]:
    """(first, last exclusive) place of the longest stretch around x whose words agree with those q later."""
    first = last = x
    size = NEAR
    while last < high - q:
        a = words[last : min(last + size, high - q)]
        differ = np.flatnonzero(a != words[last + q : last + q + len(a)])
        if len(differ):
            last += int(differ[0])
            break
        last, size = last + len(a), size * 2
    size = NEAR
    while first > low:
        a = words[max(first - size, low) : first]
        differ = np.flatnonzero(a != words[first - len(a) + q : first + q])
        if len(differ):
            first -= len(a) - 1 - int(differ[-1])
            break
        first, size = first - len(a), size * 2
    return first, last


def word_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of the texts, places counted through all of them; by start, then period."""
    x, q = proposals(words, bounds)
    order = np.lexsort((x, q))
    x, q = x[order], q[order]
    m = 1 << (np.frexp(q.astype(np.float64))[1] - 1).astype(np.int64)
    # A place within the words that are known to agree from the one before it belongs to the same stretch.
    new = np.append(True, (q[1:] != q[:-1]) | (x[1:] > x[:-1] + m[:-1]))[: len(x)]
    x, q, m = x[new], q[new], m[new]
    text = np.searchsorted(bounds, x, side="right") - 1
    low, high = bounds[text], bounds[text + 1]
    need = np.maximum(LEAST, 2 * q) - q
    after, before = _agreeing(words, x + m, q, low, high, 1), _agreeing(words, x - 1, q, low, high, -1)
    whole = (after < NEAR) & (before < NEAR)
    long_enough = before + m + after >= need
    ready = whole & long_enough
    made = [np.stack([x - before, before + m + after + q, q], 1)[ready]]
    seen = (0, 0, 0)
    for i in np.flatnonzero(~whole).tolist():
        a, p = int(x[i]), int(q[i])
        if seen[2] == p and seen[0] <= a < seen[1]:
            continue
        first, last = _agree_on(words, a, p, int(low[i]), int(high[i]))
        seen = (first, last, p)
        if last - first >= need[i]:
            made.append(np.array([[first, last + p - first, p]]))
    start, length, period = np.concatenate(made).T
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _lists(kind: pa.DataType, offsets: np.ndarray, *fields: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(kind)))


def _collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    size = np.where(kept, end - start + 1, 0)
    head = np.append(0, np.cumsum(size))
    at = np.repeat(start - head[:-1], size) + np.arange(head[-1])
    spaces = head[1:][kept] - 1
    at[spaces] = 0
    out = data[at] if len(at) else np.zeros(0, np.uint8)
    out[spaces] = 0x20
    edges = head[bounds]
    some = np.diff(edges) > 0
    out = np.delete(out, edges[1:][some] - 1)
    edges = np.append(0, np.cumsum(np.diff(edges) - some))
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (doc_id), n_words, runs and collapsed for each row of ``docs``.

    ``runs`` has (start, length, period) of every run by start, then period;
    words count from 0. ``collapsed`` is the words joined by one space, without
    those that a run contains after its first period.
    """
    keep = keep or ["doc_id"]
    rows = docs.select(*[docs[c].alias(f"nv_{i}") for i, c in enumerate(keep)], docs[text].alias("nv_text"))
    own = ", ".join(f"nv_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("nv_text"))
            for i, j in runs(offsets):
                part = data[offsets[i] : offsets[j]]
                start, end, bounds = word_spans(part, offsets[i : j + 1] - offsets[i])
                at, length, period = word_runs(word_numbers(part, start, end), bounds)
                text_of = np.searchsorted(bounds, at, side="right") - 1
                inside = np.zeros(len(start) + 1, np.int64)
                np.add.at(inside, at + period, 1)
                np.add.at(inside, at + length, -1)
                found = _lists(run_type, np.searchsorted(text_of, np.arange(j - i + 1)), at - bounds[text_of], length, period)
                collapsed = _collapsed(part, start, end, bounds, np.cumsum(inside)[:-1] == 0)
                columns = [batch.column(c).slice(i, j - i) for c in range(len(keep))]
                names = [f"nv_{c}" for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(bounds)), found, collapsed], [*names, "n_words", "runs", "collapsed"])

    made = rows.mapInArrow(run, f"{own}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return made.toDF(*keep, "n_words", "runs", "collapsed")
