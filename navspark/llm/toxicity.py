"""Toxicity by compression distance: windows under an ordinary and a toxic dictionary.

Both zstandard dictionaries start with the same one, trained on ordinary text.
The toxic one ends in what is typical of toxic text: words, and strings inside
words, that occur in far more toxic than ordinary documents of the sample. The
ordinary one ends in as many bytes that match nothing, so that a window's two
compressed sizes differ only where the toxic ending was of use. Every window of
64 bytes (a step of 32) is compared: first with a fast search, then, where the
sizes differ, with a thorough one. The size differences of a document, by
calibrated weights, give its score.

The fit uses at most PER_CLASS labelled rows of each class; without toxic or
without ordinary text every document scores 0.

Defined results: null counts as empty; an empty text has no window and scores
as a text without a differing window. Repeated rows are each scored. Labels of
unknown or null ids are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm import compression as C
from navspark.llm.arrow_text import runs, windows

#: Bound of the labelled sample.
PER_CLASS = 3000
THRESHOLD = 0.3
WIDTH, STRIDE = 64, 32
BASE = 32 * 1024
#: Length of the compared byte grams, and how much more often a typical one occurs in toxic documents.
GRAM, RATIO = 5, 20
#: It occurs in at least this share of the toxic sample, and in at least so many documents.
SHARE, LEAST = 0.008, 5
ENDING = 8 * 1024
_FAST = dict(window_log=17, hash_log=17, chain_log=17, min_match=5, search_log=4, strategy=zstandard.STRATEGY_GREEDY)
_THOROUGH = dict(window_log=17, hash_log=17, chain_log=17, min_match=5, search_log=4, strategy=zstandard.STRATEGY_BTLAZY2)


#: A word with the space before it, and what follows it.
_WORD = re.compile(rb"( [A-Za-z\x80-\xff]{4,})(?=(.{0,12}))", re.S)


def _grams(text: bytes) -> np.ndarray:
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(a) - GRAM + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM if n > 0 else 0):
        out = (out << np.uint64(8)) | a[i : n + i]
    return out


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


def _count_of(grams: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    return np.where(keys[at] == grams, counts[at], 0)


def typical(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words and strings inside words that are typical of toxic text, the most frequent first; none holds another."""
    keys, counts = _document_counts(toxic)
    base = _count_of(keys, *_document_counts(ordinary))
    least = max(LEAST, SHARE * len(toxic))
    often = (counts >= least) & (counts / len(toxic) >= RATIO * (base + 1) / len(ordinary))
    keys = keys[often]
    found: Counter = Counter()
    for text in toxic if len(keys) else []:
        grams = _grams(text)
        if not len(grams):
            continue
        raw = np.frombuffer(text, np.uint8)
        letter = (raw >= 0x80) | (((raw | 0x20) >= 0x61) & ((raw | 0x20) <= 0x7A))
        inside = letter[: len(grams)] | (raw[: len(grams)] == 0x20)
        for i in range(1, GRAM):
            inside &= letter[i : len(grams) + i]
        at = np.flatnonzero((_count_of(grams, keys, np.ones(len(keys), int)) > 0) & inside)
        if len(at):
            gap = np.flatnonzero(np.diff(at) > 1)
            found.update(text[i:j] for i, j in zip(np.r_[at[0], at[gap + 1]], np.r_[at[gap], at[-1]] + GRAM, strict=True))
    places = {(w, after) for t in toxic for w, after in _WORD.findall(t)}  # near copies share what follows, and count once
    plain = Counter(w for t in ordinary for w in {w for w, _ in _WORD.findall(t)})
    whole = {w: n for w, n in Counter(w for w, _ in places).items() if n >= least and n / len(toxic) >= RATIO * (plain[w] + 1) / len(ordinary)}
    out: list[bytes] = []
    for s, _ in [*sorted(found.items(), key=lambda x: (-x[1], x[0])), *sorted(whole.items(), key=lambda x: (-x[1], x[0]))]:
        known = any(x in s for x in out) if s in whole else False  # a word is told by a string inside it already
        if sum(map(len, out)) + len(s) <= ENDING and not known and not any(s in x for x in out):
            out.append(s)
    return out


def train(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries."""
    parts = [t[i : i + C.SAMPLE_WIDTH] for t in ordinary for i in range(0, len(t), C.SAMPLE_WIDTH)]
    try:
        base = zstandard.train_dictionary(min(BASE, sum(map(len, parts)) // 8), parts, k=64, d=8, steps=4, split_point=1.0, threads=1).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the text itself is the dictionary
        base = b"".join(parts)[-BASE:]
    ending = b"\n".join(reversed(typical(toxic, ordinary)))
    neutral = np.random.RandomState(1).randint(1, 8, len(ending)).astype(np.uint8).tobytes()
    return base + neutral, base + ending


def window_differences(ordinary: bytes, toxic: bytes):
    """A function of (bytes, offsets): the NAMES features of each text."""

    def of_texts(data: bytes, offsets: np.ndarray) -> np.ndarray:
        fast = [C.compressor(d, **_FAST) for d in (ordinary, toxic)]
        thorough = [C.compressor(d, **_THOROUGH) for d in (ordinary, toxic)]
        out = np.zeros((len(offsets) - 1, len(NAMES)))
        for first, last in runs(offsets):
            start, length, owner = windows(offsets[first : last + 1], WIDTH, STRIDE)
            out[first:last, 4] = np.log1p(np.bincount(owner, minlength=last - first))
            differ = np.flatnonzero(C.lengths(fast[0], data, start, length) != C.lengths(fast[1], data, start, length))
            start, length, owner = start[differ], length[differ], owner[differ]
            gain = np.maximum(C.lengths(thorough[0], data, start, length) - C.lengths(thorough[1], data, start, length), 0)
            np.maximum.at(out[first:last, 0], owner, np.minimum(gain, 8))
            count = np.maximum(np.expm1(out[first:last, 4]), 1)
            for k, least in ((1, 2), (2, 3), (3, 4)):
                found = np.bincount(owner, gain >= least, last - first)
                out[first:last, k], out[first:last, k + 4] = np.log1p(found), np.sqrt(found / count)
            out[first:last, 8] = out[first:last, 2] * out[first:last, 4]
        return out

    return of_texts


#: The largest gain of a window; numbers of windows that gain 2, 3 and 4 bytes; all windows; shares of the three; a product.
NAMES = ["nv_most", "nv_two", "nv_three", "nv_four", "nv_windows", "nv_share2", "nv_share3", "nv_share4", "nv_both"]


def score_toxicity(docs: DataFrame, labels: DataFrame, train_on: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and score; ``train_on`` says which label rows may be learned from."""
    fitted = C.cross_fit(C.labelled(docs, labels, "toxic", train_on, PER_CLASS), train, window_differences, NAMES)
    if fitted is None:
        return docs.select(*keep, F.lit(0.0).alias("score"))
    of_texts, seen, label = fitted
    weights = C.fit_logistic(seen, label, ridge=1.0)
    weights[-1] += C.prior_shift(labels, "toxic", train_on, label)
    return C.features(docs, of_texts, NAMES, keep).select(*keep, C.logistic(weights, [F.col(n) for n in NAMES]).alias("score"))
