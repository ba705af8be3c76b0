"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

Every window of 64 bytes of a text is compressed with both dictionaries, and so
is the text in blocks of 16 KB. The score is a logistic calibration of
normalised size differences, ``(bad - good) / (bad + good)``: that of the summed
window sizes and of the block sizes, the mean, the extremes and the distribution
of the windows' differences, and one under the good dictionary alone, between
the size in blocks and in windows, which tells text that repeats itself.

The fit uses at most PER_CLASS labelled rows of each class. If a class has no
labelled text, every document scores the share of label 1 (0.5 without labels).

Defined results: null counts as empty; an empty text has no difference and the
calibrated score of that. Repeated rows are each scored. Labels of unknown or
null ids are ignored.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm import compression as C
from navspark.llm.arrow_text import runs, windows
from navspark.llm.common import fresh

#: Bound of the labelled sample.
PER_CLASS = 3000
#: A score of at least this predicts label 1.
THRESHOLD = 0.3
WIDTH = 64
BLOCK = 1 << 14
#: Shares of the windows whose difference is beyond each of these, on either side.
STEPS = (0.02, 0.06, 0.12, 0.2)
DICTIONARY = 110 * 1024
_HOW = dict(compression_level=3, window_log=17)


def _dictionary(texts: list[bytes]) -> bytes:
    parts = [t[i : i + C.SAMPLE_WIDTH] for t in texts for i in range(0, len(t), C.SAMPLE_WIDTH)]
    size = min(DICTIONARY, sum(map(len, parts)) // 8)
    try:
        return zstandard.train_dictionary(size, parts, k=64, d=8, steps=4, split_point=1.0, threads=1).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the text itself is the dictionary
        return b"".join(parts)[-DICTIONARY:]


def train(bad: list[bytes], good: list[bytes]) -> tuple[bytes, bytes]:
    return _dictionary(bad), _dictionary(good)


def size_differences(bad: bytes, good: bytes):
    """A function of (bytes, offsets): the NAMES features of each text."""

    def of_texts(data: bytes, offsets: np.ndarray) -> np.ndarray:
        with_bad, with_good = C.compressor(bad, **_HOW), C.compressor(good, **_HOW)
        out = np.zeros((len(offsets) - 1, len(NAMES)))
        for first, last in runs(offsets):
            out[first:last] = _differences(data, offsets[first : last + 1], with_bad, with_good)
        return out

    return of_texts


def _differences(data: bytes, offsets: np.ndarray, with_bad: zstandard.ZstdCompressor, with_good: zstandard.ZstdCompressor) -> np.ndarray:
    n = len(offsets) - 1
    start, length, owner = windows(offsets, WIDTH, WIDTH)
    b, g = (C.lengths(x, data, start, length) for x in (with_bad, with_good))
    each = (b - g) / np.maximum(b + g, 1)
    count = np.maximum(np.bincount(owner, minlength=n), 1)
    summed, plain = _normalised(b, g, owner, n)
    mean = np.bincount(owner, each, n) / count
    lowest, highest = np.zeros(n), np.zeros(n)
    np.minimum.at(lowest, owner, each)
    np.maximum.at(highest, owner, each)
    shares = [np.bincount(owner, each < -k, n) / count for k in STEPS] + [np.bincount(owner, each > k, n) / count for k in STEPS]
    start, length, owner = windows(offsets, BLOCK, BLOCK)
    b, g = (C.lengths(x, data, start, length) for x in (with_bad, with_good))
    blocks, whole = _normalised(b, g, owner, n)
    itself = np.log1p(whole) - np.log1p(plain)
    return np.column_stack([summed, mean, lowest, highest, *shares, blocks, itself])


def _normalised(bad: np.ndarray, good: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(normalised difference of the sums of each text, its sum under the good dictionary)."""
    b, g = np.bincount(owner, bad, n), np.bincount(owner, good, n)
    return (b - g) / np.maximum(b + g, 1), g


NAMES = ["nv_sum", "nv_mean", "nv_low", "nv_high", *[f"nv_bad{k}" for k in range(len(STEPS))], *[f"nv_good{k}" for k in range(len(STEPS))], "nv_blocks", "nv_itself"]


def score_quality(docs: DataFrame, labels: DataFrame, train_on: Column, keep: list[str], score: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and ``score``; ``train_on`` says which label rows may be learned from."""
    sample = C.labelled(docs, labels, "quality", train_on, PER_CLASS)
    fitted = C.cross_fit(sample, train, size_differences, NAMES)
    if fitted is None:
        known = {r["label"] for r in sample.where("text != ''").select("label").distinct().collect()}  # at most two
        return docs.select(*keep, F.lit(float(known.pop()) if known else 0.5).alias(score))
    of_texts, seen, label = fitted
    weights = C.fit_logistic(seen, label, ridge=0.1)
    weights[-1] += C.prior_shift(labels, "quality", train_on, label)
    return C.features(docs, of_texts, NAMES, keep).select(*keep, C.logistic(weights, [F.col(n) for n in NAMES]).alias(score))


def keep_good(docs: DataFrame, labels: DataFrame, train_on: Column) -> DataFrame:
    """``docs`` without the documents whose predicted label is 0, columns unchanged."""
    (score,) = fresh(docs, "nv_score")
    return score_quality(docs, labels, train_on, docs.columns, score).where(F.col(score) >= THRESHOLD).select(*docs.columns)
