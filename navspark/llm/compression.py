"""What the two compression classifiers share: samples, window lengths, calibration.

A classifier is fitted on a bounded sample of labelled rows: so many rows of
each class, and of a row of over 16 KB so many windows for the dictionaries. The
sample is cross-fitted: each half is scored, over its whole texts, with
dictionaries built from the other half, and these scores calibrate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.arrow_text import begin_task, give_back, text_bytes
from navspark.llm.common import bounded_labels

#: A sampled text gives the dictionaries at most so many windows, evenly spaced over all of it.
SAMPLE_WINDOWS, SAMPLE_WIDTH = 64, 256


def compressor(dictionary: bytes, **how: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(write_content_size=0, write_checksum=0, write_dict_id=0, **how)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=loaded, compression_params=params)


def lengths(with_dictionary: zstandard.ZstdCompressor, data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Compressed size of each window of ``data``."""
    if not len(start):
        return np.zeros(0, np.int64)
    pairs = np.empty((len(start), 2), np.uint64)
    pairs[:, 0], pairs[:, 1] = start, length
    packed = with_dictionary.multi_compress_to_buffer(zstandard.BufferWithSegments(data, pairs.tobytes()), threads=1)
    return np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed))


def sample_text(text: bytes) -> bytes:
    """All of a short text; of a long one, evenly spaced windows."""
    if len(text) <= SAMPLE_WINDOWS * SAMPLE_WIDTH:
        return text
    at = np.linspace(0, len(text) - SAMPLE_WIDTH, SAMPLE_WINDOWS).astype(int)
    return b"\n".join(text[i : i + SAMPLE_WIDTH] for i in at)


def labelled(docs: DataFrame, labels: DataFrame, value: str, keep: Column, per_class: int) -> DataFrame:
    """(text, label, half) of the bounded sample; each half calibrates what the other one builds.

    Of the texts that an id occurs with, one is learned from, so the sample
    keeps its bound however often a labelled id repeats.
    """
    sample = bounded_labels(labels, value, keep, per_class).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)))
    few = F.broadcast(sample.withColumnRenamed("doc_id", "nv_label_id"))  # at most 2 * per_class rows
    texts = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("nv_label_id"))
    return texts.groupBy("nv_label_id", "label", "half").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "label", "half")


def dictionary_texts(sample: DataFrame) -> list[tuple[bytes, int, int]]:
    """Distinct (text, label, half) of the sample that are not empty, in a fixed order."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            raw = data.tobytes()
            texts = [sample_text(raw[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), b.column("label"), b.column("half")], ["text", "label", "half"])

    rows = sample.select("text", "label", "half").mapInArrow(short, "text binary, label int, half long").collect()
    return sorted({(bytes(r["text"]), r["label"], r["half"]) for r in rows if r["text"]})


def cross_fit(
    sample: DataFrame,
    train: Callable[[list[bytes], list[bytes]], tuple[bytes, bytes]],
    measure: Callable[[bytes, bytes], Callable[[bytes, np.ndarray], np.ndarray]],
    names: list[str],
) -> tuple[Callable[[bytes, np.ndarray], np.ndarray], np.ndarray, np.ndarray] | None:
    """(what measures a text, its measures of the sample, their labels); None if a class has no text.

    ``train`` makes two dictionaries of the texts of label 0 and of label 1, and
    ``measure`` a function of texts from these. Each half of the sample is measured
    by dictionaries built from the other half, so that the measures are those of
    unseen texts; the result measures by dictionaries of the whole sample. Where a
    half lacks a class, the whole sample stands for it.
    """
    rows = dictionary_texts(sample)
    whole = [[t for t, k, _ in rows if k == label] for label in (0, 1)]
    if not all(whole):
        return None
    of_texts = measure(*train(*whole))
    parts = []
    for half in (0, 1):
        own = [[t for t, k, h in rows if k == label and h == half] for label in (0, 1)]
        by_half = measure(*train(*own)) if all(own) else of_texts
        parts.append(features(sample.where(F.col("half") == 1 - half), by_half, names, ["label"]))
    seen = parts[0].unionByName(parts[1]).toPandas()
    return of_texts, seen[names].to_numpy(), seen["label"].to_numpy(float)


def features(df: DataFrame, of_texts: Callable[[bytes, np.ndarray], np.ndarray], names: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and the double columns ``names``: of_texts(bytes, offsets) gives a row of them for each text."""
    kept = df.select(*dict.fromkeys([*keep, "text"]))
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"`{n}` double" for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            made = of_texts(data.tobytes(), offsets)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(made[:, i]) for i in range(len(names))], keep + names)
            give_back()

    return kept.mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights, the last for the intercept, by Newton steps on scaled columns; balanced only by the sample itself."""
    middle, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    scaled = np.hstack([(x - middle) / scale, np.ones((len(x), 1))])
    w = np.zeros(scaled.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(scaled @ w, -30, 30)))
        step = np.linalg.solve(scaled.T @ (scaled * (p * (1 - p))[:, None]) + penalty, scaled.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w[:-1] /= scale
    w[-1] -= w[:-1] @ middle
    return w


def prior_shift(labels: DataFrame, value: str, train: Column, sampled: np.ndarray) -> float:
    """What to add to the intercept: the sample takes up to as many rows of both classes, the table need not."""
    rows = labels.where(train & F.col(value).isin(0, 1)).groupBy(F.col(value).cast("int").alias("k")).count().collect()
    true = {r["k"]: r["count"] for r in rows}
    ones, n = float(sampled.sum()), len(sampled)
    return float(np.log((true.get(1, 0) + 1) / (true.get(0, 0) + 1)) - np.log((ones + 1) / (n - ones + 1)))


def logistic(weights: np.ndarray, columns: list[Column]) -> Column:
    total = F.lit(float(weights[-1]))
    for w, c in zip(weights[:-1], columns, strict=True):
        total = total + F.lit(float(w)) * c
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))))
