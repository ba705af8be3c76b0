"""Whitening of embeddings, fitted and applied to each different vector once.

Each entry c of a vector becomes the whole number ``x = floor(1024 c) + 100000``.
Rows with the same x are grouped and counted; the counts (or ones) are the
weights of the fit. The sums S are added up as whole numbers, the covariance in
double precision from entries centred on S / n: each task multiplies its part of
the different vectors as one matrix, and the parts are added in two steps of
grouped sums. The components are the eigenvectors of the covariance, which has
the size of a vector, whatever the number of rows, and is all that reaches the
driver. The different vectors are whitened once and joined back to their rows:
those of more than 1 / HOT_SHARE of the rows (fewer than HOT_SHARE, so they are
broadcast if they are short) where the rows are read, the others by a shuffle.

Defined results: a row is left out if its vector is null, or has a null, NaN or
infinite entry, or one whose x is no 62-bit number; and if its vector has another
length than most of the others have (the longest of the most frequent lengths is
taken), as they have no covariance with each other. Rows that repeat, null ids
and ids that repeat give rows each. ``deviation`` is exact, and null where it is
no 64-bit number. A component without variance (no more than rounding leaves
beside the largest) has a null ``whitened``; ``explained`` is null if there is
no variance at all, and so is ``identity_error``. An empty table gives an empty
one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.common import drop_stored, stored

COMPONENTS = 8
#: A vector that more than one in so many rows has is joined where the rows are read.
HOT_SHARE = 1000
#: Entries of whitened vectors and keys that are broadcast together at most (about 64 MB).
HOT_ENTRIES = 4_000_000
#: The tasks' parts of a sum are added in so many groups first.
GROUPS = 64
_SAFE = 1 << 62


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _exact_sums(w: np.ndarray, x: np.ndarray) -> list[int]:
    """The weighted sum of each column, however large."""
    largest = int(np.abs(x).max(initial=0))
    if largest * max(int(w.sum()), 1) < _SAFE:
        return (w @ x).tolist()
    return (w.astype(object) @ x.astype(object)).tolist()


def _sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """(n, sum of each dimension) of the weighted vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            part = _exact_sums(batch.column("w").to_numpy(), _matrix(batch.column("x")))
            total = part if not total else [a + b for a, b in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array([str(v) for v in total], pa.string())], ["i", "s"])

    n = distinct.agg(F.sum("w")).first()[0]
    parts = distinct.select("x", "w").mapInArrow(run, "i long, s string")
    whole = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()  # as many rows as a vector has entries
    return int(n), [int(r["s"]) for r in whole]


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    """(i, and the other keys; row): sums of rows of matrices."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = functools.reduce(lambda a, b: a + b, (_matrix(b.column("row")).sum(0) for b in batches if len(b)))
        yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], pa.int64()) for k in key), pa.array([total.tolist()], pa.list_(pa.float64()))], [*keys, "row"])

    return parts.groupBy(*keys).applyInArrow(run, ", ".join(f"{k} long" for k in keys) + ", row array<double>")


def _covariance(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the weighted vectors, centred before they are multiplied."""
    mean = np.array([s / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            centred = _matrix(batch.column("x")).astype(np.float64) - mean
            total += (centred * batch.column("w").to_numpy()[:, None]).T @ centred
        group = np.full(len(total), TaskContext.get().partitionId() % GROUPS)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * len(total)), pa.array(total.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(group), rows], ["i", "part", "row"])

    parts = distinct.select("x", "w").mapInArrow(run, "i long, part long, row array<double>")
    whole = _added(_added(parts, "i", "part").select("i", "row"), "i").orderBy("i").collect()  # a square of a vector's length
    return np.array([r["row"] for r in whole]) / n


def _components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, unit vectors as columns) of the first components; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of the squares of n x - S for each vector, exactly; None where it is no 64-bit number."""
    largest = int(np.abs(x).max(initial=0))
    if largest * n < _SAFE and max(map(abs, sums), default=0) < _SAFE:
        off = n * x - np.array(sums, np.int64)
        if int(np.abs(off).max(initial=0)) ** 2 * len(sums) < _SAFE:
            return (off * off).sum(1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    return [v if v < 1 << 63 else None for v in (off * off).sum(1).tolist()]


def _whitened(distinct: DataFrame, n: int, sums: list[int], scaled: np.ndarray) -> DataFrame:
    """x, w, deviation and z (one entry for each column of ``scaled``) of each different vector."""
    mean = np.array([s / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            z = (x - mean) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * scaled.shape[1]), pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("w"), pa.array(_deviations(x, n, sums), pa.int64()), lists], ["x", "w", "deviation", "z"])

    return distinct.select("x", "w").mapInArrow(run, "x array<bigint>, w long, deviation long, z array<double>")


def _identity_error(vectors: DataFrame, n: int, count: int) -> float | None:
    """The largest entry of the whitened vectors' covariance minus the identity; two passes, so that they are centred first."""
    if count == 0:
        return None
    z = [F.col("z")[k] for k in range(count)]
    mean = vectors.agg(*[(F.sum(F.col("w") * c) / n) for c in z]).first()
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    cov = vectors.agg(*[F.sum(F.col("w") * (z[i] - mean[i]) * (z[j] - mean[j])) / n for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(cov, pairs, strict=True))


def whiten(vectors: DataFrame, keep: list[str] | None = None, vector: str = "embedding", components: int = COMPONENTS, counts: bool = True) -> DataFrame:
    """The columns ``keep`` (vec_id), component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    ``counts`` weighs a vector by its number of rows; else each different vector counts once.
    """
    keep = keep or ["vec_id"]
    names = [f"nv_{i}" for i in range(len(keep))]
    scaled = lambda c: c.cast("double") * 1024
    usable = F.forall(vector, lambda c: c.isNotNull() & (F.abs(scaled(c)) < float(_SAFE - (1 << 20))))  # NaN counts as larger than any number
    rows = vectors.where(F.col(vector).isNotNull() & usable).select(
        *[F.col(c).alias(a) for c, a in zip(keep, names, strict=True)], F.transform(vector, lambda c: F.floor(scaled(c)) + F.lit(100000)).alias("x")
    )
    grouped = stored(rows.groupBy("x").agg(F.count("*").alias("w")))
    length = grouped.groupBy(F.size("x").alias("size")).agg(F.sum("w").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    width = length[0]["size"] if length else 0
    if width == 0:
        drop_stored(grouped)
        nothing = ("component int", "n long", "deviation long", "whitened double", "explained double", "identity_error double")
        empty = rows.where(F.lit(False)).select(*names, *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in nothing])
        return empty.toDF(*keep, *[t.split()[0] for t in nothing])
    fitted = grouped.where(F.size("x") == width).select("x", "w" if counts else F.lit(1).cast("long").alias("w"))
    n, sums = _sums(fitted)
    covariance = _covariance(fitted, n, sums)
    variance, directions = _components(covariance, components)
    trace = float(np.trace(covariance))
    real = variance > width * np.finfo(float).eps * max(variance[0], 0.0)  # the others come last, as the variances fall
    made = stored(_whitened(fitted, n, sums, directions[:, real] / np.sqrt(variance[real])))
    error = _identity_error(made, n, int(real.sum()))

    counted = made.join(grouped.select("x", F.col("w").alias("rows")), "x") if not counts else made.withColumn("rows", F.col("w"))
    total = grouped.where(F.size("x") == width).agg(F.sum("w")).first()[0]
    if counts:
        drop_stored(grouped)
    held = stored(counted.where(F.col("rows") * HOT_SHARE > total).select("x", "deviation", "z"))
    several = held.count()  # fewer than HOT_SHARE
    short = several * (width + len(variance)) <= HOT_ENTRIES
    rare = counted.where(F.col("rows") * HOT_SHARE <= total).select("x", "deviation", "z")
    hot = F.broadcast(held) if short else held
    beside = hot.select(F.col("x").alias("nv_x"), F.col("deviation").alias("nv_d"), F.col("z").alias("nv_z"))
    split = rows.join(beside, F.col("x") == F.col("nv_x"), "left")
    common = split.where("nv_x IS NOT NULL").select(*names, F.col("nv_d").alias("deviation"), F.col("nv_z").alias("z"))
    others = split.where("nv_x IS NULL").select(*names, "x").join(rare, "x").select(*names, "deviation", "z")
    joined = others.unionByName(common) if several else others
    shares = [float(v) / trace if trace > 0 else None for v in variance]
    each = F.array(*[F.struct(F.lit(k + 1).alias("component"), F.get("z", F.lit(k)).alias("whitened"), F.lit(s).cast("double").alias("explained")) for k, s in enumerate(shares)])
    out = joined.select(*names, "deviation", F.explode(each).alias("c"))
    return out.select(
        *[F.col(a).alias(c) for c, a in zip(keep, names, strict=True)],
        "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error"),
    )
