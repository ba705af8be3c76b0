"""Whitening against a plain computation over all rows."""

import math

import numpy as np
import pytest

from navspark.llm import whitening
from navspark.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string, w string, nv_x string"


def plain(vectors, counts=True):
    """(x, S, variances, explained) by whole numbers and one covariance of all rows."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    fit = x if counts else [list(v) for v in {tuple(v) for v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    return x, sums, n, values, values / values.sum()


def check(rows, ids, vectors, counts=True):
    x, sums, n, values, explained = plain(vectors, counts)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, []).append(r)
    assert len(rows) == len(ids) * min(8, len(sums)) and {r.n for r in rows} == {n}
    z = np.zeros((len(ids), min(8, len(sums))))
    for i, key in enumerate(ids):
        own = sorted(by[key], key=lambda r: r.component)
        assert {r.deviation for r in own} == {sum((n * c - s) ** 2 for c, s in zip(x[i], sums, strict=True))}
        assert np.allclose([r.explained for r in own], explained[: len(own)], rtol=1e-9)
        z[i] = [r.whitened for r in own[: z.shape[1]]]
    if counts:
        assert np.abs(z.T @ z / n - np.eye(z.shape[1])).max() < 1e-8
        # Projections times their directions: the components are those of x itself.
        centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
        directions = centred.T @ z / n / np.sqrt(values[: z.shape[1]])
        assert np.allclose(np.linalg.norm(directions, axis=0), 1, atol=1e-8)
    assert max(r.identity_error for r in rows) < 1e-8
    return z


def test_query(spark, sf):
    found = op12_embedding_whitening(spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    check(found, [r.vec_id for r in rows], [r.embedding for r in rows])


@pytest.fixture(scope="module")
def repeated(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 12)).astype(np.float32)
    pick = np.append(rng.integers(0, 300, 1500), np.full(900, 7))  # one vector has over a third of the rows
    return pick, base, spark.createDataFrame([(i, base[k].tolist(), *"abcde") for i, k in enumerate(pick.tolist())], SCHEMA).repartition(9)


@pytest.mark.parametrize("entries", [whitening.HOT_ENTRIES, 0])
@pytest.mark.parametrize("counts", [True, False])
def test_repeated_vectors(repeated, counts, entries, monkeypatch):
    monkeypatch.setattr(whitening, "HOT_ENTRIES", entries)
    pick, base, df = repeated
    rows = whitening.whiten(df, counts=counts).collect()
    z = check(rows, list(range(len(pick))), base[pick].tolist(), counts)
    same = {k: {tuple(v) for v in z[pick == k].tolist()} for k in set(pick.tolist())}
    assert all(len(v) == 1 for v in same.values())


def test_odd_rows(spark):
    good = [[0.5, -0.25, 1.0], [0.125, 3.0, -2.0], [0.5, -0.25, 1.0], [2.0, 2.5, 0.0], [-1.0, 0.0, 0.75]]
    bad = [None, [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [1e38, 0.0, 0.0], [1.0, 2.0], []]
    ids = [1, 1, None, 4, 5]
    df = spark.createDataFrame([*((i, v, *"abcde") for i, v in zip(ids, good, strict=True)), *((90, v, *"abcde") for v in bad)], SCHEMA)
    rows = whitening.whiten(df, ["vec_id", "component"]).toDF("vec_id", "label", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    assert len(rows) == 15 and {r.vec_id for r in rows} == {1, None, 4, 5} and {r.label for r in rows} == {"a"} and {r.n for r in rows} == {5}
    x, sums, n, *_ = plain(good)
    wanted = {sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x}
    assert {r.deviation for r in rows} == wanted
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("vec_id = 90 AND size(embedding) = 0")).collect() == []


def test_without_variance(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], *"abcde"), (2, [1.0, 2.0], *"abcde")], SCHEMA)).collect()
    assert len(one) == 4 and all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in one)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], *"abcde") for i in range(6)], SCHEMA)).collect()
    assert len(line) == 18 and all((r.whitened is None) == (r.component > 1) for r in line) and max(r.identity_error for r in line) < 1e-9


def test_deviation_beyond_64_bits(spark):
    rows = whitening.whiten(spark.createDataFrame([(1, [3e15], *"abcde"), (2, [0.0], *"abcde"), (3, [1.5e15], *"abcde")], SCHEMA)).collect()
    x = [math.floor(1024 * float(np.float32(c))) + 100000 for c in (3e15, 0.0, 1.5e15)]
    wanted = {i + 1: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in rows} == {k: v if v < 1 << 63 else None for k, v in wanted.items()}
