"""Runs of periodic words against a brute-force search, and the registered query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from navspark.llm import periodic
from navspark.llm.queries import op13_periodic_runs


def brute(words, least=periodic.LEAST):
    """Every (start, length, period), by comparing the words with themselves at every distance."""
    found = {}
    w = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.zeros(0, np.int64)
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(same))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def text_of(rng):
    letters = "abcd"[: rng.choice([1, 2, 2, 3, 4])]
    kind, size = rng.random(), rng.randrange(130)
    if kind < 0.3:
        words = [rng.choice(letters) for _ in range(size)]
    elif kind < 0.5:  # Fibonacci words have as many runs as can be
        a, b = ["a"], ["a", "b"]
        while len(b) < size:
            a, b = b, b + a
        words = b[rng.randrange(5) : size]
    elif kind < 0.8:  # a period that is nearly periodic itself
        root = [rng.choice(letters) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 5)
        root += root[: rng.randrange(len(root) + 1)]
        words = (root * 20)[rng.randrange(5) : size]
        for _ in range(rng.randrange(3) if words else 0):
            words[rng.randrange(len(words))] = rng.choice(letters)
    else:
        words = ["a"]
        while len(words) < size:
            words = rng.choice([words + words, words + ["b"], words + words[: rng.randrange(len(words)) + 1], words + [rng.choice(letters)]])
    return words[:160]


@pytest.mark.parametrize("least", [periodic.LEAST, 2])
def test_equals_brute_force(least, monkeypatch):
    monkeypatch.setattr(periodic, "LEAST", least)
    rng = random.Random(least)
    for _ in range(150):
        texts = [text_of(rng) for _ in range(20)]
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        data = np.frombuffer(" ".join(w for t in texts for w in t).encode() or b" ", np.uint8)
        start, end, _ = periodic.word_spans(data, np.array([0, len(data)]))
        got = sorted(zip(*(x.tolist() for x in periodic.word_runs(periodic.word_numbers(data, start, end), bounds)), strict=True))
        assert got == sorted((s + int(bounds[i]), n, q) for i, t in enumerate(texts) for s, n, q in brute(t, least))


def test_query_equals_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in op13_periodic_runs(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert set(got) == set(texts)
    planted = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, row = brute(words), got[doc_id]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapse(words, runs).encode()).hexdigest()
    assert planted > 5 and sum(r.n_runs > 0 for r in got.values()) > 5


def test_odd_rows(spark, odd, nothing):
    rows = periodic.periodic_runs(odd, ["doc_id", "score"]).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {"x"}
    by = {r.doc_id: r for r in rows}
    for doc_id in (3, 4, 5):
        assert (by[doc_id].n_words, by[doc_id].runs, by[doc_id].collapsed) == (0, [], "")
    assert by[2].collapsed == "The quick brown fox jumps over the lazy dog near the old river bank"
    long = next(r.text for r in odd.where("doc_id = 7").collect()).split()
    assert by[7].n_words == len(long) and all(long[r.start : r.start + r.length - r.period] == long[r.start + r.period : r.start + r.length] for r in by[7].runs)
    assert periodic.periodic_runs(nothing).collect() == []


def test_long_periodic_texts(spark):
    """Hundreds of thousands of words: one word again and again, and one long passage twice at a distance."""
    rng = random.Random(3)
    passage = [f"w{rng.randrange(50_000)}" for _ in range(150_000)]
    rows = [(1, " ".join(["na"] * 400_000)), (2, " ".join([*passage, *passage, "end"])), (3, "\t".join(["a", "b", "c"] * 100_000 + ["a"]))]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 400_000, 1)] and got[1].collapsed == "na"
    assert (0, 300_000, 150_000) in [tuple(r) for r in got[2].runs] and got[2].collapsed.split() == [*passage, "end"]
    assert [tuple(r) for r in got[3].runs] == [(0, 300_001, 3)] and got[3].collapsed == "a b c"
