import random
from collections import Counter

from navspark.llm import substrings as S


def want(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        hit = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                hit[p : p + length] = b"\1" * length
        spans = sum(hit[k] and not (k and hit[k - 1]) for k in range(len(t)))
        out.append((str(i), len(t), spans, bytes(b for b, h in zip(t, hit, strict=True) if not h)))
    return sorted(out)


def got(df, length=S.LENGTH):
    return sorted((str(r.doc_id), r.n_bytes, len(r.removed), bytes(r.kept)) for r in S.remove_repeats(df, length).collect())


def test_tables_equal_brute_force(documents):
    assert got(documents) == want([(r.doc_id, r.text) for r in documents.collect()], 200)


def test_shared_passages_periods_and_borders(spark):
    rnd = random.Random(1)
    passage = "".join(rnd.choice("abcdef ") for _ in range(500))
    rows = []
    for i in range(60):
        a, b = sorted((rnd.randrange(501), rnd.randrange(501)))
        rows.append((i, "".join(rnd.choice("uvwxyz é") for _ in range(rnd.randrange(300))) + passage[a:b] + "".join(rnd.choice("uvwxyz") for _ in range(rnd.randrange(300)))))
    rows += [(100, "k" * 199), (101, "k" * 200), (102, "m" * 201), (103, "ab" * 400), (104, "ab" * 130), (105, passage[:200]), (106, passage[:200]), (107, passage[300:499])]
    rows += [(108, "é" * 90 + "q"), (109, "é" * 300), (110, "xyz" * 70 + passage + "xyz" * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == want(rows, 200)


def test_without_bloom_filter(spark, documents, monkeypatch):
    monkeypatch.setattr(S, "MAX_WORDS", 0)
    some = documents.limit(60)
    assert got(some) == want([(r.doc_id, r.text) for r in some.collect()], 200)


def test_odd_rows(odd, nothing):
    some = odd.where("doc_id is null or doc_id != 7")
    assert got(some) == want([(r.doc_id, r.text) for r in some.collect()], 200)
    assert len(got(odd)) == odd.count() and got(nothing) == []


def test_repeats_far_inside_a_long_text(spark):
    rnd = random.Random(7)
    noise = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=4_700_000))
    once, twice, border = ("".join(rnd.choices("ABCDEFGH", k=300)) for _ in range(3))
    at = 2 * S._SEGMENT - 150  # over the border of two segments
    long = noise[:at] + border + noise[at:4_300_000] + once + noise[4_300_000:4_500_000] + twice + noise[4_500_000:4_600_000] + twice + noise[4_600_000:]
    rows = [(1, long), (2, "x" + once + "y"), (3, "z" + border + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == [("1", len(long), 4, noise.encode()), ("2", 302, 1, b"xy"), ("3", 302, 1, b"z!")]
