import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np

from navspark.llm import minhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def labelled(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    seen, out = Counter(), []
    for k in range(max(len(words) - 4, 1) if words else 0):
        s = tuple(words[k : k + 5])
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def similarity(a, b):
    at = {s: k for k, s in enumerate(b)}
    tails = []
    for x in (at[s] for s in a if s in at):
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails) / (len(a) + len(b) - len(tails)) if a or b else 0.0


def classes(rows):
    shingles = [labelled(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for i, own in enumerate(shingles):
        near = {j for s in own for j in at[s]}
        for j in near:
            if similarity(own, shingles[j]) >= 0.8 - 1e-12:
                parent[find(i)] = find(j)
        for s in own:
            at[s].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values())


def got(df):
    rows = minhash.near_duplicates(df).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.class_id, r.class_size].append(r)
    assert sum(r.first for r in rows) == len({(r.class_id, r.th) if r.class_size == 1 else r.class_id for r in rows})
    return rows


def test_tables_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = defaultdict(list)
    for r in got(documents):
        found[r.class_id].append(str(r.doc_id))
    assert sorted(sorted(g) for g in found.values()) == classes(rows)


def test_one_large_group_and_chains(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocabulary) for _ in range(300)]
    rows = []
    for i in range(60):  # near copies of one text, three words changed each
        words = list(base)
        for _ in range(3):
            words[rnd.randrange(300)] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words)))
    words = list(base)
    for i in range(25):  # a chain: each text is close to the one before
        for _ in range(4):
            words[rnd.randrange(300)] = rnd.choice(vocabulary)
        rows.append((1000 + i, " ".join(words)))
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    rows += [(2000 + i, passage + " " + " ".join(rnd.choice(vocabulary) for _ in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = defaultdict(list)
    for r in got(df):
        found[r.class_id].append(str(r.doc_id))
    assert sorted(sorted(g) for g in found.values()) == classes(rows)


def test_odd_rows(spark, odd, nothing):
    rows = minhash.near_duplicates(odd).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[1] == by[2] == {1}
    assert by[3] == {3} and by[4] == {4} and by[6] == {6} and by[9] == {9}
    assert len(rows) == odd.count()
    left = minhash.drop_near_copies(odd)
    assert left.columns == odd.columns and left.count() == odd.count() - 2
    assert minhash.near_duplicates(nothing).count() == 0 and minhash.drop_near_copies(nothing).count() == 0


def test_similarity_is_the_aligned_share():
    a = np.arange(1, 101, dtype=np.uint64)
    assert minhash.similarity(a, a) == 1.0
    b = np.concatenate([a[:50], a[60:]])
    assert abs(minhash.similarity(a, b) - 0.9) < 1e-9
    assert minhash.similarity(a, np.concatenate([a[50:], a[:50]]), 0.3) < 0.8


def test_pairs_among_many_dissimilar_variants(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 24)
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rnd.choice(vocabulary) for _ in range(300)]

    def changed(words, places):
        words = list(words)
        for k in places:
            words[k] = rnd.choice(vocabulary)
        return words

    # Variants of one text at about 0.71, which share buckets; some have one near copy at about 0.84.
    texts = [changed(base, rnd.sample(range(300), 5)) for _ in range(120)]
    texts += [changed(texts[k], [15, 75, 145, 215, 285]) for k in range(0, 120, 6)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = defaultdict(list)
    for r in got(df):
        found[r.class_id].append(str(r.doc_id))
    expected = classes(rows)
    assert sum(len(g) > 1 for g in expected) >= 10
    assert sorted(sorted(g) for g in found.values()) == expected


def test_buckets_of_texts_beyond_a_million_shingles():
    rnd = np.random.RandomState(5)
    a = rnd.randint(1, 1 << 62, (1 << 20) + 300_000, dtype=np.int64).astype(np.uint64)
    b = np.concatenate([a[:400_000], rnd.randint(1, 1 << 62, 2000, dtype=np.int64).astype(np.uint64), a[400_000:]])
    one, two = (minhash.sketch(x, np.array([0, len(x)])) for x in (a, b))
    assert (one == two).mean() > 0.9
    short = a[: 1 << 19]  # the same buckets whether it stands alone or behind a long text
    both = minhash.sketch(np.concatenate([a, short]), np.array([0, len(a), len(a) + len(short)]))
    assert (both[0] == one[0]).all() and (both[1] == minhash.sketch(short, np.array([0, len(short)]))[0]).all()


def test_texts_that_sums_of_powers_confuse(spark):
    """Words, or the letters of a word, in Thue-Morse order and its complement."""
    turn = [bin(i).count("1") % 2 for i in range(2048)]
    by_word = [" ".join(("alpha", "beta")[t ^ k] for t in turn) for k in (0, 1)]
    by_letter = [f"{''.join('ab'[t ^ k] for t in turn)} one two three four" for k in (0, 1)]
    rows = list(enumerate([*by_word, *by_letter, by_word[0].upper(), f"({by_letter[1]})"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = defaultdict(list)
    for r in got(df):
        found[r.class_id].append(str(r.doc_id))
    assert sorted(sorted(g) for g in found.values()) == classes(rows)
    assert minhash.drop_near_copies(df).count() == 4
