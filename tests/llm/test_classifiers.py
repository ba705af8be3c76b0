"""Held-out accuracy of the two compression classifiers and of language identification, and odd input."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from navspark.llm import compression, language_id, quality, toxicity
from navspark.llm.common import fold
from navspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def scored(spark, name, label, sf=SF):
    rows = QUERIES[name](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "predicted", label)
    return [(r.score, r.predicted, r[label]) for r in rows.collect()]


def test_quality_held_out(spark):
    rows = scored(spark, "op4_quality_classifier", "quality")
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in rows)
    good, bad = [p for _, p, y in rows if y == 1], [p for _, p, y in rows if y == 0]
    assert sum(good) / len(good) > 0.98 and 1 - sum(bad) / len(bad) > 0.95


def test_toxicity_held_out(spark):
    rows = scored(spark, "op6_toxicity", "toxic")
    toxic, ordinary = [p for _, p, y in rows if y == 1], [p for _, p, y in rows if y == 0]
    assert sum(toxic) / len(toxic) > 0.8 and sum(ordinary) / len(ordinary) < 0.05


def _plain_lengths(dictionary, how, text, width, stride):
    count = 0 if not text else 1 if len(text) <= width else -(-(len(text) - width) // stride) + 1
    return [len(compression.compressor(dictionary, **how).compress(text[k * stride : k * stride + width])) for k in range(count)]


def _learned(documents, labels, value):
    known = {r.doc_id: r[value] for r in labels.collect()}
    texts = [(known[r.doc_id], r.text.encode()) for r in documents.orderBy("doc_id").collect() if r.doc_id in known and r.text]
    return [[t for k, t in texts if k == label] for label in (0, 1)], [t for _, t in texts[:12]] + [b"", b"x", b"the same words again, " * 3000]


def test_quality_features_equal_plain_ones(documents, labels):
    (bad, good), texts = _learned(documents, labels, "quality")
    pair = quality.train(bad, good)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    got = quality.size_differences(*pair)(b"".join(texts), offsets)
    for row, text in zip(got, texts, strict=True):
        (b, g), (bb, gg) = ([_plain_lengths(d, quality._HOW, text, w, w) for d in pair] for w in (quality.WIDTH, quality.BLOCK))
        each = [(x - y) / (x + y) for x, y in zip(b, g, strict=True)]
        share = lambda f: sum(map(f, each)) / max(len(each), 1)
        want = [(sum(b) - sum(g)) / max(sum(b) + sum(g), 1), sum(each) / max(len(each), 1), min(each + [0]), max(each + [0])]
        want += [share(lambda x, k=k: x < -k) for k in quality.STEPS] + [share(lambda x, k=k: x > k) for k in quality.STEPS]
        want += [(sum(bb) - sum(gg)) / max(sum(bb) + sum(gg), 1), np.log1p(sum(gg)) - np.log1p(sum(g))]
        assert np.allclose(row, want)


def test_toxicity_features_equal_plain_ones(documents, labels):
    (ordinary, toxic), texts = _learned(documents, labels, "toxic")
    pair = toxicity.train(ordinary, toxic)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    got = toxicity.window_differences(*pair)(b"".join(texts), offsets)
    for row, text in zip(got, texts, strict=True):
        fast, thorough = ([_plain_lengths(d, how, text, toxicity.WIDTH, toxicity.STRIDE) for d in pair] for how in (toxicity._FAST, toxicity._THOROUGH))
        gain = [max(x - y, 0) for x, y, f, g in zip(*thorough, *fast, strict=True) if f != g]
        n = len(fast[0])
        assert np.isclose(row[0], min(max(gain, default=0), 8)) and np.isclose(row[4], np.log1p(n))
        for k, least in ((1, 2), (2, 3), (3, 4)):
            found = sum(x >= least for x in gain)
            assert np.isclose(row[k], np.log1p(found)) and np.isclose(row[k + 4], np.sqrt(found / max(n, 1)))


def test_language_held_out(spark):
    rows = QUERIES["op9_language_id"](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = rows.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / n > 0.98


def test_sample_keeps_its_bound_when_labelled_ids_repeat(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, None), (2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 0)], "doc_id long, quality int")
    sample = compression.labelled(docs, labels, "quality", F.lit(True), 10)
    got = sorted((r.label, r.text or "") for r in sample.collect())
    assert len(got) == 3 and got[0] == (0, "") and got[1] == (0, "c") and got[2][1].startswith("text ")
    assert got == sorted((r.label, r.text or "") for r in compression.labelled(docs.repartition(7), labels, "quality", F.lit(True), 10).collect())


def test_odd_rows(spark, odd, nothing, labels):
    keep = [c for c in odd.columns if c not in ("text", "score")]
    docs = odd.unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 100), allowMissingColumns=True)
    shifted = labels.withColumn("doc_id", F.col("doc_id") + 100).unionByName(
        spark.createDataFrame([(None, 1, 0), (101, None, None), (101, 0, 1), (999_999, 0, 1)], labels.schema)
    )
    for score, more in ((quality.score_quality, labels), (toxicity.score_toxicity, labels)):
        for table in (shifted, more.limit(0)):
            rows = score(docs, table, F.lit(True), keep).collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert score(nothing, shifted, F.lit(True), keep).count() == 0
    left = quality.keep_good(docs, shifted, F.lit(True))
    assert left.columns == docs.columns


def test_language_of_odd_rows(spark, odd, nothing):
    learn = spark.createDataFrame([(100 + i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)] * 3)], "doc_id long, text string, lang string")
    docs = odd.select("doc_id", "text").withColumn("lang", F.lit(None).cast("string")).unionByName(learn)
    rows = {r.doc_id: r for r in language_id.identify(docs, F.lit(True), ["doc_id"]).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == rows[6].lang_pred == "und" and rows[6].score == 0
    assert rows[1].lang_pred == "en" and rows[101].lang_pred == "de" and rows[7].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in rows.values())
    untaught = odd.select("doc_id", "text").withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(untaught, F.lit(True), ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(untaught.limit(0), fold(F.col("doc_id"), 4) != 2, ["doc_id"]).count() == 0


def test_models_are_distributions():
    """Over all characters that occur, the Kneser-Ney probabilities after any context sum to less than one, and nearly to one."""
    import numpy as np

    texts = ["abracadabra", "abrakadabra barbara", "cab"]
    code, offsets = language_id._codes(texts)
    grams = language_id._grams(code, 4)
    ends = np.arange(3, len(code))
    lead = np.zeros(len(code), bool)
    for k in range(3):
        lead[offsets[:-1] + k] = True
    g, n = np.unique(grams[~lead[ends]], return_counts=True)
    models = language_id.build(["xx"], np.zeros(len(g), int), g, n)
    letters = sorted(set("".join(texts)))
    for context in ("abr", "zzz", "cab"):
        total = sum(np.exp(models.log_probability(language_id._codes(["x"])[0][:0].__class__(0) if False else np.array([ord(c) for c in context + x], np.uint64)))[0, 0] for x in letters)
        assert 0.85 < total <= 1.0001


def plain_kneser_ney(texts):
    """Interpolated Kneser-Ney over dictionaries: a function of (context of three characters, character)."""
    counts = {4: Counter(), 3: Counter(), 2: Counter(), 1: Counter()}
    for t in texts:
        padded = "\x02" * 3 + t
        counts[4].update(padded[i : i + 4] for i in range(len(padded) - 3))
    for k in (3, 2, 1):
        counts[k].update(g[1:] for g in counts[k + 1])
    sizes = {k: Counter() for k in counts}
    types = {k: Counter() for k in counts}
    for k, grams in counts.items():
        for g, n in grams.items():
            sizes[k][g[:-1]] += n
            types[k][g[:-1]] += 1
    discount = {}
    for k, grams in counts.items():
        one, two = (sum(n == x for n in grams.values()) for x in (1, 2))
        discount[k] = min(max(one / max(one + 2 * two, 1), 0.1), 0.9)

    def probability(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        context = gram[:-1]
        if not sizes[k][context]:
            return probability(gram[1:])
        own = max(counts[k][gram] - discount[k], 0) if counts[k][gram] else 0
        return (own + discount[k] * types[k][context] * probability(gram[1:])) / sizes[k][context]

    return probability


def test_models_equal_plain_kneser_ney():
    texts = ["abracadabra", "abrakadabra barbara", "cab", "a bar, a cab"]
    code, offsets = language_id._codes(texts)
    lead = np.zeros(len(code), bool)
    for k in range(3):
        lead[offsets[:-1] + k] = True
    grams, n = np.unique(language_id._grams(code, 4)[~lead[3:]], return_counts=True)
    models = language_id.build(["xx"], np.zeros(len(grams), int), grams, n)
    plain = plain_kneser_ney(texts)
    for text in [*texts, "barbarabara", "kcar dab", "bbbbkk,"]:
        padded = "\x02" * 3 + text
        want = -sum(np.log(plain(padded[i : i + 4])) for i in range(len(text))) / len(text)
        assert abs(models.cross_entropy([text])[0, 0] - want) < 1e-3


def test_models_as_tables_give_the_same(spark, documents, odd, monkeypatch):
    """More grams than MAX_GRAMS: the models stay Spark tables, looked up by joins."""
    docs = documents.select("doc_id", "text", "lang").unionByName(odd.select(F.col("doc_id") - 1000, "text", F.lit(None).cast("string").alias("lang")).toDF("doc_id", "text", "lang"))
    train = fold(F.coalesce(F.col("doc_id"), F.lit(0)), 4) != 2

    def judged():
        rows = language_id.identify(docs, train, ["doc_id", "text"]).collect()
        return sorted(((r.doc_id is None, r.doc_id or 0, r.text or "", r.lang_pred, r.rejected), r.score) for r in rows)

    want = judged()
    monkeypatch.setattr(language_id, "MAX_GRAMS", 0)
    got = judged()
    assert [k for k, _ in got] == [k for k, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)


def test_rejection_limits_come_from_unseen_texts(spark):
    words = [f"{a}{b}{c}" for a in "abcdef" for b in "aeiou" for c in "lmnr"]
    rnd = np.random.RandomState(3)
    texts = [" ".join(rnd.choice(words, 40)) for _ in range(3000)]
    strange = ["zyx wvq jjj kkk " * 10, "0x7f!! ??? qqq ###" * 9]
    rows = [(i, t, "aa") for i, t in enumerate(texts)] + [(10_000 + i, t, None) for i, t in enumerate(strange)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.rejected for r in language_id.identify(df, F.lit(True), ["doc_id"]).collect()}
    assert found[10_000] and found[10_001]
    assert sum(found[i] for i in range(3000)) <= 0.01 * 3000
