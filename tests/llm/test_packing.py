import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from navspark.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "a  b", " a", "a ", "x\u00a0 y", "x \u00a0y", "a\n \nb", "it's  we'll", "\u2003 a \u2003b", "<|endoftext|> a", "a\x85 b", "tab\t x", "日本 語 テ", "e\u0301 f", "\x00 \x01", "a \x1c b", "\x7f a \x7f", "  ", "\n", "1 22 333", "😀 😀"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(documents, reference):
    texts = [r.text for r in documents.collect()] + TRICKY + [a + b for a in TRICKY for b in TRICKY]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    ids, begin = P.encoder(PATH).ids(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = reference.encode_batch(texts, add_special_tokens=False)
    for k, e in enumerate(want):
        assert ids[begin[k] : begin[k + 1]].tolist() == e.ids, texts[k]


def check(rows, docs, reference, capacity):
    by, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= capacity
    expect = defaultdict(list)
    for i, t in docs:
        ids = reference.encode(t or "", add_special_tokens=False).ids + [0]
        count = -(-len(ids) // capacity)
        first = len(ids) - (count - 1) * capacity
        cuts = [0, *(first + capacity * k for k in range(count))]
        expect[i] += [(k, cuts[k], cuts[k + 1] - cuts[k], zlib.crc32(np.array(ids[cuts[k] : cuts[k + 1]], "<u4").tobytes())) for k in range(count)]
    assert {i: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in x) for i, x in by.items()} == {i: sorted(x) for i, x in expect.items()}
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_tables(documents, reference):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    used, least = check(P.pack(documents, PATH).collect(), docs, reference, 2048)
    assert used <= least + 1
    used, least = check(P.pack(documents, PATH, 100).collect(), docs, reference, 100)
    assert used <= 1.01 * least + 1


def test_odd_rows(odd, nothing, reference):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check(P.pack(odd, PATH).collect(), docs, reference, 2048)
    assert P.pack(nothing, PATH).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    rnd = np.random.RandomState(0)
    length = rnd.randint(1, 400, 3000)
    where, offset = P.vector_best_fit(length, 1000, max_documents=5, max_attention=200_000, rule=rule)
    for b in np.unique(where):
        own = length[where == b]
        assert own.sum() <= 1000 and len(own) <= 5 and (own**2).sum() <= 200_000
    plain, _ = P.vector_best_fit(length, 1000)
    assert plain.max() + 1 <= 1.01 * -(-length.sum() // 1000) + 1


def test_ids_beyond_the_cache(monkeypatch, reference):
    monkeypatch.setattr(P, "CACHE", 3)
    texts = ["one two three four five six one two seven", "eight one nine"] + TRICKY
    raw = [t.encode() for t in texts]
    ids, begin = P.Encoder(PATH).ids(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
    assert [ids[begin[k] : begin[k + 1]].tolist() for k in range(len(texts))] == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_equal_hashes_of_different_stretches(monkeypatch):
    texts = ["one two three", "two one", "", "three  three two", "x" * 50 + " one"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(t) for t in raw]))
    enc = P.Encoder(PATH)
    ids, begin = enc.ids(data, offsets)
    monkeypatch.setattr(P, "_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    again, begin2 = P.Encoder(PATH).ids(data, offsets)
    assert (ids == again).all() and (begin == begin2).all()


def test_pack_under_binding_limits(spark, documents):
    """The query's own path, with few documents and little attention allowed in a sequence."""
    few = documents.where(F.length("text") < 900).limit(120)
    packed = P.pack(few, PATH, 512, max_documents=2, max_attention=200_000)
    per = packed.groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("t"), F.sum(F.col("length") ** 2).alias("a")).collect()
    assert all(r.n <= 2 and r.t <= 512 and r.a <= 200_000 for r in per) and any(r.n == 2 for r in per)
