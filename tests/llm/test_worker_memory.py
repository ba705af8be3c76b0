"""A Python worker that is used again does not keep what packing kept in it."""

import public_tokenizers
import pyarrow as pa

from navspark.llm import arrow_text, minhash, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_other_tasks_drop_the_vocabulary(spark, monkeypatch):
    packing.encoder(PATH)
    assert packing.encoder.cache_info().currsize == 1
    arrow_text.begin_task()
    assert packing.encoder.cache_info().currsize == 0
    began = []
    monkeypatch.setattr(minhash, "begin_task", lambda: began.append(1))

    class Docs:
        """Runs what mapInArrow gets, in this process."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return list(run(iter([pa.record_batch({"text": ["a b c", "", None]})])))

    (made,) = minhash._texts(Docs())
    assert made.num_rows == 3 and began == [1]


def test_cache_entries_are_single_numbers(monkeypatch):
    import numpy as np

    texts = [b"one two three two", b"three four <|endoftext|> one", b""]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    made = packing.Encoder(PATH)
    ids, begin = made.ids(data, offsets)
    assert made.known and all(isinstance(v, int) for v in made.known.values())
    monkeypatch.setattr(packing, "CACHE", 2)
    few = packing.Encoder(PATH)
    for _ in range(2):
        again, at = few.ids(data, offsets)
        assert again.tolist() == ids.tolist() and at.tolist() == begin.tolist()
    assert len(few.known) == 2
