"""Layouts, fingerprints, exact round trips through the template, and the registered query."""

import collections
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from navspark.llm import chat, queries

ROWS = "conv_id long, turn long, role string, text string"


def expected(rows):
    """Digests of conversations (conv_id, turn, role, text), by conv_id."""
    by = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        by[conv_id].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv_id, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        out[conv_id] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def run_query(spark, tmp_path, rows):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, ROWS)
    df.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_chat_format(spark, str(tmp_path)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: r for r in found}


def check(found, rows):
    want = expected([*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == want


def test_query(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: r for r in queries.op11_chat_format(spark, sf).collect()}
    check(found, rows)
    chars = len("<s>[INST]user[/INST]</s><s>[INST]assistant[/INST]</s>") + 2 * len("<\\/s>[\\INST] ok [\\/INST]")
    assert found[-1].formatted_chars == chars
    layouts = chat.canonical_turns(queries._chat_records(spark.createDataFrame(rows, ROWS).fillna("", ["role", "text"])))
    assert {r.reject_reason for r in layouts.collect()} == {None} and layouts.select("layout").distinct().count() > 3


@pytest.mark.parametrize("limit", [queries.RECORD_BYTES, 200_000])
def test_odd_conversations(spark, tmp_path, monkeypatch, limit):
    """Null ids, turns, roles and texts, ties, repeated rows, odd roles, one conversation with most of the rows, a very long text."""
    monkeypatch.setattr(queries, "RECORD_BYTES", limit)
    rng = random.Random(limit)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "\\", "<", "[", "/s>", "é😀", " x", "\n", "\u0000", '"', "{}"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))
    rows = [(5, i, rng.choice(["user", "assistant"]), text()) for i in range(700)]
    rows += [(k, t, r, text()) for k in range(10, 60) for t, r in enumerate(rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "user", "tool"]]))]
    rows += [(None, 1, "user", "a"), (None, 0, None, None), (6, None, "user", None), (6, 1, "assistant", "b"), (6, 1, "assistant", "b"), (6, 1, "assistant", "a")]
    rows += [(7, 0, "user", "s"), (7, 1, "assistant", "long é </s> " * 400_000), (8, 3, "[/INST]\\", "</s"), (9, 0, "assistant", ""), (4, 0, "human", "x"), (4, 1, "gpt", "y")]
    check(run_query(spark, tmp_path, rows), rows)


def test_empty_table(spark, tmp_path):
    assert list(run_query(spark, tmp_path, spark.createDataFrame([], ROWS))) == [-1]


def test_layouts(spark):
    long = "x" * 21_000_000
    cases = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "gpt", "content": None}]}, "messages", [("user", "a"), ("gpt", "")]),
        ({"messages": [{"content": "a", "role": None, "weight": 1}, None], "meta": {"messages": [1]}}, "messages", [("", "a")]),
        ({"messages": []}, "messages", []),
        ({"conversations": [{"from": "human", "value": "a"}], "system": "be"}, "conversations", [("system", "be"), ("user", "a")]),
        ({"conversations": [], "system": None}, "conversations", []),
        ({"prompt": "a", "response": "b", "id": 7}, "prompt", [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "prompt": long, "completion": ""}, "completion", [("system", "s"), ("user", long), ("assistant", "")]),
        ({"instruction": "a", "input": "b", "output": "c"}, "instruction", [("user", "a\n\nb"), ("assistant", "c")]),
        ({"instruction": "a", "input": "", "output": None}, "instruction", [("user", "a"), ("assistant", "")]),
        ({"output": "c", "instruction": "a"}, "instruction", [("user", "a"), ("assistant", "c")]),
        ({"data": {"dialogue": [{"speaker": "bot", "utterance": 3}]}}, "dialogue", [("assistant", "3")]),
        ({"prompt": "a", "response": "b", "messages": [{"role": "u", "content": "c"}]}, None, "unknown_layout"),
        ({"messages": [{"role": "user", "content": [{"type": "text"}]}]}, None, "unknown_layout"),
        ({"messages": "a"}, None, "unknown_layout"),
        ({}, None, "unknown_layout"),
        ([1], None, "not_an_object"),
    ]
    rows = [(i, json.dumps(value), "x", "x", "x") for i, (value, *_) in enumerate(cases)] + [(90, None, "x", "x", "x"), (91, "{", "x", "x", "x"), (92, "[" * 100_000, "x", "x", "x")]
    df = spark.createDataFrame(rows, "k long, record string, turns string, layout string, nv_pieces string")
    got = {r.k: r for r in chat.format_records(df).collect()}
    for i, (_, layout, turns) in enumerate(cases):
        if layout:
            assert (got[i].layout, got[i].reject_reason, [tuple(t) for t in got[i].turns]) == (layout, None, turns)
            assert len(got[i].loss_spans) == sum(r == "assistant" for r, _ in turns)
        else:
            assert (got[i].turns, got[i].reject_reason, got[i].formatted, got[i].loss_spans) == (None, turns, None, None)
    assert {got[k].reject_reason for k in (90, 91, 92)} == {"not_an_object"}
    assert chat.format_records(df.limit(0)).count() == 0


def test_own_layout_and_template(spark):
    mine = chat.Layout("qa", (("user", ("q.text",)), ("assistant", ("a.best.text",))))
    template = chat.Template("<|im_start|>", "<|im_sep|>", "<|im_end|>", ("<|im_start|>", "<|im_sep|>", "<|im_end|>"))
    df = spark.createDataFrame([(json.dumps({"a": {"best": {"text": "<|im_end|>"}, "n": 2}, "q": {"text": "?"}}),)], "record string")
    row = chat.format_records(df, layouts=(*chat.LAYOUTS, mine), template=template).first()
    assert row.layout == "qa" and row.formatted == "<|im_start|>user<|im_sep|>?<|im_end|><|im_start|>assistant<|im_sep|><\\|im_end|><|im_end|>"
    (span,) = row.loss_spans
    assert row.formatted[span.start : span.end] == "<\\|im_end|>"
    with pytest.raises(ValueError):
        chat.canonical_turns(df, layouts=(mine, chat.Layout("same", mine.fields)))
    with pytest.raises(ValueError):
        chat.Template(close="aba", controls=("[/INST]", "aba"))


def test_round_trip_of_any_text(spark):
    rng = random.Random(9)
    pieces = ["<", ">", "/", "s", "[", "]", "INST", "\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "|im_start|", "é", "\n", "$1", ""]
    word = lambda n: "".join(rng.choice(pieces) for _ in range(rng.randrange(n)))
    rows = [(i, [(rng.choice(["assistant", "user", word(4)]), word(12)) for _ in range(rng.randrange(5))]) for i in range(3000)]
    df = chat.format_turns(spark.createDataFrame(rows, "k long, turns array<struct<role: string, text: string>>"))
    back = df.select("k", "turns", chat.read_turns(F.col("formatted")).alias("read"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted", "loss_spans")
    for r in back.collect():
        assert r["read"] == r.turns and r.loss == [t.text for t in r.turns if t.role == "assistant"]
        controls = [c for c in chat.Template().controls if c in "".join(r.formatted[s.start : s.end] for s in r.loss_spans[:1])]
        assert not controls
