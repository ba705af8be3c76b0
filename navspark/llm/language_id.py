"""Language identification by interpolated Kneser-Ney character models.

Spark counts the character 4-grams of all training texts by language. The
distinct 4-grams give one Kneser-Ney model per language with the usual
continuation counts for the lower orders. Each order is one sorted array of
gram hashes with the log probabilities of all languages beside it, so a
character costs one binary search however many languages there are. A text gets
the language with the lowest cross-entropy per character. A text is flagged as
rejected if that cross-entropy is above what all but REJECT of its language's
texts have in a share of the training texts, under models of the other training
texts; the models that judge are those of all.

A gram packs four 16-bit characters into 64 bits (characters beyond the basic
plane are hashed into 16 bits). Up to MAX_GRAMS distinct 4-grams the arrays are
held by each task. Beyond, the same models are Spark tables, as sorted by hash as
a join sorts them: the 4-grams of the documents are looked up order by order, and
their log probabilities are summed by document. Both ways give the same results.

Defined results: null text, or text without a letter, is ``und`` with score 0.
Without training text every document is ``und`` with score 0. Of languages with
equal cross-entropy the first by name is chosen. Repeated rows are each judged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.common import cut, fresh, stored

ORDER = 4
MAX_GRAMS = 8_000_000
#: Beyond MAX_GRAMS: a gram that makes up more than this share of the looked up rows is broadcast; at most 1 / HOT are.
HOT = 1e-4
#: Share of unseen texts of a language that lie beyond the rejection threshold.
REJECT = 0.001
#: One training text in so many is unseen by the models that the thresholds are taken from.
UNSEEN = 20
#: Characters that are worked on together.
RUN_CHARS = 1 << 20
#: Cross-entropies of languages are compared on this scale (nats per character, times SHARPNESS).
SHARPNESS = 20.0

_PAD = "\x02" * (ORDER - 1)
_LETTER = re.compile(r"[^\W\d_]")
_UNKNOWN = 1e-7


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit characters, offsets) of the texts, each led by padding."""
    joined = [_PAD + t.lower() for t in texts]
    code = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(code > 0xFFFF, (code ^ (code >> 11)) & 0xFFFF, code).astype(np.uint64)
    return code, np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)


def _grams(code: np.ndarray, order: int) -> np.ndarray:
    """The gram that ends at each place from ORDER - 1 on."""
    out = np.zeros(max(len(code) - ORDER + 1, 0), np.uint64)
    for i in range(ORDER - order, ORDER):
        out = (out << np.uint64(16)) | code[i : i + len(out)]
    return out


def _text_runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= RUN_CHARS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def gram_counts(train: DataFrame) -> DataFrame:
    """lang, gram, n, n_unseen over all rows of ``train`` (text, lang, unseen): all occurrences, and those in unseen texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, bool], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by: dict[tuple[str, bool], list[str]] = {}
            for text, lang, unseen in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "unseen")), strict=True):
                by.setdefault((lang, unseen), []).append(text)
            for key, texts in by.items():
                for first, last in _text_runs(texts):
                    code, offsets = _codes(texts[first:last])
                    lead = np.zeros(len(code), bool)
                    for i in range(ORDER - 1):
                        lead[offsets[:-1] + i] = True
                    grams, n = np.unique(_grams(code, ORDER)[~lead[ORDER - 1 :]], return_counts=True)
                    if key in total:
                        keys, where = np.unique(np.concatenate([total[key][0], grams]), return_inverse=True)
                        grams, n = keys, np.bincount(where, np.concatenate([total[key][1], n])).astype(np.int64)
                    total[key] = (grams, n)
        for (lang, unseen), (grams, n) in total.items():
            n = n.astype(np.int64)
            columns = [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n), pa.array(n * unseen)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n", "n_unseen"])

    partial = train.select("text", "lang", "unseen").mapInArrow(count, "lang string, gram long, n long, n_unseen long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_unseen").alias("n_unseen"))


def _locate(keys: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted keys, whether it is there)."""
    if not len(keys):
        return np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    return at, keys[at] == grams


@dataclass
class Models:
    """``keys[k]`` and ``logs[k]``: grams of order k + 1 and their log probability in every language.

    ``contexts[k]`` and ``backoff[k]``: contexts of order k + 1 and the log weight
    that their unseen continuations give to the next lower order.
    """

    langs: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]

    def log_probability(self, code: np.ndarray, order: int = ORDER, at: np.ndarray | None = None) -> np.ndarray:
        """For each place from ORDER - 1 on (or only ``at``): a row of log probabilities."""
        grams = _grams(code, order) if at is None else _grams_at(code, order, at)
        where, there = _locate(self.keys[order - 1], grams)
        out = self.logs[order - 1][where] if len(self.keys[order - 1]) else np.zeros((len(grams), len(self.langs)), np.float32)
        missing = np.flatnonzero(~there)
        if len(missing):
            places = missing if at is None else at[missing]
            if order == 1:
                out[missing] = np.log(_UNKNOWN)
            else:
                context = _grams_at(code, order, places) >> np.uint64(16)
                where, there = _locate(self.contexts[order - 2], context)
                weight = np.where(there[:, None], self.backoff[order - 2][where] if len(self.contexts[order - 2]) else 0.0, 0.0)
                out[missing] = self.log_probability(code, order - 1, places) + weight
        return out

    def cross_entropy(self, texts: list[str]) -> np.ndarray:
        """Nats per character of each text in each language; 0 for an empty text."""
        out = np.zeros((len(texts), len(self.langs)))
        for first, last in _text_runs(texts):
            code, offsets = _codes(texts[first:last])
            logs = self.log_probability(code)
            begin = offsets[:-1]  # gram i ends at place i + ORDER - 1, a text's first at its first character
            size = np.diff(offsets) - (ORDER - 1)
            total = np.zeros((len(logs) + 1, len(self.langs)))
            np.cumsum(logs, axis=0, dtype=np.float64, out=total[1:])
            out[first:last] = -(total[begin + size] - total[begin]) / np.maximum(size, 1)[:, None]
        return out


def _grams_at(code: np.ndarray, order: int, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for i in range(ORDER - order, ORDER):
        out = (out << np.uint64(16)) | code[at + i]
    return out


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Models:
    """Kneser-Ney models from the counts of the distinct 4-grams; ``lang`` numbers the languages."""
    mask = np.uint64((1 << 64) - 1)
    order_counts: list[list[tuple[np.ndarray, np.ndarray]]] = []  # by order, then language
    current = []
    for k in range(len(langs)):
        own = np.flatnonzero(lang == k)
        own = own[np.argsort(gram[own])]
        current.append((gram[own], n[own].astype(np.float64)))
    order_counts.append(current)
    for order in range(ORDER - 1, 0, -1):
        mask = np.uint64((1 << (16 * order)) - 1)
        current = []
        for k in range(len(langs)):
            keys, count = np.unique(order_counts[0][k][0] & mask, return_counts=True)
            current.append((keys, count.astype(np.float64)))
        order_counts.insert(0, current)
    keys, logs, contexts, backoff = [], [], [], []
    lower: np.ndarray | None = None
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([g for g, _ in order_counts[order - 1]]))
        probability = np.zeros((len(union), len(langs)))
        ctx = np.unique(union >> np.uint64(16)) if order > 1 else np.zeros(1, np.uint64)
        weight = np.ones((len(ctx), len(langs)))
        for k in range(len(langs)):
            grams, count = order_counts[order - 1][k]
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = np.where(count > 0, min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9), 0.0)
            at = np.searchsorted(ctx, grams >> np.uint64(16)) if order > 1 else np.zeros(len(grams), np.int64)
            total = np.bincount(at, count, len(ctx))
            held = np.bincount(at, discount, len(ctx))
            weight[:, k] = np.where(total > 0, held / np.maximum(total, 1), 1.0)
            probability[np.searchsorted(union, grams), k] = (count - discount) / np.maximum(total[at], 1)
        if order == 1:
            probability += weight[0] / (len(union) + 1)
        else:
            below = np.searchsorted(keys[-1], union & np.uint64((1 << (16 * (order - 1))) - 1))
            probability += weight[np.searchsorted(ctx, union >> np.uint64(16))] * lower[below]
            contexts.append(ctx)
            backoff.append(np.log(np.maximum(weight, _UNKNOWN)).astype(np.float32))
        keys.append(union)
        logs.append(np.log(np.maximum(probability, _UNKNOWN * 1e-3)).astype(np.float32))
        lower = probability
    return Models(langs, keys, logs, contexts, backoff)


@dataclass
class Tables:
    """The models as stored tables. ``own[k]``: lang, gram, p (what a seen gram of order k + 1 has beside its share of the lower order).

    ``backoff[k]``: lang, context, w. ``characters``: how many distinct ones any language has.
    """

    langs: list[str]
    own: list[DataFrame]
    backoff: list[DataFrame]
    characters: int


def _suffix(order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1)) if order < ORDER else F.col("gram")


def _context(order: int) -> Column:
    return F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long")


def build_tables(langs: list[str], counts: DataFrame) -> Tables:
    """What ``build`` makes, of any number of ``counts`` (lang, gram, n)."""
    own, backoff = [], []
    for order in range(ORDER, 0, -1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = counts.groupBy("lang").agg(F.least(F.greatest(ones / F.greatest(ones + 2 * twos, F.lit(1)), F.lit(0.1)), F.lit(0.9)).alias("d"))
        known = counts.withColumn("context", _context(order)).join(F.broadcast(discount), "lang")  # one row a language
        by = known.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("w"))
        by = stored(by)
        own.insert(0, stored(known.join(by, ["lang", "context"]).select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("p"))))
        backoff.insert(0, by.select("lang", "context", "w"))
        if order > 1:
            counts = stored(counts.groupBy("lang", _suffix(order - 1).alias("gram")).agg(F.count("*").alias("n")))
    return Tables(langs, own, backoff, own[0].select("gram").distinct().count())


def _log_table(grams: DataFrame, models: Tables) -> DataFrame:
    """gram and l0, l1, ... (its log probability in each language) for the distinct ``grams`` (gram)."""
    needed = [grams]
    for order in range(ORDER - 1, 0, -1):
        needed.insert(0, needed[0].select(_suffix(order).alias("gram")).distinct())
    below = None
    for order in range(1, ORDER + 1):
        each = needed[order - 1].select("gram", F.explode(F.array(*[F.lit(x) for x in models.langs])).alias("lang"), _context(order).alias("context"))
        each = each.join(models.own[order - 1], ["lang", "gram"], "left").join(models.backoff[order - 1], ["lang", "context"], "left")
        p, w = F.coalesce("p", F.lit(0.0)), F.coalesce("w", F.lit(1.0))
        if below is None:
            seen = models.own[0].select("gram").distinct().withColumn("seen", F.lit(True))
            q = F.when(F.col("seen"), p + w / (models.characters + 1)).otherwise(_UNKNOWN)
            made = each.join(seen, "gram", "left")
        else:
            q = p + w * F.col("q")
            made = each.withColumn("lower", _suffix(order - 1)).join(below.select("lang", F.col("gram").alias("lower"), "q"), ["lang", "lower"])
        below = stored(made.select("lang", "gram", q.alias("q")))
    logs = [F.max(F.when(F.col("lang") == x, F.log(F.greatest("q", F.lit(_UNKNOWN * 1e-3))))).alias(f"l{i}") for i, x in enumerate(models.langs)]
    return stored(below.groupBy("gram").agg(*logs))


def _judge_by_tables(df: DataFrame, models: Tables, keep: list[str]) -> DataFrame:
    own = fresh(df, "nv_row")[0]
    rows = stored(df.select(*dict.fromkeys([*keep, "text"]), F.monotonically_increasing_id().alias(own)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("r").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams, n = np.unique(_grams(_codes([text])[0], ORDER), return_counts=True)
                same = [pa.array(np.full(len(grams), x)) for x in (row, _LETTER.search(text) is not None)]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64)), same[1]], ["r", "gram", "n", "letter"])

    texts = rows.where("text != ''").select(F.col(own).alias("r"), "text")
    found = stored(texts.mapInArrow(count, "r long, gram long, n long, letter boolean"))
    often = stored(found.groupBy("gram").agg(F.count("*").alias("rows")))
    logs = _log_table(often.select("gram"), models)
    hot = often.where(F.col("rows") > HOT * found.count()).select("gram")  # at most 1 / HOT rows
    common = F.broadcast(logs.join(F.broadcast(hot), "gram", "left_semi"))
    rare = found.join(F.broadcast(hot), "gram", "left_anti").join(logs, "gram")
    looked = found.join(common, "gram").unionByName(rare)
    size = F.sum("n")
    h = F.array(*[-F.sum(F.col("n") * F.col(f"l{i}")) / size for i in range(len(models.langs))])
    judged = looked.groupBy("r").agg(h.alias("h"), F.bool_or("letter").alias("letter")).withColumn("least", F.array_min("h"))
    odds = F.aggregate("h", F.lit(0.0), lambda total, x: total + F.exp(-SHARPNESS * (x - F.col("least"))))
    names = F.array(*[F.lit(x) for x in models.langs])
    judged = judged.select(
        F.col("r").alias(own),
        F.when(F.col("letter"), F.element_at(names, F.array_position("h", F.col("least")).cast("int"))).alias("nv_lang"),
        F.when(F.col("letter"), 1 / odds).alias("nv_odds"),
        F.col("least").alias("nv_least"),
    )
    made = [F.coalesce("nv_lang", F.lit("und")).alias("lang_pred"), F.coalesce("nv_odds", F.lit(0.0)).alias("score"), F.coalesce("nv_least", F.lit(0.0)).alias("cross_entropy")]
    return rows.join(judged, own, "left").select(*keep, *made)


def train_models(train: DataFrame) -> tuple[Models | Tables, Models | Tables | None] | None:
    """Models of all rows of ``train`` (text, lang, unseen; no nulls), and those of its rows that are not unseen."""
    counts = cut(gram_counts(train))
    if counts.count() > MAX_GRAMS:
        langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row a language
        seen = counts.select("lang", "gram", (F.col("n") - F.col("n_unseen")).alias("n")).where("n > 0")
        return build_tables(langs, counts.select("lang", "gram", "n")), None if seen.isEmpty() else build_tables(langs, seen)
    table = counts.toPandas()  # at most MAX_GRAMS rows
    if not len(table):
        return None
    langs = sorted(table["lang"].unique())
    number = {x: i for i, x in enumerate(langs)}
    lang, gram = table["lang"].map(number).to_numpy(), table["gram"].to_numpy(np.int64).view(np.uint64)
    n, unseen = table["n"].to_numpy(), table["n_unseen"].to_numpy()
    known = n > unseen
    part = build(langs, lang[known], gram[known], (n - unseen)[known]) if known.any() else None
    return build(langs, lang, gram, n), part


def _judge(df: DataFrame, models: Models | Tables, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang_pred, score and cross_entropy of each row."""
    if isinstance(models, Tables):
        return _judge_by_tables(df, models, keep)
    kept = df.select(*dict.fromkeys([*keep, "text"]))
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", lang_pred string, score double, cross_entropy double"
    names = [*keep, "lang_pred", "score", "cross_entropy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            h = models.cross_entropy(texts)
            best = h.argmin(axis=1)
            odds = np.exp(-SHARPNESS * (h - h.min(axis=1, keepdims=True)))
            score = 1 / odds.sum(axis=1)
            letter = np.array([_LETTER.search(t) is not None for t in texts], bool)
            lang = [models.langs[b] if ok else "und" for b, ok in zip(best, letter, strict=True)]
            made = [pa.array(lang, pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(h.min(axis=1))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names)

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, train: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs``, lang_pred, score and rejected; learned from the rows where ``train`` holds.

    A language without unseen texts rejects nothing.
    """
    known = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("text", "lang", (F.pmod(F.xxhash64("text", F.lit(3)), F.lit(UNSEEN)) == 0).alias("unseen"))
    models = train_models(known)
    if models is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    models, part = models
    most = {}
    if part is not None:
        seen = _judge(known.where("unseen"), part, ["lang"]).where("lang = lang_pred").groupBy("lang_pred")
        limits = seen.agg(F.percentile_approx("cross_entropy", 1 - REJECT, 10_000).alias("most"))
        most = {r["lang_pred"]: r["most"] for r in limits.collect()}  # one row a language
    limit = F.lit(None).cast("double")
    for lang, value in most.items():
        limit = F.when(F.col("lang_pred") == lang, F.lit(float(value))).otherwise(limit)
    judged = _judge(docs, models, keep)
    return judged.select(*keep, "lang_pred", "score", (F.col("lang_pred") == "und") | F.coalesce(F.col("cross_entropy") > limit, F.lit(False))).toDF(
        *keep, "lang_pred", "score", "rejected"
    )
