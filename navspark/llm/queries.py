"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navspark.llm import chat, decontamination, exact_dedup, language_id, minhash, packing, periodic, quality, secrets, substrings, toxicity, urls, whitening
from navspark.llm.common import fold, table

TOKENIZER = "byte_bpe_50k.json"
#: The list that op1 judges by: action, host, path prefix.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("block", "example.net", "/de/8"),
    ("allow", "net", "/de/"),
    ("block", "org", "/es/"),
]
#: Of the listed URLs of op1, some are those of the pages on such hosts.
LISTED_HOST = r"(^|\.)adult-"


def _listed_urls(pages: DataFrame) -> DataFrame:
    """URLs on listed hosts, and of mirrors: pages whose article a page with a smaller page_id has too."""
    article = F.regexp_extract("html", r"(?s)<article>(.*)</article>", 1)
    rows = pages.select("page_id", "url", F.when(article != "", F.sha2(article, 256)).alias("article"))
    firsts = rows.where("article IS NOT NULL").groupBy("article").agg(F.min("page_id").alias("page_id"))
    mirrors = rows.where("article IS NOT NULL").join(firsts.select("page_id"), "page_id", "left_anti").select("url")
    return pages.where(urls.url_host(F.col("url")).rlike(LISTED_HOST)).select("url").union(mirrors)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the contract; beyond them, pages are blocked whose URL is any form of a listed one."""
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    pages = table(spark, sf_dir, "pages")
    return urls.judge_urls(pages.select("page_id", "url"), rules, listed=_listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", F.col("first").alias("kept"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0, ["doc_id"]
    )
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontamination.window_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.covered(F.col("spans"))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2, ["doc_id"]
    )
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "n_added")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    n_kept = F.octet_length("kept").cast("long")
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - n_kept).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = language_id.identify(docs, fold(F.col("doc_id"), 4) != 2, ["doc_id"])
    return judged.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


#: A record of op11 holds turns of so many bytes, each counted as TURN_BYTES more; one longer turn at least.
RECORD_BYTES, TURN_BYTES = 4 << 20, 64 << 10


def _chat_records(rows: DataFrame) -> DataFrame:
    """(conv_id, part, record): conversations as JSON records of the layouts that their turns fit, the layout chosen by the id.

    A long conversation gives several records, so that none is unbounded.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.octet_length("text") + TURN_BYTES).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumns({"place": F.row_number().over(order), "part": F.floor(before / RECORD_BYTES)})
    listed = F.sort_array(F.collect_list(F.struct("place", "role", "text")))  # bounded by RECORD_BYTES and one turn
    parts = placed.groupBy("conv_id", "part").agg(listed.alias("turns"))
    roles, kind = F.transform("turns", lambda t: t["role"]), F.pmod(F.xxhash64("conv_id"), F.lit(4))
    text = lambda i: F.get("turns", F.lit(i))["text"]
    pair, triple = (roles == F.array(*map(F.lit, names)) for names in (("user", "assistant"), ("system", "user", "assistant")))
    plain = F.forall("turns", lambda t: t["role"].isin("system", "user", "assistant"))
    speaker = lambda t: F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"])
    items = lambda role, value, name: F.transform("turns", lambda t: F.struct(name(t).alias(role), t["text"].alias(value)))
    same = lambda t: t["role"]
    record = (
        F.when(pair & (kind < 2), F.to_json(F.struct(text(0).alias("instruction"), F.lit("").alias("input"), text(1).alias("output"))))
        .when(pair & (kind == 2), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"), F.col("conv_id").alias("id"))))
        .when(triple & (kind == 2), F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("completion"))))
        .when(plain & (kind == 1), F.to_json(F.struct(items("from", "value", speaker).alias("conversations"))))
        .when(plain & (kind == 3), F.to_json(F.struct(F.struct(items("speaker", "utterance", same).alias("dialogue")).alias("data"))))
        .otherwise(F.to_json(F.struct(items("role", "content", same).alias("messages"))))
    )
    return parts.select("conv_id", "part", record.alias("record"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its parts, which come one after the other; no more than a batch of them is held."""
    names, open_id = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"], (False, None)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in itertools.chain(batches, [None]):
        done = []
        rows = [(False, *[None] * 6)] if batch is None else [(True, *r.values()) for r in batch.to_pylist()]
        for there, conv_id, n, text, loss_text, chars, loss_chars in rows:
            if open_id != (there, conv_id):
                if open_id[0]:
                    done.append((open_id[1], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                open_id, turns, loss, counts = (there, conv_id), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            if there:
                turns.update(text.encode())
                loss.update(loss_text.encode())
                counts = [a + b for a, b in zip(counts, (n, loss_chars, chars), strict=True)]
        columns = zip(*done, strict=True) if done else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records of several layouts, formatted; digests of what the formatted text and its mask give back."""
    own = spark.createDataFrame([(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    made = chat.format_records(_chat_records(rows.fillna("", ["role", "text"]))).select("conv_id", "part", "formatted", "loss_spans")
    read = made.select("conv_id", "part", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    back = read.select(
        "conv_id",
        "part",
        F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns_text"),
        F.array_join("loss", "").alias("loss_text"),
        F.length("formatted").cast("long").alias("chars"),
        F.length(F.array_join("loss", "")).cast("long").alias("loss_chars"),
    )
    digest = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = back.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "n", "turns_text", "loss_text", "chars", "loss_chars").mapInArrow(_digests, digest)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, of which one in ten ends in words that repeat, as the contract of op13 puts it."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    placed = words.withColumns({"a": F.when(n > 0, (g % n).cast("int")), "p": (F.lit(3) + g % 8).cast("int")})
    placed = placed.withColumn("p", F.floor((n - F.col("a")) / F.col("p")).cast("int") + 1)
    tail = F.transform(F.sequence("a", n - 1), lambda i: F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_order_minhash": op3_order_minhash,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scan": op7_secret_scan,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_language_id": op9_language_id,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_chat_format": op11_chat_format,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

_HOST = r"translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '')"
_BARE = r"regexp_replace(regexp_replace(host, '^.*@|(:(80|443))?$', '', 'g'), '\.+$|^www\.', '', 'g')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL = {
    "op1_url_filter": rf"""
        WITH p AS (SELECT row_number() OVER () AS rid, page_id, url, {_HOST} AS host, {_PATH} AS path,
                     nullif(regexp_extract(html, '<article>([\s\S]*)</article>', 1), '') AS article FROM pages),
        firsts AS (SELECT min(page_id) AS page_id FROM p WHERE article IS NOT NULL GROUP BY article),
        q AS (SELECT rid, list_sort(list_filter(string_split(regexp_extract(url, '^[\s\S]*?://[^?#]*\?([^#]*)', 1), '&'),
                     lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_\w*|ref)(=|$)'))) AS params FROM p WHERE contains(url, '://')),
        c AS (SELECT rid, host, {_BARE} || regexp_replace(url_decode(replace(path, '+', '%2B')), '/+$', '')
                     || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical FROM p JOIN q USING (rid)),
        listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|\.)adult-')
            OR rid IN (SELECT rid FROM p WHERE article IS NOT NULL AND NOT EXISTS (SELECT 1 FROM firsts WHERE firsts.page_id = p.page_id))),
        r(action, host, path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'),
            ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
        fit AS (
            SELECT p.rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                   arg_max(r.action, length(r.host || r.path)) AS verdict
            FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            GROUP BY p.rid)
        SELECT page_id, p.host, path, rule, coalesce(verdict, CASE WHEN listed.canonical IS NOT NULL THEN 'block' END, 'allow') AS verdict
        FROM p LEFT JOIN fit USING (rid) LEFT JOIN c USING (rid) LEFT JOIN listed USING (canonical)""",
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents),
        w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w""",
    "op5_decontamination": rf"""
        WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        d AS (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS ws FROM low),
        bl AS (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
        b AS (SELECT item_id, regexp_extract_all(t, '{_WORD}') AS ws FROM bl),
        bw AS (SELECT DISTINCT item_id, array_to_string(ws[i:least(i + 9, len(ws))], ' ') AS w, least(len(ws), 10) AS m
               FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
        lens AS (SELECT DISTINCT m FROM bw),
        dw AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS w
               FROM (SELECT d.doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, lens WHERE len(ws) >= m)),
        hit AS (SELECT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw USING (m, w)),
        items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id),
        cov AS (SELECT doc_id, count(DISTINCT j) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id)
        SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN items USING (doc_id) LEFT JOIN cov USING (doc_id)""",
}
