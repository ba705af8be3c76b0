import re

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from navspark.llm import quality
from navspark.llm.queries import QUERIES, SQL
from tests.llm.test_decontamination import want as contaminated
from tests.llm.test_minhash import classes


def test_stages_follow_each_other(spark, sf):
    """Each stage against the operator's own query on the same input; decisions take effect."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf)
        if name != names[-1]:
            assert made.columns == docs.columns
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        made.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] > counts[4] > 0
    whole = corpus_pipeline.run(spark, sf)
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert key(whole) == key(docs)


def test_odd_documents_against_brute_force(spark, sf, odd, tmp_path):
    """Nulls, repeated rows, empty and very long texts and further columns, stage by stage against plain Python."""
    documents, labels, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels", "benchmark"))
    passage = items.where("text is not null").orderBy("item_id").first().text
    more = spark.createDataFrame([(20_000, passage), (20_001, passage + " and more"), (20_002, None)], "doc_id long, text string")
    docs = documents.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 30_000), allowMissingColumns=True).unionByName(more, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = quality.score_quality(docs.select("doc_id", "text"), labels, F.lit(True), ["doc_id", "text"])
    rows = [(r.doc_id, r.text) for r in scored.where(f"score >= {quality.THRESHOLD}").collect()]
    first = {}
    for i, t in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), (i, t))
    rows = list(first.values())
    least = {g[0] if len(g) == 1 else min(g, key=lambda i: (i == "None", int(i) if i != "None" else 0)) for g in classes(rows)}
    rows = [r for r in rows if str(r[0]) in least]
    hit = {r[0] for r in contaminated(rows, [(r.item_id, r.text) for r in items.collect()]) if r[2]}
    rows = [r for r in rows if str(r[0]) not in hit]
    encode = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER)).encode
    want = sorted((str(i), len(encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    got = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert sorted((str(r.doc_id), r.n) for r in got) == want
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in full)


def test_no_documents(spark, sf, tmp_path):
    for n in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{n}.parquet").limit(0).write.parquet(f"{tmp_path}/{n}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_of_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(SQL) <= set(QUERIES)
