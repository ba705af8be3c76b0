import re

from pyspark.sql import functions as F

from navspark.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def want(docs, items):
    windows = []
    for item, t in items:
        w = words(t)
        windows += [(item, tuple(w[i : i + 10])) for i in range(max(1, len(w) - 9))] if w else []
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= {str(item)} if item is not None else set()
        out.append((str(i), len(w), len(hit), ",".join(sorted(found))))
    return sorted(out)


def got(docs, items):
    rows = D.window_hits(docs, items).select("doc_id", "n_words", D.covered(F.col("spans")).alias("n"), "items").collect()
    return sorted((str(r.doc_id), r.n_words, r.n, ",".join(r["items"])) for r in rows)


def test_cases(spark, odd, nothing):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, f"x {ten} eleven"), (1, f"x {ten} eleven"), (2, ten.upper().replace(" ", "--")), (3, None), (4, ""), (5, "tiny Item, tiny item"), (6, ten[:-3]), (None, f"{ten} {ten}")]
    docs += [(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id != 7").collect()]
    items = [(10, f"{ten} eleven"), (2, ten), (3, "Tiny item"), (4, None), (5, "..."), (None, "nine ten"), (2, ten), (77, "two words")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(d, b) == want(docs, items)
    assert {r[2] for r in got(d, b.limit(0))} == {0}
    assert got(d.limit(0), b) == []
    left = D.drop_contaminated(odd.unionByName(d, allowMissingColumns=True), b)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(r[0] for r in want([(r.doc_id, r.text) for r in odd.collect()] + docs, items) if not r[2])


def _broadcast(df):
    """Names of the columns that the plan broadcasts."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return " ".join(line for line in plan.splitlines() if "rightHint=(strategy=broadcast)" in line)


def test_shuffled_join_gives_the_same(spark, documents, sf, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    long = " ".join(r.text for r in bench.orderBy("item_id").limit(3).collect()) + " and" + " other words, often the same" * 5000
    extra = spark.createDataFrame([(-1, long), (-2, "nine ten"), (-3, None), (-3, "")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(extra)
    items = bench.unionByName(spark.createDataFrame([(-7, "nine ten"), (-8, "other words often the same other words")], "item_id long, text string"))
    broadcast = got(docs, items)
    assert {r[0] for r in broadcast if r[2]} >= {"-1", "-2"}
    with monkeypatch.context() as m:
        m.setattr(D, "BROADCAST_WINDOWS", 0)
        assert got(docs, items) == broadcast
    monkeypatch.setattr(D, "BROADCAST_BYTES", 39_000)  # a few long words are too many bytes already
    wide = items.where("item_id > 0").limit(1).unionByName(spark.createDataFrame([(-9, "é" * 20_000 + " nine")], "item_id long, text string"))
    assert D.test_windows(wide).count() < D.BROADCAST_WINDOWS
    held = docs.unionByName(spark.createDataFrame([(-4, "x " + "é" * 20_000 + " nine")], "doc_id long, text string"))
    assert ("-4", 3, 2, "-9") in got(held, wide)
    assert "t_h" not in _broadcast(D.window_hits(held, wide)) and "t_h" in _broadcast(D.window_hits(held, wide.where("item_id > 0")))
