import pytest
from pyspark.sql import functions as F

from navspark.llm import urls
from navspark.llm.queries import LISTED_HOST, URL_RULES, op1_url_filter

URLS = [
    ("https://m.Example.COM/en/712?x=/de/", "m.example.com", "/en/712", "example.com/en/7", "allow"),
    ("https://m.example.com/en/812#a?b", "m.example.com", "/en/812", "com/en/", "block"),
    ("http://notexample.net/de/8", "notexample.net", "/de/8", "net/de/", "allow"),
    ("http://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
    ("http://example.net:80/de/8", "example.net:80", "/de/8", None, "allow"),
    ("x://net", "net", "", None, "allow"),
    ("x://net?/de/", "net", "", None, "allow"),
    ("a://b://org/es/", "b:", "//org/es/", None, "allow"),
    ("org/es/1", "", "", None, "allow"),
    ("://org/es/\n1", "org", "/es/\n1", "org/es/", "block"),
    ("http://" + "a." * 3000 + "org/es/" + "z" * 100_000, "a." * 3000 + "org", "/es/" + "z" * 100_000, "org/es/", "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(URL_RULES, "action string, host string, path string")


def judged(spark, rules, rows):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string").withColumns({"host": F.lit(1), "r_key": F.lit(2)})
    return [tuple(r) for r in urls.judge_urls(pages, rules).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]


def test_cases(spark, rules):
    assert judged(spark, rules, [u[0] for u in URLS]) == [u[1:] for u in URLS]


def test_repeated_rows_and_empty_tables(spark, rules):
    assert len(judged(spark, rules, [URLS[0][0]] * 3)) == 3
    pages = spark.createDataFrame([(1, URLS[0][0])], "page_id long, url string")
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    row = urls.judge_urls(pages, rules.limit(0)).first()
    assert (row.rule, row.verdict) == (None, "allow")


def test_long_list_equals_brute_force(spark):
    listed = [("block" if i % 3 else "allow", f"h{i % 50}.org" if i % 2 else "org", f"/{i % 7}/{'x' * (i % 4)}") for i in range(400)]
    rules = spark.createDataFrame(listed, "action string, host string, path string")
    rows = [f"http://{'w.' * (i % 3)}h{i % 61}.org/{i % 9}/{'x' * (i % 6)}" for i in range(600)]
    best = {}
    for a, h, p in listed:
        best[h, p] = min(a, best.get((h, p), a))
    want = []
    for u in rows:
        host, _, path = u.removeprefix("http://").partition("/")
        path = "/" + path
        fit = [(len(h + p), h + p, a) for (h, p), a in best.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"))
    assert judged(spark, rules, rows) == want


def test_canonical_forms(spark):
    same = ["http://www.A-b.org/x%20y/", "https://a-B.org.:443/x y", "ftp://me@a-b.org:80/x%20y//?utm_source=f&ref=1#top", "x://a-b.org/x%20y?ref&&"]
    other = ["http://a-b.org:8080/x%20y", "http://a-b.org/x%20y?page=2&ref=x", "http://a-b.org/X%20y", "http://b.org/%zz", "a-b.org/x%20y", None]
    df = spark.createDataFrame([(u,) for u in same + other], "url string").select(urls.canonical_url(F.col("url")).alias("c"))
    got = [r.c for r in df.collect()]
    assert got == ["a-b.org/x y"] * 4 + ["a-b.org:8080/x y", "a-b.org/x y?page=2", "a-b.org/X y", "b.org/%zz", None, None]


def test_listed_urls_in_any_form(spark, rules):
    listed = spark.createDataFrame([("http://www.bad.net/x/",), ("https://m.example.com/en/712",), (None,), ("no url",)], "url string")
    rows = ["https://bad.net/x?utm_a=1", "http://bad.net/x/y", "HTTP://BAD.NET:80/x", "https://m.example.com/en/712#a", None, "no url"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(rows)], "page_id long, url string, u string")
    got = urls.judge_urls(pages, rules, listed=listed).orderBy("page_id").collect()
    assert [r.verdict for r in got] == ["block", "allow", "block", "allow", "allow", "allow"] and got[3].rule == "example.com/en/7"
    assert [r.verdict for r in urls.judge_urls(pages, rules.limit(0), listed=listed).orderBy("page_id").collect()][3] == "block"
    assert urls.judge_urls(pages.limit(0), rules, listed=listed.limit(0)).count() == 0


def test_lists_of_many_bytes_give_the_same(spark, rules, monkeypatch):
    listed = spark.createDataFrame([("http://www.bad.net/x/",), ("x://b.org/" + "y" * 5000,)], "url string")
    rows = ["https://bad.net/x?utm_a=1", "http://bad.net/x/y", "x://b.org/" + "y" * 5000, "https://m.example.com/en/712#a", None]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    want = sorted(urls.judge_urls(pages, rules, listed=listed).collect(), key=lambda r: r.page_id)
    monkeypatch.setattr(urls, "BROADCAST_BYTES", 10)
    assert sorted(urls.judge_urls(pages, rules, listed=listed).collect(), key=lambda r: r.page_id) == want
    assert [r.verdict for r in want] == ["block", "allow", "block", "allow", "allow"]


def test_long_rule_paths(spark):
    paths = ["/" + "p" * k for k in (63, 64, 100, 128, 1500)] + ["/" + "p" * 99 + "q"]
    rules = spark.createDataFrame([("block", "h.org", p) for p in paths], "action string, host string, path string")
    rows = [f"x://h.org/{'p' * k}" for k in (10, 63, 90, 100, 127, 128, 1499, 1500, 1600)] + ["x://h.org/" + "p" * 99 + "qq"]
    want = [max((p for p in paths if u[9:].startswith(p)), key=len, default=None) for u in rows]
    assert [r[2] for r in judged(spark, rules, rows)] == [None if w is None else "h.org" + w for w in want]


def test_query_blocks_mirrors_in_any_form(spark, tmp_path):
    """Verdicts that no pattern of hosts gives: one host has blocked and allowed pages."""
    page = lambda a: f"<html><article>{a}</article></html>"
    rows = [
        (1, "http://a.fr/fr/1", page("one\ntext")),
        (2, "http://a.fr/fr/2?utm_source=feed", page("one\ntext")),
        (3, "https://www.a.fr/fr/2/#top", page("another")),
        (4, "http://a.fr/fr/2?page=2", page("a third")),
        (5, "http://x.com/en/5", page("one\ntext")),
        (6, "http://a.adult-x.fr/6", page("a fourth")),
        (7, "http://a.fr/fr/7", page("")),
        (8, "http://a.fr/fr/8", page("")),
        (9, "http://a.fr/fr/9", None),
        (10, None, page("another")),
        (None, "http://a.fr/fr/11", page("one\ntext")),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in op1_url_filter(spark, str(tmp_path)).collect()}
    assert {k for k, v in got.items() if v == "block"} == {2, 3, 5, 6, None} and len(got) == len(rows)


def test_list_of_the_query_decides(spark, sf):
    found = op1_url_filter(spark, sf).where("rule IS NULL")
    listed = found.where((F.col("verdict") == "block") & ~F.col("host").rlike(LISTED_HOST))
    assert listed.join(found.where("verdict = 'allow'"), "host", "left_semi").count() > 0
