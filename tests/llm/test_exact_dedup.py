import hashlib
import re
from collections import defaultdict

from navspark.llm import exact_dedup


def want(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[bare])
        out.append((str(i), str(None if keep[1] else keep[2]), len(groups[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out)


def got(df, **how):
    rows = exact_dedup.exact_groups(df, **how).collect()
    per_group = defaultdict(int)
    for r in rows:
        per_group[bytes(r.digest)] += r.kept
    assert set(per_group.values()) <= {1}
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, bytes(r.digest).hex()) for r in rows)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd.select("doc_id", "text", "h", "digest", "rid")) == want(rows)
    assert exact_dedup.exact_groups(nothing).count() == 0
    left = exact_dedup.drop_exact_copies(odd)
    assert left.columns == odd.columns
    assert left.count() == len({w[3] for w in want(rows)})
    assert exact_dedup.drop_exact_copies(nothing).count() == 0


def test_heavy_groups(spark, documents):
    """Groups on both sides of the heavy-hitter split, one of them with a third of the rows."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10_000 + i, "the same text" + " " * (i % 3)) for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(df) == want(rows)
    assert got(df, support=0.01) == want(rows)
    assert got(df, support=0.6) == want(rows)
