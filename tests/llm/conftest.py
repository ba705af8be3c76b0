import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, wordless and repeated texts, null and repeated ids, ties, one very long text, clashing extra columns."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank"),
        (1, "The quick brown fox jumps over the lazy dog near the old river bank"),
        (2, "The quick  brown fox jumps over the lazy dog near the old river\tbank"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, "!!! ... ???"),
        (None, "a text whose id is null"),
        (None, None),
        (7, long),
        (8, "é" * 300),
        (9, "two words"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for extra in ("score", "kept", "keep_id", "h", "digest", "th", "rid", "rule", "nv_text", "nv_th", "class_id", "item"):
        df = df.withColumn(extra, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
