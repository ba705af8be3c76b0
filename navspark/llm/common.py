"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of so many rows of a few numbers are broadcast (some 15 MB).
BROADCAST_ROWS = 300_000
#: A file of a short table holds about so many rows.
FILE_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: what the cluster names in ``spark.checkpoint.dir``.

    Only a session without one (tests, a laptop) gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller than a checkpoint, and only the columns that are asked for are read.

    ``rows``, if given, is a number that ``df`` has no more rows than: a short
    table is written to few files.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    few = df if rows is None else df.coalesce(1 + rows // FILE_ROWS)
    few.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.nv_path = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote and that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.nv_path)
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if its ``rows`` narrow rows are at most BROADCAST_ROWS; else joined by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not use (in any letter case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def bloom_block(h: Column, blocks: int) -> Column:
    """The block of 64 bits that a hash falls in."""
    return F.pmod(h, F.lit(blocks)).cast("int")


def bloom_mask(h: Column, bits: int = 4) -> Column:
    """``bits`` bits of its block, from a second hash of the hash."""
    mixed = F.xxhash64(h)
    out = F.lit(0).cast("long")
    for k in range(bits):
        bit = F.shiftrightunsigned(mixed, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def bounded_labels(labels: DataFrame, value: str, keep: Column, per_class: int) -> DataFrame:
    """Up to ``per_class`` (doc_id, label) rows of each class, the same ones every time.

    Rows with a null id or label are left out; an id labelled more than once
    takes its largest label. The bound is the caller's documented sample size,
    so the result may be broadcast.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(value).isin(0, 1) & keep)
        .groupBy("doc_id")
        .agg(F.max(F.col(value).cast("int")).alias("label"))
    )
    order = [F.xxhash64(F.col("doc_id"), F.lit(29)), F.col("doc_id")]
    parts = [rows.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def keep_rows(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` named in ``kept`` (doc_id, key, n: rows of ``docs`` with both), one of each; columns unchanged.

    ``key`` is how a row's key is computed. Only rows that repeat both are
    compared with each other; up to BROADCAST_ROWS names the others stay where
    they are read.
    """
    (own,) = fresh(docs, "nv_key")
    kept = stored(kept.select(F.col("doc_id").alias("nv_kept_id"), F.col("key").alias("nv_kept_key"), F.col("n").alias("nv_kept_n")))
    rows = kept.count()
    same = (F.col(own) == F.col("nv_kept_key")) & F.col("doc_id").eqNullSafe(F.col("nv_kept_id"))
    marked = docs.withColumn(own, key)
    once = marked.join(small(kept.where("nv_kept_n = 1"), rows), same, "left_semi")
    again = marked.join(small(kept.where("nv_kept_n > 1"), rows), same, "left_semi").dropDuplicates(["doc_id", own])
    return (once if kept.where("nv_kept_n > 1").isEmpty() else once.unionByName(again)).drop(own)
