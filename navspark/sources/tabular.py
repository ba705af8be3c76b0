"""CSV and table sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from navspark.functions.shared import file_system


def read_scheme_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Delimited files with a header; all columns as text, none inferred."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).csv(path, header=True)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """``df`` in place of whatever ``path`` held, read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The marker of a version that is whole; the largest version that has one is the table.
_DONE = "_SUCCESS"


def table_version(spark: SparkSession, path: str) -> int | None:
    """The version that readers of a versioned table see; null if there is none yet."""
    fs, make = file_system(spark, path)
    if not fs.exists(make(path)):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(make(path))]
    whole = [int(n.removeprefix("version=")) for n in names if n.startswith("version=") and fs.exists(make(f"{path}/{n}/{_DONE}"))]
    return max(whole, default=None)


def replace_version(df: DataFrame, path: str, version: int, kept: int = 2) -> bool:
    """``df`` as version ``version`` of the table, unless the table is at that version or a later one; whether it was written.

    A version is a folder of its own, and counts once its last file, the marker
    of a finished write, is there; so a reader sees the old table or the new
    one, and a write that fails leaves the old. The ``kept`` latest versions
    stay, for readers that have begun.
    """
    spark = df.sparkSession
    now = table_version(spark, path)
    if now is not None and now >= version:
        return False
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    fs, make = file_system(spark, path)
    versions = sorted(int(f.getPath().getName().removeprefix("version=")) for f in fs.listStatus(make(path)) if f.getPath().getName().startswith("version="))
    for old in [v for v in versions if v <= version][:-kept]:
        fs.delete(make(f"{path}/version={old}"), True)
    return True


def read_version(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table as of now; no rows if it has no version yet."""
    version = table_version(spark, path)
    return spark.createDataFrame([], schema) if version is None else spark.read.schema(schema).parquet(f"{path}/version={version}")


def replace_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """The same over JDBC; driver and credentials are the caller's options."""
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, **options).save()
