"""Where a query may write what it reads again, the file system it does that on, and large values in parts for Python."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Characters or bytes of a part: as a batch for Python is so many rows, whatever their size, this bounds its bytes.
PART = 1024


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a local session may go without one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        named = sc.getCheckpointDir()
    return f"{named}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop's file system of ``path``, the function that makes paths of it)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    fs, make = file_system(spark, path)
    return fs.exists(make(path))


def delete(spark: SparkSession, path: str) -> None:
    fs, make = file_system(spark, path)
    fs.delete(make(path), True)


def text_parts(value: Column) -> Column:
    """The parts of a text, in order, and a null behind the last; a null text has none."""
    return _ended(F.regexp_extract_all(value, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)), "string")


def binary_parts(value: Column) -> Column:
    """The parts of a binary value, in order, and a null behind the last; a null value has none."""
    starts = F.sequence(F.lit(0), F.floor((F.length(value) - 1) / PART).cast("int"))
    parts = F.transform(starts, lambda i: F.substring(value, i * PART + 1, F.lit(PART)))
    return _ended(F.when(F.length(value) > 0, parts), "binary")


def _ended(parts: Column, kind: str) -> Column:
    end = F.array(F.lit(None).cast(kind))
    return F.coalesce(F.concat(parts, end), end)
