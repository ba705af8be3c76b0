"""Whole tables as JSON messages keyed by row index, and back."""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the record of a NAV message.
NAV_RECORD = "id bigint, amc_mutual_fund string, mutual_fund_name string, nav string, nav_upload_date_time string, timestamp bigint"


def encode(df: DataFrame, key: list[str], routing_key: Column, index: Column, record: list[str]) -> DataFrame:
    """One message (``key``, routing_key, body) per value of ``key``: its records in the order of ``index``, nulls written out."""
    rows = df.select(*key, routing_key.alias("routing_key"), index.alias("idx"), F.struct(*record).alias("rec"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("idx", "rec"))), lambda x: F.struct(x["idx"].cast("string").alias("idx"), x["rec"]))
    return rows.groupBy(*key, "routing_key").agg(F.to_json(F.map_from_entries(ordered), {"ignoreNullFields": "false"}).alias("body"))


def publish(messages: DataFrame, path: str, **options: str) -> None:
    """Adds messages (routing_key, body) to a channel that the stream consumers read: JSON files, or with ``format`` and options any sink."""
    sink = messages.select("routing_key", "body").write.mode("append").format(options.pop("format", "json")).options(**options)
    sink.save(path) if path else sink.save()


def decode(messages: DataFrame, record: str) -> DataFrame:
    """One row per record of each message: the other columns, idx and the record's fields."""
    parsed = messages.withColumn("m", F.from_json("body", f"map<string,struct<{_fields(record)}>>"))
    rows = parsed.select(*[c for c in messages.columns if c != "body"], F.explode("m").alias("idx", "rec"))
    return rows.select(*[c for c in rows.columns if c != "rec"], "rec.*")


def _fields(record: str) -> str:
    return ",".join(":".join(x.split()) for x in record.split(","))


def route(messages: DataFrame, key: str) -> DataFrame:
    """Messages of a direct exchange's binding: the routing key is the same."""
    return messages.where(F.col("routing_key") == key)


#: So many bindings are broadcast at most; an exchange has some dozens.
MAX_BINDINGS = 10_000


def fan_out(messages: DataFrame, bindings: list[tuple[str, str]]) -> DataFrame:
    """``messages`` with queue: one row for each queue bound to the message's key; messages without a queue are dropped, as an exchange does.

    ``bindings`` are (routing key, queue); one that is declared twice counts once.
    """
    declared = sorted(set(bindings))
    bound = messages.sparkSession.createDataFrame(declared, "routing_key string, queue string")
    return messages.join(F.broadcast(bound) if len(declared) <= MAX_BINDINGS else bound, "routing_key")


def publish_to_queues(messages: DataFrame, bindings: list[tuple[str, str]], path: str) -> None:
    """Adds (routing_key, body) of each message to the folder of every queue bound to its key, in one write; ``queue_path`` is what a stream reads."""
    fan_out(messages, bindings).select("routing_key", "body", "queue").write.mode("append").partitionBy("queue").json(path)


def queue_path(path: str, queue: str) -> str:
    return f"{path}/queue={quote(queue, safe=' -_.~')}"


def decode_any(messages: DataFrame) -> DataFrame:
    """One row per record of messages whose fields nobody has declared: the other columns, idx and every field that any record has.

    One pass merges the schemas of all records, a second one reads them. A field
    whose values have different kinds is text, JSON for lists and objects; one
    that is always null is a null text. Bodies that are no JSON object of
    objects have no records.
    """
    own = [c for c in messages.columns if c != "body"]
    parsed = messages.withColumn("nv_m", F.from_json("body", "map<string,variant>"))
    rows = parsed.select(*own, F.explode_outer("nv_m").alias("idx", "nv_rec")).where(F.schema_of_variant("nv_rec").startswith("OBJECT<"))
    merged = rows.agg(F.schema_of_variant_agg("nv_rec")).first()[0]
    fields = [] if merged in (None, "VOID", "OBJECT<>") else T.StructType.fromDDL(_ddl(merged)[len("STRUCT<") : -1]).fields
    mixed = lambda kind: "variant" in kind.simpleString()
    kinds = {f.name: "string" if mixed(f.dataType) or isinstance(f.dataType, T.NullType) else f.dataType.simpleString() for f in fields}
    fielded = rows.withColumn("nv_map", F.col("nv_rec").cast("map<string,variant>"))
    value = lambda name, kind: F.try_variant_get(F.try_element_at("nv_map", F.lit(name)), "$", kind)
    return fielded.select(*own, "idx", *[value(name, kind).alias(name) for name, kind in kinds.items()])


def _ddl(schema: str) -> str:
    """The schema of a variant as DDL of a struct."""
    return re.sub(r"\bOBJECT<", "STRUCT<", schema)


def shape(messages: DataFrame, *key: str) -> DataFrame:
    """(``key``, n_rows, n_cols) of the table in each message, as its body has it: the records, and all field names they use."""
    records = F.from_json("body", "map<string,map<string,string>>")
    names = F.array_distinct(F.flatten(F.transform(F.map_values("records"), F.map_keys)))
    parsed = messages.select(*key, records.alias("records"))
    return parsed.select(*key, F.size("records").cast("long").alias("n_rows"), F.size(names).cast("long").alias("n_cols"))
