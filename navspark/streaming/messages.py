"""Message consumers: JSON messages to points, HTML messages to a table.

The sources here are files; ``kafka`` is a matter of options to ``readStream``.
A batch is written under its batch id, so a batch that is run again after a
failure replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from navspark.functions.shared import exists
from navspark.operators.messages import NAV_RECORD, decode, publish, route, shape
from navspark.operators.points import merge_points, nav_points, read_points
from navspark.operators.report import accepted, nav_report_flatten, rejected
from navspark.sources.html import non_empty, table_rows
from navspark.sources.tabular import read_version, replace_version


_POINTS = "measurement string, mutual_fund_name string, db_record_time long, time timestamp_ntz, nav double"
_REPORT = "msg_id long, id long, amc_mutual_fund string, mutual_fund_name string, nav string, nav_upload_date_time string, timestamp timestamp"


def _read(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """What was written under ``path``; no rows if nothing was."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def stream_nav_points(spark: SparkSession, source: str, key: str, sink: str, checkpoint: str, trigger: dict | None = None, merged: bool = False) -> tuple[DataFrame, DataFrame]:
    """Consumes the JSON messages under ``source`` with routing key ``key``: the points written to ``sink``, and the rows set aside beside them under a reason.

    With ``merged`` the store has one point of each identity, the last that came, so that messages sent again add none.
    """
    messages = spark.readStream.schema("routing_key string, body string").json(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        records = decode(route(batch, key), NAV_RECORD).withColumn("timestamp", F.timestamp_millis("timestamp"))
        made = nav_points(records).persist()
        if merged:
            merge_points(accepted(made), f"{sink}/points", batch_id)
        else:
            accepted(made).write.mode("overwrite").parquet(f"{sink}/points/batch_id={batch_id}")
        rejected(made).write.mode("overwrite").parquet(f"{sink}/rejected/batch_id={batch_id}")
        made.unpersist()

    query = messages.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()
    query.awaitTermination()
    points = read_points(spark, f"{sink}/points").drop("day") if merged else _read(spark, f"{_POINTS}, batch_id int", f"{sink}/points").drop("batch_id")
    return points, _read(spark, f"{_POINTS}, reject_reason string, batch_id int", f"{sink}/rejected").drop("batch_id")


def stream_message_shape(spark: SparkSession, source: str, key: str, sink: str, checkpoint: str) -> DataFrame:
    """Consumes the JSON messages under ``source`` with routing key ``key``; (n_rows, n_cols) of each."""
    messages = spark.readStream.schema("routing_key string, body string").json(source)
    query = shape(route(messages, key)).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start()
    query.awaitTermination()
    return _read(spark, "n_rows long, n_cols long", sink)


def stream_report_replace(spark: SparkSession, source: str, sink: str, checkpoint: str) -> DataFrame:
    """Consumes HTML messages (msg_id, html); the table of the newest message that has records, empty if none has.

    The table's version is its message: a message that comes later with a smaller
    number changes nothing, in whatever batch, and a failed write leaves the table as it was.
    """
    messages = spark.readStream.schema("msg_id long, html string").json(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        full = non_empty(batch)
        newest = full.agg(F.max("msg_id")).first()[0]
        if newest is not None:
            rows = accepted(nav_report_flatten(table_rows(full.where(F.col("msg_id") == newest), "msg_id"), "msg_id"))
            replace_version(rows, sink, newest)

    query = messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return read_version(spark, sink, _REPORT)


def republish(messages: DataFrame, path: str, checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Publishes the messages again and again to the channel ``path``, each time as the table then is; stop the query to end it."""
    ticks = messages.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(lambda _, __: publish(messages, path)).start()
