"""Streaming alerts: messages → windowed alerts → JSON files, optionally console."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plantlake import schemas
from plantlake.functions.records import decode_events
from plantlake.operators.alerts import windowed_alerts
from plantlake.session import ROCKSDB_PROVIDER, pin_utc
from plantlake.sources.files import JSON_TIME


def trigger_of(interval: str | None) -> dict:
    """A processing-time trigger, or everything available and then stop."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def alerts_from_messages(messages: DataFrame, **options) -> DataFrame:
    return windowed_alerts(decode_events(messages, schemas.STREAM_EVENT), **options)


def start_file_sink(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = schemas.ALERT_TRIGGER,
) -> StreamingQuery:
    """Append closed windows as JSON by factory, exactly once per checkpoint.

    A window comes out once the watermark reaches its end, that is after an
    event at least the watermark delay later has been seen; the windows at the
    very end of a stream stay open. State lives in RocksDB, outside the heap.
    """
    spark = alerts.sparkSession
    pin_utc(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return (
        alerts.writeStream.outputMode("append")
        .format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("timestampFormat", JSON_TIME)
        .partitionBy("factory_id")
        .trigger(**trigger_of(interval))
        .start()
    )


def start_console_sink(
    spark: SparkSession, path: str, interval: str | None = schemas.ALERT_TRIGGER
) -> StreamingQuery:
    """The alerts on the console, untruncated, one trigger after they were written.

    It follows the alert files instead of the topic, so the topic is read and
    the windows are kept only once. Start the file sink first: it makes the
    folder. Starting the console again shows all alerts again.
    """
    written = (
        spark.readStream.schema(schemas.ALERT).option("timestampFormat", JSON_TIME).json(path)
    )
    return (
        written.writeStream.outputMode("append")
        .format("console")
        .option("truncate", "false")
        .trigger(**trigger_of(interval))
        .start()
    )


def run_alerts(messages: DataFrame, path: str, checkpoint: str, console: bool = False) -> None:
    """The long-running job: stops with an error as soon as either query fails."""
    start_file_sink(alerts_from_messages(messages), path, checkpoint)
    if console:
        start_console_sink(messages.sparkSession, path)
    messages.sparkSession.streams.awaitAnyTermination()
