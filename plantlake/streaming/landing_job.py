"""Streaming landing: messages → raw JSON lines by factory and arrival date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake.streaming.alerts_job import trigger_of

PARTITIONS = ["factory_id", "year", "month", "day"]

#: Events per file when files of about 500 KB are wanted.
SMALL_FILES = 1_000
#: Default bound: about 250 MB of JSON lines.
LARGE_FILES = 500_000


def landing_rows(messages: DataFrame, arrival: Column | None = None) -> DataFrame:
    """The untouched line plus its partition: factory (``unknown`` if missing or blank), arrival date."""
    arrived = F.current_timestamp() if arrival is None else arrival
    line = F.col("value").cast("string")
    named = F.get_json_object(line, "$.factory_id")
    # an empty folder name would read back as null
    factory = F.when(F.trim(named) != "", named).otherwise("unknown")
    return messages.select(
        line.alias("value"),
        factory.alias("factory_id"),
        F.date_format(arrived, "yyyy").alias("year"),
        F.date_format(arrived, "MM").alias("month"),
        F.date_format(arrived, "dd").alias("day"),
    )


def start_landing(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "1 minute",
    max_events_per_file: int = LARGE_FILES,
    writers_per_factory: int | None = None,
    arrival: Column | None = None,
) -> StreamingQuery:
    """Append lines as they are; the checkpoint means no repeats and no lost tail.

    A text sink writes the body unchanged, ``factory_id`` included, which a
    partitioned JSON sink would cut out. By default every task writes what it
    read. With short triggers and many input partitions that makes many small
    files: ``writers_per_factory`` then gathers each factory in so many tasks.
    The progress of every trigger reports the lines landed (``landed``).
    """
    rows = landing_rows(messages, arrival).observe(
        "landed",
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("factory_id") == "unknown").alias("unknown_factory"),
    )
    if writers_per_factory:
        # by input partition, so that equal lines are spread as well
        writer = F.pmod(F.spark_partition_id(), F.lit(writers_per_factory))
        rows = rows.withColumn("writer", writer).repartition("factory_id", "writer").drop("writer")
    return (
        rows.writeStream.outputMode("append")
        .format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_events_per_file)
        .partitionBy(*PARTITIONS)
        .trigger(**trigger_of(interval))
        .start()
    )
