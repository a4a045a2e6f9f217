"""The sensor topic as a stream (needs the Kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantlake import schemas


def topic_options(
    servers: str,
    topic: str = schemas.SENSOR_TOPIC,
    start: str = "latest",
    lossless: bool | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """``latest`` for alerts, ``earliest`` for landing.

    ``lossless`` (by default: from ``earliest``) stops the stream when offsets
    are gone from the topic instead of skipping them. ``max_offsets`` bounds a
    micro-batch, so that a backlog is not taken in one; ``min_partitions``
    splits it over more tasks than the topic has partitions. ``extra`` holds
    further options, such as ``kafka.security.protocol``.
    """
    strict = start == "earliest" if lossless is None else lossless
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(strict).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options | (extra or {})


def sensor_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_options(servers, **options)).load()
