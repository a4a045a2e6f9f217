"""Windowed anomaly alerts; one transform for batch and streaming readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.functions import metrics
from plantlake.functions.scalars import event_time


def windowed_rates(
    events: DataFrame,
    window: str = schemas.ALERT_WINDOW,
    delay: str = schemas.ALERT_DELAY,
    flag: str = "is_anomaly",
    distinct_events: bool = False,
) -> DataFrame:
    """Counts, anomalies and mean per tumbling window × factory × equipment × measurement.

    Readings are taken as they come: neither trimmed nor deduplicated, unless
    ``distinct_events`` asks for one reading per id within the watermark (those
    without an id all count).
    Readings without a usable time belong to no window.
    """
    timed = events.withColumn("event_ts", event_time()).withWatermark("event_ts", delay)
    if distinct_events:
        streaming = timed.isStreaming
        own = F.expr("uuid()") if streaming else F.monotonically_increasing_id().cast("string")
        timed = timed.withColumn("_own", F.when(F.col("event_id").isNull(), own))
        distinct = timed.dropDuplicatesWithinWatermark if streaming else timed.dropDuplicates
        timed = distinct(["event_id", "_own"])
    return (
        timed.groupBy(
            F.window("event_ts", window), "factory_id", "equipment_id", "measurement_type"
        )
        .agg(
            F.count("*").alias("event_count"),
            metrics.anomaly_total(flag).alias("anomaly_count"),
            F.avg("value").alias("avg_value"),
        )
        .withColumn("anomaly_rate", metrics.rate())
    )


def raised(
    rates: DataFrame,
    warning: float = schemas.WARNING_RATE,
    critical: float = schemas.CRITICAL_RATE,
) -> DataFrame:
    """The windows whose rate is worth an alert."""
    level = metrics.alert_level(F.col("anomaly_rate"), warning, critical)
    return rates.withColumn("alert_level", level).filter(F.col("alert_level") != "normal")


def windowed_alerts(events: DataFrame, **options) -> DataFrame:
    """Readings → alerts, with the options of :func:`windowed_rates`."""
    return raised(windowed_rates(events, **options))
