"""Decoding and encoding of event records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake import schemas


def decode_events(messages: DataFrame, layout: str = schemas.SENSOR_EVENT) -> DataFrame:
    """Messages with a text or binary ``value`` → one typed column per field.

    A line that is not JSON becomes an all-null row; a field of the wrong JSON
    type becomes null.
    """
    parsed = F.from_json(F.col("value").cast("string"), layout).alias("event")
    return messages.select(parsed).select("event.*")


def as_json(*columns: str | Column) -> Column:
    """One JSON object per row; null fields stay in the text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame, key: str = "equipment_id") -> DataFrame:
    """Keyed messages: the key keeps one equipment's events in order."""
    return events.select(F.col(key).alias("key"), as_json(*events.columns).alias("value"))
