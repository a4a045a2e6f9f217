"""Aggregates and rates shared by the hourly metrics and the alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantlake import schemas


def anomaly_total(flag: str = "is_anomaly") -> Column:
    """Flags raised; null flags are skipped and a group of only nulls gives null."""
    return F.sum(F.col(flag).cast("int"))


def rate(part: str = "anomaly_count", whole: str = "event_count") -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def criticality(
    rate_weight: float = schemas.RATE_WEIGHT,
    variation_weight: float = schemas.VARIATION_WEIGHT,
) -> Column:
    """Weighted anomaly rate plus weighted coefficient of variation.

    Null where the deviation is unknown (one reading) or the mean is zero.
    """
    variation = F.try_divide(F.col("std_value"), F.col("avg_value"))
    return F.col("anomaly_rate") * rate_weight + variation * variation_weight


def alert_level(
    rate_column: Column,
    warning: float = schemas.WARNING_RATE,
    critical: float = schemas.CRITICAL_RATE,
) -> Column:
    """Level of a rate; an unknown rate counts as normal."""
    return (
        F.when(rate_column >= critical, F.lit("critical"))
        .when(rate_column >= warning, F.lit("warning"))
        .otherwise(F.lit("normal"))
    )
