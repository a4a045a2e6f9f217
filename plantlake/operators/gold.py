"""Silver rows → Gold metrics, rankings and dashboard rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions import metrics

CALENDAR = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
}


def rollup(silver: DataFrame, grain: str = "hour") -> DataFrame:
    """Metrics per equipment, factory, measurement and calendar unit.

    Only the truncated time is a grouping key; year, month, day and hour follow
    from it, so they are derived after the shuffle.
    """
    units = list(CALENDAR)
    if grain not in units:
        raise ValueError(f"grain must be one of {units}, not {grain!r}")
    bucket = f"timestamp_{grain}"
    parts = {u: CALENDAR[u](bucket) for u in units[: units.index(grain) + 1]}
    keys = ["equipment_id", "factory_id", "measurement_type", bucket]
    measures = ["avg_value", "min_value", "max_value", "std_value", "event_count", "anomaly_count"]
    return (
        silver.withColumn(bucket, F.date_trunc(grain, "timestamp"))
        .groupBy(*keys)
        .agg(
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.stddev_samp("value").alias("std_value"),
            F.count("*").alias("event_count"),
            metrics.anomaly_total().alias("anomaly_count"),
        )
        .withColumns(parts)
        .select(*keys, *parts, *measures)
    )


def score(rolled: DataFrame) -> DataFrame:
    """Anomaly rate and criticality per group."""
    return rolled.withColumn("anomaly_rate", metrics.rate()).withColumn(
        "criticality_score", metrics.criticality()
    )


def hourly(silver: DataFrame) -> DataFrame:
    """The whole Silver → Gold step."""
    return score(rollup(silver, "hour"))


def top_critical(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k most critical groups, unknown scores last, ties settled by key."""
    time = [c for c in gold.columns if c.startswith("timestamp_")]
    return gold.orderBy(
        F.desc_nulls_last("criticality_score"),
        "equipment_id", "factory_id", "measurement_type", *time,
    ).limit(k)


def regroup(gold: DataFrame, *keys: str) -> DataFrame:
    """Coarser metrics from Gold: means are weighted by their event counts."""
    return gold.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
        F.try_divide(
            F.sum(F.col("avg_value") * F.col("event_count")), F.sum("event_count")
        ).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.try_divide(
            F.sum("anomaly_count").cast("double"), F.sum("event_count").cast("double")
        ).alias("anomaly_rate"),
    )


def merged(gold: DataFrame, *keys: str) -> DataFrame:
    """The measures of :func:`rollup` over ``keys``, from finer Gold alone.

    A Gold row carries count, mean and deviation, so also its sum of squared
    deviations, M2 = (n - 1) std². Groups merge by the variance formula
    M2 = Σ M2ᵢ + Σ nᵢ (meanᵢ - mean)²: the common mean is found first, so that
    large means do not cancel small spreads. Event counts are value counts, as
    Silver has no null values.
    """
    n, mean = F.col("event_count"), F.col("avg_value")
    common = gold.groupBy(*keys).agg(
        F.try_divide(F.sum(mean * n), F.sum(n)).alias("common_mean")
    )
    same = [F.col(f"fine.{k}").eqNullSafe(F.col(f"coarse.{k}")) for k in keys]
    met = gold.alias("fine").join(common.alias("coarse"), same).select("fine.*", "common_mean")
    own = F.coalesce((n - 1) * F.col("std_value") * F.col("std_value"), F.lit(0.0))
    off = mean - F.col("common_mean")
    total = F.sum(n)
    return met.groupBy(*keys).agg(
        F.first("common_mean").alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.when(total > 1, F.sqrt(F.sum(own + n * off * off) / (total - 1))).alias("std_value"),
        total.alias("event_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
    )


def coarser(gold: DataFrame, grain: str, fine: str = "hour") -> DataFrame:
    """Gold of a coarser calendar unit, with scores, from finer Gold instead of Silver."""
    units = list(CALENDAR)
    if grain not in units[: units.index(fine)]:
        raise ValueError(f"grain must be coarser than {fine}, not {grain!r}")
    bucket = f"timestamp_{grain}"
    keys = ["equipment_id", "factory_id", "measurement_type", bucket]
    parts = {u: CALENDAR[u](bucket) for u in units[: units.index(grain) + 1]}
    rows = gold.drop(*CALENDAR).withColumn(bucket, F.date_trunc(grain, f"timestamp_{fine}"))
    found = merged(rows, *keys).withColumns(parts)
    return score(found.select(*keys, *parts, *[c for c in found.columns if c not in keys and c not in parts]))


def spread(gold: DataFrame, *keys: str) -> DataFrame:
    """Deviation, anomaly rate and criticality at a dashboard's grain, from Gold."""
    return score(merged(gold, *keys))


def event_type_totals(erp: DataFrame) -> DataFrame:
    """ERP events and cost by type."""
    return erp.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.sum("cost").alias("total_cost"),
        F.avg("cost").alias("avg_cost"),
    )


def event_trend(erp: DataFrame, grain: str = "month") -> DataFrame:
    """ERP events over time, by type."""
    period = F.date_trunc(grain, F.col("event_date").cast("timestamp")).cast("date")
    return erp.groupBy(period.alias("period"), "event_type").agg(
        F.count("*").alias("events"), F.sum("cost").alias("total_cost")
    )


def event_totals(events: DataFrame) -> DataFrame:
    """Readings, anomalies and the anomaly percentage in one row."""
    return events.agg(
        F.count("*").alias("event_count"), metrics.anomaly_total().alias("anomaly_count")
    ).withColumn("anomaly_pct", metrics.rate() * 100)
