"""Relational and maintenance feeds on their way into Bronze, and Bronze itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake import schemas


def on_date(feed: DataFrame, column: str, day: str) -> DataFrame:
    """The records of one day; the predicate reaches the source."""
    return feed.filter(F.col(column) == F.lit(day).cast("date"))


def erp_records(table: DataFrame) -> DataFrame:
    """ERP rows in landed form: tagged, dates as text, cost as double.

    A cost of zero stays zero; only a missing cost is null.
    """
    return table.select(
        F.lit("erp").alias("source"),
        "id", "equipment_id", "factory_id", "event_type", "description", "technician",
        F.col("cost").cast("double").alias("cost"),
        F.col("event_date").cast("string").alias("event_date"),
        F.col("created_at").cast("string").alias("created_at"),
    )


def latest_per_id(landed: DataFrame, order: str = "landed_at", key: str = "id") -> DataFrame:
    """The newest record of every id across repeated landings.

    The whole row takes part in the comparison, so ties end the same way in
    every run. ``max`` combines before the shuffle: a hot id costs one row per
    map task. Records without an id are no versions of each other: all stay.
    """
    rest = [c for c in landed.columns if c not in (key, order)]
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    newest = F.max(F.struct(order, *rest)).alias("newest")
    latest = landed.withColumn("_own", own).groupBy(key, "_own").agg(newest)
    return latest.select(key, "newest.*").select(*landed.columns)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Feeds of different layouts as one relation; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def retained(
    landed: DataFrame,
    as_of: Column,
    day: str,
    *grains: str,
    folder: str = "run_date",
    months: int = schemas.RETENTION_MONTHS,
) -> DataFrame:
    """Records whose ``day`` is still inside the retention period.

    ``grains`` are those the folders were written with (see
    :func:`plantlake.sinks.files.run_date`). A folder starts no earlier than
    the period that holds its records, so the second predicate is implied by
    the first; it prunes expired folders before a file is opened.
    """
    if not grains or set(grains) - set(schemas.GRAINS):
        raise ValueError(f"name the grains of the folders, of {schemas.GRAINS}, not {grains}")
    cutoff = F.add_months(as_of, -months)
    starts = [F.date_trunc(g, cutoff.cast("timestamp")).cast("date") for g in grains]
    first = F.least(*starts) if len(starts) > 1 else starts[0]
    return landed.filter((F.col(day).cast("date") >= cutoff) & (F.col(folder) >= first))
