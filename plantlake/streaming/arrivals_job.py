"""Arrivals: micro-batches are split into readings in time and readings too late for their window.

A stateful query drops late readings and tells only how many. Here the split comes
first: the alert job follows the readings in time and the late ones are kept, so
that their windows can be counted again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlake import schemas
from plantlake.functions.scalars import event_time
from plantlake.operators.alerts import windowed_alerts
from plantlake.sinks.folders import Folders
from plantlake.streaming.alerts_job import trigger_of

IN_TIME, LATE = "in_time", "late"
WINDOW_KEYS = ["factory_id", "equipment_id", "measurement_type"]

_MARK = "newest timestamp"


def _newest_before(spark: SparkSession, root: str, batch: int):
    """The newest event time of the batches before ``batch``, from the last note; None at the start."""
    noted = _noted(Folders(spark, root), root)
    known = [n for n in noted if n < batch]
    if not known:
        return None
    return spark.read.schema(_MARK).parquet(f"{root}/marks/batch={max(known)}").agg(F.max("newest")).first()[0]


def _noted(folders: Folders, root: str) -> list[int]:
    return [int(n.split("=")[1]) for n in folders.names(f"{root}/marks") if n.startswith("batch=")]


def _fate(newest, window: str, delay: str) -> Column:
    """Null for a reading in time, else why it is none."""
    at = event_time()
    reason = F.when(at.isNull(), "no_time")
    if newest is None:
        return reason
    mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    # a null time would take its row away: windows are made for rows with a time only
    end = F.window(F.coalesce(at, F.lit("1970-01-01").cast("timestamp")), window)["end"]
    return reason.when(end <= mark, LATE)


def start_split(
    events: DataFrame,
    root: str,
    checkpoint: str,
    window: str = schemas.ALERT_WINDOW,
    delay: str = schemas.ALERT_DELAY,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    interval: str | None = schemas.ALERT_TRIGGER,
) -> StreamingQuery:
    """Write each trigger's readings below ``root``: ``in_time/batch=N`` and ``late/batch=N``.

    A reading is late if its window ended ``delay`` or more before the newest
    event time of the triggers before its own, which is when a query over the
    readings in time has closed that window. Late rows have a ``reason``; those
    without a usable time have ``no_time``. Every reading is in one of the two.

    ``prepare`` gets each trigger's readings before they are split and must keep
    one row per reading. What it reads it reads anew in every trigger: a registry
    that has changed takes effect in the next one.

    A folder appears when it is complete and never changes: a trigger that is
    repeated after a crash leaves what it finds. So ``root`` and ``checkpoint``
    belong together.
    """

    def split(rows: DataFrame, batch: int) -> None:
        spark, folders = rows.sparkSession, Folders(rows.sparkSession, root)
        newest = _newest_before(spark, root, batch)
        rows = prepare(rows) if prepare else rows
        staging = f"{root}/staged/batch={batch}"
        marked = rows.withColumn("reason", _fate(newest, window, delay))
        marked.withColumn("arrived", F.when(F.col("reason").isNull(), IN_TIME).otherwise(LATE)).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "static").partitionBy("arrived").parquet(staging)
        for part in (LATE, IN_TIME):
            source, target = f"{staging}/arrived={part}", f"{root}/{part}/batch={batch}"
            if folders.exists(source) and not folders.exists(target):
                folders.move(source, target)
        _note(spark, folders, root, batch, newest)

    return (
        events.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(interval))
        .start()
    )


def _note(spark: SparkSession, folders: Folders, root: str, batch: int, newest) -> None:
    """The newest event time so far; notes that no repeated trigger can ask for are dropped."""
    seen, at = f"{root}/{IN_TIME}/batch={batch}", event_time()
    latest = F.lit(newest).cast("timestamp")
    if folders.exists(seen):
        found = spark.read.parquet(seen).agg(F.greatest(F.max(at), latest).alias("newest"))
    else:
        found = spark.range(1).select(latest.alias("newest"))
    found.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch={batch}")
    for old in [n for n in _noted(folders, root) if n < batch - 1]:
        folders.drop(f"{root}/marks/batch={old}")


def follow(spark: SparkSession, root: str, layout: str, max_age: str = "30d") -> DataFrame:
    """The readings in time as a stream, for the alert job.

    Whole triggers arrive in order, so its watermark never runs ahead of the
    split's and it drops nothing. Start it again within ``max_age``.
    """
    reader = spark.readStream.schema(layout).option("maxFileAge", max_age)
    return reader.parquet(f"{root}/{IN_TIME}/batch=*")


def arrived(spark: SparkSession, root: str, part: str, layout: str) -> DataFrame:
    """What has been kept so far, ``in_time`` or ``late``; late rows have their ``reason``."""
    columns = layout + ", reason string" if part == LATE else layout
    if not Folders(spark, root).exists(f"{root}/{part}"):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(f"{root}/{part}/batch=*")


def corrected(
    alerts: DataFrame, in_time: DataFrame, late: DataFrame, window: str = schemas.ALERT_WINDOW, **options
) -> DataFrame:
    """The alerts, with the windows that late readings belong to counted anew.

    Only these windows' readings are grouped again; all other alerts stay as the
    stream wrote them. A recount may raise an alert, change it or take it back.
    """
    begin = F.window(event_time(), window)["start"].alias("begin")
    touched = late.where(F.col("reason") == LATE).select(begin, *WINDOW_KEYS).distinct()
    readings = in_time.unionByName(late.drop("reason"))
    again = _of(readings.withColumn("begin", begin), touched, "left_semi").drop("begin")
    kept = _of(alerts.withColumn("begin", F.col("window.start")), touched, "left_anti").drop("begin")
    return kept.unionByName(windowed_alerts(again, window=window, **options))


def _of(rows: DataFrame, touched: DataFrame, how: str) -> DataFrame:
    """Null ids are a group of their own, so they match as well."""
    met = F.lit(True)
    for key in ["begin", *WINDOW_KEYS]:
        met = met & rows[key].eqNullSafe(touched[key])
    return rows.join(touched, met, how)
