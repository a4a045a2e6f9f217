"""File sources. Layouts are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake import schemas

#: Silver's JSON keeps microseconds; the default writer would cut them.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

ERP_LANDED = schemas.ERP + ", run_date date"
MAINTENANCE_LANDED = schemas.MAINTENANCE + ", landed_at timestamp, run_date date"


def mixed_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Everything below a tree that holds feeds of several layouts.

    Records of other feeds come back as mostly null sensor rows. Folder names
    add no columns here, so a value that exists only in a path reads as null.
    """
    return (
        spark.read.schema(schemas.SENSOR_EVENT).option("recursiveFileLookup", "true").json(root)
    )


def raw_lines(spark: SparkSession, root: str) -> DataFrame:
    """The untyped lines of a sensor tree, as ``value``; blank lines are skipped."""
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    return lines.filter(F.trim("value") != "")


def bronze_sensors(
    spark: SparkSession,
    root: str,
    factory: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """The sensor feed in its own root, with partition columns.

    ``year``, ``month`` and ``day`` are the arrival date. ``factory`` and
    ``since`` (a date) prune folders before any file is opened.
    """
    layout = schemas.SENSOR_EVENT + ", year int, month int, day int"
    rows = spark.read.schema(layout).json(root)
    if factory is not None:
        rows = rows.filter(F.col("factory_id") == factory)
    if since is not None:
        arrival = F.make_date("year", "month", "day")
        rows = rows.filter(arrival >= F.lit(since).cast("date"))
    return rows


def silver(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    reader = spark.read.schema(schemas.SILVER)
    return reader.option("timestampFormat", JSON_TIME).json(path) if fmt == "json" else reader.parquet(path)


def explore(spark: SparkSession, path: str) -> DataFrame:
    """JSON of unknown layout with the schema Spark infers, for looking around.

    Inference reads everything once more, widens ints to long, leaves times as
    text and loses columns that are always null; jobs use the readers above.
    """
    return spark.read.json(path)


def gold(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned Gold with ``year``, ``month`` and ``factory_id`` from the folders."""
    return spark.read.schema(schemas.GOLD).parquet(path)


def alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALERT).option("timestampFormat", JSON_TIME).json(path)


def equipment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EQUIPMENT).json(path)


#: When the file that delivered a document was written.
DELIVERED = "delivered_at"


def equipment_delivery(spark: SparkSession, path: str) -> DataFrame:
    """Delivered documents with :data:`DELIVERED`: a later file's document replaces an earlier one's."""
    written = F.col("_metadata.file_modification_time").alias(DELIVERED)
    return equipment(spark, path).select("*", written)


def equipment_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All versions of the registry as they lie there now, each document with its ``effective_from``."""
    return spark.read.schema(schemas.EQUIPMENT + ", effective_from timestamp").json(root)


def factories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FACTORY).json(path)


def erp(spark: SparkSession, path: str) -> DataFrame:
    """Landed ERP records with their ``run_date`` partition."""
    return spark.read.schema(ERP_LANDED).json(path)


def maintenance(spark: SparkSession, path: str) -> DataFrame:
    """Landed maintenance records with landing time and ``run_date`` partition."""
    reader = spark.read.schema(MAINTENANCE_LANDED)
    return reader.option("timestampFormat", JSON_TIME).json(path)


def maintenance_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot as delivered: JSON arrays of records, one array per file."""
    return spark.read.schema(schemas.MAINTENANCE).option("multiLine", "true").json(path)


def read_or_else(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]
) -> DataFrame:
    """The primary source, or the fallback when its path does not exist.

    ``source`` tells which one was read. Other errors are not swallowed.
    """
    try:
        return primary().withColumn("source", F.lit("primary"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback().withColumn("source", F.lit("fallback"))
