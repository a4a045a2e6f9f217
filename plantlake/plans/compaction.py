"""Bronze in two tiers: lines as the stream landed them, and closed days packed into few files.

The landing sink's log names the files it wrote, so they are never replaced where
they lie. Closed days are copied into a tree of their own; a mark, kept beside it,
tells from which arrival day on the landing tree is read.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlake.operators.joins import lookup_join
from plantlake.plans.ingest import ExtractMarks
from plantlake.session import fresh_path
from plantlake.sinks.folders import Folders
from plantlake.streaming.landing_job import PARTITIONS

#: Bytes of lines wanted in a packed file.
TARGET_BYTES = 256 * 1024 * 1024

_FOLDERS = "factory_id string, year string, month string, day string"
_EPOCH = datetime.date(1970, 1, 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"value string, {_FOLDERS}").text(path)


def _arrival():
    return F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])


def _mark(spark: SparkSession, packed: str) -> tuple[int, datetime.date]:
    turn, days = ExtractMarks(spark, f"{packed}_marks").last()
    return turn, _EPOCH + datetime.timedelta(days=days or 0)


def packing(files: DataFrame, target_bytes: int) -> DataFrame:
    """Each file's ``bin``, numbered from 0 over all folders.

    Within a folder files are lined up by name; a bin takes those that begin in
    the same ``target_bytes`` of the line. So a folder of n bytes gets at most n /
    ``target_bytes`` + 1 bins and no bin exceeds the target by more than one file.
    The windows run over files, one folder or one list of folders at a time.
    """
    inside = Window.partitionBy(*PARTITIONS).orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    placed = files.withColumn("place", F.floor(before / target_bytes))
    bins = placed.select(*PARTITIONS, "place").distinct()
    by_day = Window.partitionBy("year", "month", "day")
    numbered = bins.withColumn("rank", F.row_number().over(by_day.orderBy("factory_id", "place")))
    days = numbered.groupBy("year", "month", "day").agg(F.max("rank").alias("bins"))
    # days of the calendar, so one task orders them
    earlier = Window.orderBy("year", "month", "day").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("bins").over(earlier), F.lit(0)).alias("offset")
    bins = numbered.join(F.broadcast(days.select("year", "month", "day", offset)), ["year", "month", "day"])
    bins = bins.withColumn("bin", (F.col("offset") + F.col("rank") - 1).cast("int"))
    return placed.join(bins.select(*PARTITIONS, "place", "bin"), [*PARTITIONS, "place"]).select(
        *PARTITIONS, "name", "bytes", "bin"
    )


def landed_files(spark: SparkSession, landed: str) -> DataFrame:
    """The landing's files by folder, from the listing: no file is opened."""
    files = spark.read.format("binaryFile").load(landed)
    # from the path, as the reader would guess the types of folder columns
    plain = F.regexp_replace("path", r"\+", "%2B")
    folder = [F.url_decode(F.regexp_extract(plain, f"/{c}=([^/]*)/", 1)).alias(c) for c in PARTITIONS]
    name = F.regexp_extract("path", "[^/]+$", 0).alias("name")
    return files.select(*folder, name, F.col("length").alias("bytes"))


def compact(spark: SparkSession, landed: str, packed: str, before: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the lines that arrived before the day ``before``; the number of files written.

    Days packed by earlier runs are not read again. Every line goes to one file
    per bin of its folder, in one job whose tasks are the bins. The new files are
    completed aside and moved folder by folder; the mark follows last, and until
    then these days are read from the landing. A run that failed is simply repeated.

    The days must be closed: lines landed in them later are not seen. A ``before``
    at or below the mark does nothing. One writer at a time; the landed
    files stay for whoever expires them.
    """
    turn, mark = _mark(spark, packed)
    end = datetime.date.fromisoformat(before)
    if end <= mark:
        return 0
    due = (_arrival() >= F.lit(mark)) & (_arrival() < F.lit(end))
    plan_at, staging = fresh_path(spark, "packing"), fresh_path(spark, "packed")
    packing(landed_files(spark, landed).where(due), target_bytes).write.parquet(plan_at)
    plan = spark.read.parquet(plan_at)
    bins = (plan.agg(F.max("bin")).first()[0] + 1) if not plan.isEmpty() else 0
    if bins:
        lines = _lines(spark, landed).where(due).withColumn("name", F.col("_metadata.file_name"))
        binned = lookup_join(lines, plan.drop("bytes"), [*PARTITIONS, "name"], "inner")
        binned = binned.repartitionById(bins, "bin").select("value", *PARTITIONS)
        binned.write.partitionBy(*PARTITIONS).text(staging)
        folders = Folders(spark, packed)
        for name in _day_folders(folders, staging):
            folders.swap(f"{staging}/{name}", f"{packed}/{name}")
    ExtractMarks(spark, f"{packed}_marks").note(turn + 1, (end - _EPOCH).days)
    return bins


def _day_folders(folders: Folders, root: str) -> list[str]:
    """The relative paths of the folders at the lowest level."""
    paths = [""]
    for _ in PARTITIONS:
        paths = [f"{p}/{n}".lstrip("/") for p in paths for n in folders.names(f"{root}/{p}".rstrip("/"))]
    return paths


def bronze_lines(spark: SparkSession, landed: str, packed: str) -> DataFrame:
    """All lines with their folder columns, each from one tier; folders of the other are pruned."""
    _, mark = _mark(spark, packed)
    fresh = _lines(spark, landed).where(_arrival() >= F.lit(mark))
    if not Folders(spark, packed).exists(packed):
        return fresh
    return _lines(spark, packed).where(_arrival() < F.lit(mark)).unionByName(fresh)
