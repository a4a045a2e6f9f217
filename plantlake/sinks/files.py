"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.session import fresh_path
from plantlake.sinks.folders import Folders
from plantlake.sources.files import JSON_TIME

BY_MONTH = ["year", "month", "factory_id"]


def write_silver(
    silver: DataFrame,
    path: str,
    fmt: str = "json",
    partition_by: list[str] | None = None,
    max_files: int | None = None,
) -> None:
    """Overwrite Silver, flat by default.

    The dedup shuffle has already sized the tasks, so a flat write adds none.
    ``max_files`` repartitions after the heavy work instead of shrinking it.
    """
    if partition_by:
        silver = silver.hint("rebalance", *partition_by)
    elif max_files:
        silver = silver.repartition(max_files)
    writer = silver.write.mode("overwrite").option("timestampFormat", JSON_TIME)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def write_gold(gold: DataFrame, path: str) -> None:
    """Overwrite Gold as Parquet by year, month and factory.

    The rebalance brings each folder's rows together and splits the big ones,
    so neither many small files nor one huge task result.
    """
    (
        gold.hint("rebalance", *BY_MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*BY_MONTH)
        .parquet(path)
    )


def month_folder(month: tuple[int, int]) -> str:
    return f"year={month[0]}/month={month[1]}"


def stage_months(rows: DataFrame, staging: str, fmt: str = "parquet") -> None:
    """Write ``rows`` by month and factory below ``staging``, in one job for all months."""
    writer = rows.hint("rebalance", *BY_MONTH).write.option("timestampFormat", JSON_TIME)
    writer.partitionBy(*BY_MONTH).format(fmt).save(staging)


def filled_months(spark: SparkSession, staging: str, months: set[tuple[int, int]]) -> dict[tuple[int, int], bool]:
    """Which months have staged rows; the others become empty."""
    folders = Folders(spark, staging)
    return {m: folders.exists(f"{staging}/{month_folder(m)}") for m in months}


def swap_months(spark: SparkSession, staging: str, path: str, filled: dict[tuple[int, int], bool]) -> None:
    """Move staged months into their places; may be repeated after a crash."""
    folders = Folders(spark, path)
    for month in sorted(filled):
        staged = f"{staging}/{month_folder(month)}" if filled[month] else None
        folders.swap(staged, f"{path}/{month_folder(month)}")


def replace_months(
    rows: DataFrame, path: str, months: set[tuple[int, int]], fmt: str = "parquet"
) -> None:
    """Make ``rows`` all that the given (year, month) folders hold; others stay.

    A factory that vanished from a month loses its folder. The rows are worked
    out once, into a staging folder, since they may depend on what is replaced;
    their folders are then moved, so many months cost no more jobs than one.
    """
    spark, staging = rows.sparkSession, fresh_path(rows.sparkSession, "months")
    stage_months(rows, staging, fmt)
    swap_months(spark, staging, path, filled_months(spark, staging, months))


def land_by_run_date(records: DataFrame, path: str, mode: str) -> bool:
    """JSON lines per ``run_date``; nothing is written for no rows.

    ``overwrite`` replaces only the run dates present, so a rerun of a day is
    safe; ``append`` adds one more snapshot.
    """
    if records.isEmpty():
        return False
    (
        records.hint("rebalance", "run_date")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", JSON_TIME)
        .partitionBy("run_date")
        .json(path)
    )
    return True


def run_date(day: str, grain: str) -> Column:
    """The first day a run covers: daily runs, or a backfill in coarser ones."""
    if grain not in schemas.GRAINS:
        raise ValueError(f"grain must be one of {schemas.GRAINS}, not {grain!r}")
    return F.date_trunc(grain, F.col(day).cast("timestamp")).cast("date")


def land_erp(records: DataFrame, path: str, grain: str = "day") -> bool:
    """ERP records filed under the run that covers their event date."""
    return land_by_run_date(
        records.withColumn("run_date", run_date("event_date", grain)), path, "overwrite"
    )


def land_maintenance(records: DataFrame, path: str, grain: str = "day") -> bool:
    """One more maintenance snapshot, filed under the run that covers its scheduled date."""
    return land_by_run_date(
        records.withColumn("run_date", run_date("scheduled_date", grain)), path, "append"
    )


def expire(
    landed: DataFrame,
    path: str,
    as_of: str,
    day: str,
    *grains: str,
    months: int = schemas.RETENTION_MONTHS,
) -> list[tuple[str, str]]:
    """Remove landed records whose ``day`` is out of the retention period; (folder, action) of each.

    ``path`` holds ``run_date`` folders of JSON lines and ``landed`` reads it.
    By its name alone a folder is ``dropped`` (all its period has expired; no
    file is opened) or ``kept``; only what the cutoff runs through is
    ``rewritten``. ``grains`` are those the folders were written with, the
    longest decides. Folders without a date are kept. Rewritten folders are
    swapped in when complete, so a failed run leaves all of them readable; a
    rerun ends the same. Records of other folders and null days are not touched.
    """
    if not grains or set(grains) - set(schemas.GRAINS):
        raise ValueError(f"name the grains of the folders, of {schemas.GRAINS}, not {grains}")
    spark, folders = landed.sparkSession, Folders(landed.sparkSession, path)
    folders.restore(path)
    names = [n for n in folders.names(path) if n.startswith("run_date=")]
    plan = _expiry(spark, names, as_of, max(grains, key=schemas.GRAINS.index), months)
    for name, action in plan:
        if action == "dropped":
            folders.drop(f"{path}/{name}")
    border = [name.split("=", 1)[1] for name, action in plan if action == "rewritten"]
    if border:
        staging = fresh_path(spark, "expiry")
        cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
        on = F.col(day).cast("date")
        rest = landed.where(F.col("run_date").isin(border)).where(on.isNull() | (on >= cutoff))
        writer = rest.hint("rebalance", "run_date").write.option("timestampFormat", JSON_TIME)
        writer.partitionBy("run_date").json(staging)
        for folder in border:
            name = f"run_date={folder}"
            staged = f"{staging}/{name}" if folders.exists(f"{staging}/{name}") else None
            folders.swap(staged, f"{path}/{name}")
    return plan


def _expiry(spark: SparkSession, names: list[str], as_of: str, grain: str, months: int) -> list[tuple[str, str]]:
    """What becomes of each folder: its period lies before the cutoff, on it or behind it."""
    if not names:
        return []
    after = {"day": "1 DAY", "week": "7 DAYS", "month": "1 MONTH", "quarter": "3 MONTHS", "year": "1 YEAR"}[grain]
    cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
    end = F.col("start") + F.expr(f"INTERVAL {after}")
    action = F.when(F.col("start").isNull() | (F.col("start") >= cutoff), "kept").when(end <= cutoff, "dropped")
    dated = spark.createDataFrame([(n,) for n in names], "name string").withColumn(
        "start", F.when(F.col("name").rlike(r"=\d{4}-\d{2}-\d{2}$"), F.to_date(F.split("name", "=")[1]))
    )
    told = F.struct("name", action.otherwise("rewritten").alias("action"))
    # folders, however many records
    return [tuple(r) for r in dated.agg(F.array_sort(F.collect_list(told))).first()[0]]


def write_documents(documents: DataFrame, path: str) -> None:
    """Nested registry documents as JSON lines."""
    documents.write.mode("overwrite").json(path)


def write_snapshot(documents: DataFrame, root: str, effective_from: str) -> None:
    """One version of the registry, in force from a time on; writing it again replaces it."""
    dated = documents.withColumn("effective_from", F.lit(effective_from).cast("timestamp"))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("effective_from").json(root)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Schema and untruncated first rows on the console."""
    df.printSchema()
    df.show(rows, truncate=False)
