"""The daily Bronze → Silver → Gold chain, with serving as an optional last step."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plantlake.operators import gold, silver
from plantlake.operators.joins import measured_bytes
from plantlake.plans.ledger import RunLedger
from plantlake.session import fresh_path, pin_utc
from plantlake.sinks.files import filled_months, replace_months, stage_months, swap_months, write_gold, write_silver
from plantlake.sinks.serving import serve_gold
from plantlake.sources import files

#: Ids of an arrival up to this size are broadcast; Silver then stays where it lies.
MAX_IDS_BYTES = 8 * 1024 * 1024


def bronze_to_silver(bronze: DataFrame, path: str, **options) -> bool:
    """False, and nothing written, when there are no sensor rows."""
    if silver.sensor_rows(bronze).isEmpty():
        return False
    write_silver(silver.clean(bronze), path, **options)
    return True


def lines_to_silver(lines: DataFrame, path: str, rejects: str, **options) -> dict[str, int]:
    """Raw lines → Silver, and what Silver does not take → ``rejects`` with its reasons.

    The lines are parsed once, into a staging folder by fate; Silver and the
    rejects (JSON lines) are written from there. Returns what became of the
    lines: read = accepted + duplicates + rejected, each counted by the pass
    that writes it. Without lines nothing is written.
    """
    spark, staging = lines.sparkSession, fresh_path(lines.sparkSession, "judged")
    read, kept, refused = Observation("read"), Observation("kept"), Observation("refused")
    one, fits = F.count(F.lit(1)), F.size("reasons") == 0
    judged = silver.assessed(lines).withColumn("fits", fits)
    judged = judged.observe(read, one.alias("rows"), F.count_if("fits").alias("fit"))
    judged.write.partitionBy("fits").parquet(staging)
    told = {"read": read.get["rows"], "accepted": 0, "duplicates": 0, "rejected": 0}
    if not told["read"]:
        return told
    staged = spark.read.schema(judged.schema).parquet(staging)
    refusals = silver.rejected(staged.where("NOT fits")).observe(refused, one.alias("rows"))
    refusals.write.mode("overwrite").json(rejects)
    rows = silver.survivors(staged.where("fits").drop("fits")).observe(kept, one.alias("rows"))
    write_silver(rows, path, **options)
    told["rejected"] = refused.get["rows"]
    told["accepted"] = kept.get["rows"]
    told["duplicates"] = read.get["fit"] - told["accepted"]
    return told


def update_silver(
    arrived: DataFrame, path: str, fmt: str = "parquet", ledger: RunLedger | None = None
) -> set[tuple[int, int]]:
    """Merge newly arrived readings into Silver partitioned by month.

    Equal to a full rebuild over all arrivals, since the smallest of all copies
    of an event is the smallest of the old survivor and the new copies. Late
    readings may belong to older months, and a copy may move its event to
    another one: exactly the months of the new readings and of the survivors
    they meet are replaced. Returns those (year, month) pairs; arriving again
    changes nothing. Beyond :data:`MAX_IDS_BYTES` the new ids don't pass the
    driver: they meet Silver by a shuffle.

    With a ``ledger`` the months are noted when their new content is complete
    beside the old one, before anything changes; see :func:`resume_silver`.
    """
    spark = arrived.sparkSession
    plain = [c for c in silver.clean(arrived).columns if c not in ("year", "month", "day")]
    staged = fresh_path(spark, "arrived")
    write_silver(silver.clean(arrived), staged, fmt=fmt)
    new = files.silver(spark, staged, fmt)
    ids = new.select("event_id")
    few = measured_bytes(ids) <= MAX_IDS_BYTES
    ids = F.broadcast(ids) if few else ids.hint("merge")
    try:
        old = files.silver(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        old = new.limit(0)
    met = old.join(ids, "event_id", "left_semi")
    months = _months(new) | _months(met)
    if not months:
        return months
    if few:
        winners = silver.with_calendar(silver.dedup(met.unionByName(new).select(*plain)))
        kept = old.where(_in_months(months)).join(ids, "event_id", "left_anti")
        merged = kept.unionByName(winners)
    else:
        # one shuffle of these months: ids are unique in both, so a row that meets no other stays as it is
        both = old.where(_in_months(months)).unionByName(new)
        merged = silver.with_calendar(silver.dedup(both.select(*plain)))
    if ledger is None:
        replace_months(merged, path, months, fmt)
        return months
    staging = ledger.staging()
    stage_months(merged, staging, fmt)
    filled = filled_months(spark, staging, months)
    ledger.note("staged", filled, staging)
    swap_months(spark, staging, path, filled)
    ledger.note("silver", months)
    return months


def resume_silver(spark: SparkSession, path: str, ledger: RunLedger) -> set[tuple[int, int]]:
    """End what a failed run has begun on Silver; the months whose Gold is not written yet.

    Staged months that are not in their place are moved there: a month is
    either as before the failed run or as after it, never in between.
    """
    pending = ledger.pending()
    for staging in dict.fromkeys(p["staged"] for p in pending if p["state"] == "staged"):
        filled = {(p["year"], p["month"]): p["filled"] for p in pending if p["staged"] == staging}
        swap_months(spark, staging, path, filled)
        ledger.note("silver", set(filled))
    return {(p["year"], p["month"]) for p in pending}


def _months(rows: DataFrame) -> set[tuple[int, int]]:
    """The months that occur; one small set, however many rows."""
    found = rows.agg(F.collect_set(F.struct("year", "month"))).first()[0]
    return {(r["year"], r["month"]) for r in found}


def _in_months(months: set[tuple[int, int]]) -> Column:
    """A predicate on the partition columns, one part per month."""
    part = [(F.col("year") == y) & (F.col("month") == m) for y, m in sorted(months)]
    return reduce(or_, part, F.lit(False))


def silver_to_gold(
    rows: DataFrame,
    path: str,
    since: str | None = None,
    months: set[tuple[int, int]] | None = None,
) -> None:
    """Gold for all of Silver, for the months from ``since`` (``YYYY-MM``) on, or for ``months``.

    An hour lies in one month, so recomputing whole months is exact: they are
    replaced as a whole, factories that vanished included, and others stay.
    Silver partitioned by year and month is then read for those months only.
    """
    if since is None and months is None:
        write_gold(gold.hourly(rows), path)
        return
    if months is None:
        first = int(since.replace("-", ""))
        recent = F.col("year") * 100 + F.col("month") >= first
        months = _months(rows.filter(recent))
        try:
            months |= _months(files.gold(rows.sparkSession, path).filter(recent))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    replace_months(gold.hourly(rows.filter(_in_months(months))), path, months)


def run_daily(
    spark: SparkSession,
    bronze: DataFrame,
    silver_path: str,
    gold_path: str,
    serving: dict | None = None,
    silver_format: str = "json",
    incremental: bool = False,
) -> bool:
    """Each step starts after the one before it has been written; a rerun overwrites.

    ``incremental`` takes ``bronze`` as what has arrived lately (see
    :func:`plantlake.sources.files.bronze_sensors`), merges it into Silver
    partitioned by month and recomputes the months it touches. What has begun
    is noted in a ledger beside Silver: after a failure at any step the next
    run ends it first, so the layers become those of runs that never failed.
    ``serving`` holds ``url`` and ``properties`` of the relational target.
    """
    pin_utc(spark)
    if incremental:
        ledger = RunLedger(spark, f"{silver_path.rstrip('/')}_runs")
        months = resume_silver(spark, silver_path, ledger)
        months |= update_silver(bronze, silver_path, silver_format, ledger)
        if not months:
            return False
        rows = files.silver(spark, silver_path, silver_format)
        silver_to_gold(rows, gold_path, months=months)
        ledger.note("done", months)
    else:
        if not bronze_to_silver(bronze, silver_path, fmt=silver_format):
            return False
        silver_to_gold(files.silver(spark, silver_path, silver_format), gold_path)
    if serving:
        serve_gold(files.gold(spark, gold_path), **serving)
    return True
