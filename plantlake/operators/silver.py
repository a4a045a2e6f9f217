"""Bronze readings → typed, tidy, deduplicated Silver rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.functions.scalars import event_time, narrow_int, tidy, tidy_lower


def sensor_rows(bronze: DataFrame) -> DataFrame:
    """Drop records of other feeds: they have no ``sensor_id`` at all.

    A blank id is still an id here; it is tidied later.
    """
    return bronze.filter(F.col("sensor_id").isNotNull())


def flatten(events: DataFrame) -> DataFrame:
    """Device metadata as columns of their own."""
    plain = [c for c in events.columns if c != "metadata"]
    return events.select(
        *plain,
        F.col("metadata.firmware_version"),
        narrow_int(F.col("metadata.battery_level")).alias("battery_level"),
        narrow_int(F.col("metadata.signal_strength")).alias("signal_strength"),
    )


def complete(events: DataFrame) -> DataFrame:
    """Rows with an id, a value and a readable time."""
    essential = (F.col(c).isNotNull() for c in ("event_id", "value", "timestamp"))
    return events.filter(reduce(and_, essential))


def dedup(events: DataFrame, keep: str = "first") -> DataFrame:
    """One row per ``event_id``.

    ``first`` keeps the smallest row by time, then by the other columns, so
    reruns and retried tasks agree. ``any`` leaves the choice to Spark and lets
    it drop columns that are not used later. Both combine before the shuffle: a
    hot id sends one row per map task.
    """
    if keep == "any":
        return events.dropDuplicates(["event_id"])
    if keep != "first":
        raise ValueError(f"keep must be 'first' or 'any', not {keep!r}")
    rest = [c for c in events.columns if c not in ("event_id", "timestamp")]
    first = F.min(F.struct("timestamp", *rest)).alias("kept")
    return events.groupBy("event_id").agg(first).select("event_id", "kept.*").select(*events.columns)


def with_calendar(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "year": F.year("timestamp"),
            "month": F.month("timestamp"),
            "day": F.dayofmonth("timestamp"),
        }
    )


def tidy_events(events: DataFrame) -> DataFrame:
    """Real timestamps, trimmed ids, lower-case categories."""
    return events.withColumns(
        {
            "timestamp": event_time(),
            **{c: tidy(c) for c in ("sensor_id", "equipment_id", "factory_id")},
            **{c: tidy_lower(c) for c in ("measurement_type", "unit", "quality")},
        }
    )


def clean(bronze: DataFrame, keep: str = "first") -> DataFrame:
    """The whole Bronze → Silver step."""
    readings = complete(flatten(tidy_events(sensor_rows(bronze))))
    return with_calendar(dedup(readings, keep))


#: The parser puts a line here that it cannot read as a whole.
BROKEN = "_broken"
#: What a reading must have to become Silver, in the order in which faults are told.
ESSENTIAL = ["event_id", "value", "timestamp"]


def assessed(lines: DataFrame) -> DataFrame:
    """Raw lines (``value``) as tidy readings, with ``line`` and ``reasons``.

    ``reasons`` is empty for a reading that Silver takes. ``broken_line`` is a
    line that is not a JSON object; ``no_sensor_id`` a record of another feed;
    ``no_<field>`` an essential field that is absent or null, ``bad_<field>``
    one that is there but cannot be used. A null or blank line is broken.
    """
    line = F.col("value").cast("string")
    layout = f"{schemas.SENSOR_EVENT}, {BROKEN} string"
    parsed = F.from_json(line, layout, {"columnNameOfCorruptRecord": BROKEN})
    rows = lines.select(line.alias("line"), parsed.alias("event")).select("line", "event.*")
    sent = tidy_events(flatten(rows.withColumn("sent_time", F.col("timestamp"))))
    # a field of the wrong type also marks its line, but the fields around it are there
    whole = F.coalesce(*[F.col(c).cast("string") for c in ("sensor_id", "event_id", "sent_time", "factory_id", "equipment_id")])
    broken = F.coalesce(F.col("line").isNull() | (F.trim("line") == "") | (F.col(BROKEN).isNotNull() & whole.isNull()), F.lit(False))
    was_sent = {
        "event_id": F.lit(False),
        "value": F.get_json_object("line", "$.value").isNotNull(),
        "timestamp": F.col("sent_time").isNotNull(),
    }
    faults = [
        F.when(F.col(c).isNull(), F.when(was_sent[c], f"bad_{c}").otherwise(f"no_{c}")) for c in ESSENTIAL
    ]
    faults = [F.when(F.col("sensor_id").isNull(), "no_sensor_id"), *faults]
    reasons = F.when(broken, F.array(F.lit("broken_line"))).otherwise(F.array_compact(F.array(*faults)))
    return sent.withColumn("reasons", reasons).drop(BROKEN, "sent_time")


def rejected(judged: DataFrame) -> DataFrame:
    """``line`` and ``reasons`` of what Silver does not take."""
    return judged.where(F.size("reasons") > 0).select("line", "reasons")


def survivors(judged: DataFrame, keep: str = "first") -> DataFrame:
    """Silver from assessed readings; equal to :func:`clean` over the decoded lines."""
    return with_calendar(dedup(judged.where(F.size("reasons") == 0).drop("line", "reasons"), keep))
