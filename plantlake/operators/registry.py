"""Equipment registry: nested documents, lookups, joins with the readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.scalars import event_time, next_due
from plantlake.operators.bronze import latest_per_id, union_feeds
from plantlake.operators.joins import lookup_join

# --- lookups -----------------------------------------------------------------


def _has_sensor(field: str, value: str) -> Column:
    return F.exists("sensors", lambda s: s[field] == value)


def find(equipment: DataFrame, **wanted: str) -> DataFrame:
    """Documents by ``type``, ``status``, ``factory_id``, ``sensor_id``, ``sensor_type``."""
    for field, value in wanted.items():
        if field in ("sensor_id", "sensor_type"):
            matches = _has_sensor(field.removeprefix("sensor_"), value)
        else:
            matches = F.col(field) == value
        equipment = equipment.filter(matches)
    return equipment


def with_normal_max_below(equipment: DataFrame, limit: float) -> DataFrame:
    """Documents with any sensor whose normal range ends below ``limit``."""
    return equipment.filter(F.exists("sensors", lambda s: s["normal_range"]["max"] < limit))


def active_factories(factories: DataFrame) -> DataFrame:
    return factories.filter(F.col("active"))


def active_sensors(equipment: DataFrame) -> DataFrame:
    """The documents with only their active sensors."""
    return equipment.withColumn("sensors", F.filter("sensors", lambda s: s["active"]))


def sensor_total(equipment: DataFrame) -> DataFrame:
    return equipment.agg(
        F.count("*").alias("equipment"),
        F.sum(F.coalesce(F.size("sensors"), F.lit(0)).cast("bigint")).alias("sensors"),
    )


def maintenance_due(equipment: DataFrame) -> DataFrame:
    """Next maintenance date by schedule, beside the stored one."""
    last = F.col("maintenance.last_maintenance").cast("date")
    return equipment.select(
        "_id",
        F.col("maintenance.schedule").alias("schedule"),
        last.alias("last_maintenance"),
        next_due(last, F.col("maintenance.schedule")).alias("next_maintenance"),
    )


# --- factories inside equipment ----------------------------------------------


def denormalize(equipment: DataFrame, factories: DataFrame, how: str = "inner") -> DataFrame:
    """Embed id, name and location of each document's factory.

    ``how`` "left" keeps documents whose factory is unknown, with none embedded.
    """
    embedded = F.struct(F.col("_id").alias("id"), "name", "location").alias("factory")
    table = factories.select(F.col("_id").alias("factory_id"), embedded)
    return lookup_join(equipment.drop("factory"), table, ["factory_id"], how)


def assessed(equipment: DataFrame, factories: DataFrame, rules: list) -> DataFrame:
    """Documents with their factory embedded and ``reasons``: why each one is refused.

    ``unknown_factory``, or the names of the rules it breaks; empty for a
    document that is accepted. No document is left out.
    """
    known = denormalize(equipment, factories, "left")
    unmatched = F.col("factory").isNull()
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    reasons = F.when(unmatched, F.array(F.lit("unknown_factory"))).otherwise(broken)
    return known.withColumn("reasons", reasons)


def refresh_factory_names(equipment: DataFrame, changed: DataFrame) -> DataFrame:
    """Carry changed factory names into every embedded copy."""
    table = changed.select(F.col("_id").alias("factory_id"), F.col("name").alias("new_name"))
    name = F.coalesce("new_name", "factory.name")
    return (
        lookup_join(equipment, table, ["factory_id"], "left")
        .withColumn("factory", F.col("factory").withField("name", name))
        .select(*equipment.columns)
    )


def upsert(
    base: DataFrame,
    incoming: DataFrame,
    key: str = "_id",
    valid: Column | None = None,
    version: str | None = None,
) -> DataFrame:
    """Replace whole records by key, add new ones; running it twice changes nothing.

    ``valid`` is checked on the incoming side only: records already stored are
    left alone even if they break the contract. Of a delivery that repeats a
    key the newest record by ``version`` wins, without a version (or among
    equal ones) the largest by its other columns. Write the result to a new
    path, never over ``base``.
    """
    if valid is not None:
        incoming = incoming.filter(F.coalesce(valid, F.lit(False)))
    order = version or next(c for c in incoming.columns if c != key)
    incoming = latest_per_id(incoming, order=order, key=key)
    if version is not None:
        incoming = incoming.drop(version)
    replaced = incoming.select(key).distinct()
    return base.join(replaced, key, "left_anti").unionByName(incoming)


# --- readings against the registry -------------------------------------------


def sensor_ranges(equipment: DataFrame) -> DataFrame:
    """One row per sensor with its normal range."""
    return equipment.select(
        F.col("_id").alias("equipment_id"), F.explode("sensors").alias("sensor")
    ).select(
        "equipment_id",
        F.col("sensor.id").alias("sensor_id"),
        F.col("sensor.normal_range.min").alias("normal_min"),
        F.col("sensor.normal_range.max").alias("normal_max"),
    )


def flag_out_of_range(events: DataFrame, ranges: DataFrame, **join_options) -> DataFrame:
    """Readings with their sensor's normal range and whether they leave it.

    ``out_of_range`` is null for sensors the registry does not know. It stands
    beside the event's own ``is_anomaly``: the two may differ.
    """
    joined = lookup_join(events, ranges, ["equipment_id", "sensor_id"], "left", **join_options)
    inside = F.col("value").between(F.col("normal_min"), F.col("normal_max"))
    return joined.withColumn("out_of_range", ~inside)


def dated_ranges(snapshots: DataFrame) -> DataFrame:
    """One row per sensor: its normal ranges by ``effective_from``, oldest first, as ``versions``.

    ``snapshots`` are registry documents of several versions. Only changes are
    kept, so a row grows with a sensor's changes and not with the snapshots. A
    sensor that a snapshot leaves out keeps the range it had.
    """
    sensors = snapshots.select(
        F.col("_id").alias("equipment_id"), "effective_from", F.explode("sensors").alias("sensor")
    )
    version = F.struct(
        "effective_from",
        F.col("sensor.normal_range.min").alias("normal_min"),
        F.col("sensor.normal_range.max").alias("normal_max"),
    )
    grouped = sensors.groupBy("equipment_id", F.col("sensor.id").alias("sensor_id")).agg(
        F.array_sort(F.collect_set(version)).alias("all")
    )
    before = lambda i: F.get("all", i - 1)
    same = lambda v, i: (
        v["normal_min"].eqNullSafe(before(i)["normal_min"]) & v["normal_max"].eqNullSafe(before(i)["normal_max"])
    )
    changes = F.filter("all", lambda v, i: (i == 0) | ~same(v, i))
    return grouped.select("equipment_id", "sensor_id", changes.alias("versions"))


def flag_out_of_range_dated(events: DataFrame, versions: DataFrame, **join_options) -> DataFrame:
    """Like :func:`flag_out_of_range`, with the range that was in force at the reading's time.

    Null before a sensor's first version and for readings without a usable time.
    """
    joined = lookup_join(events, versions, ["equipment_id", "sensor_id"], "left", **join_options)
    timed = joined.withColumn("_at", event_time())
    due = F.filter("versions", lambda v: v["effective_from"] <= F.col("_at"))
    force = timed.withColumn("_range", F.try_element_at(due, F.lit(-1))).drop("versions", "_at")
    flagged = force.select("*", F.col("_range.normal_min"), F.col("_range.normal_max")).drop("_range")
    return flagged.withColumn("out_of_range", ~F.col("value").between(F.col("normal_min"), F.col("normal_max")))


def unknown_factories(events: DataFrame, factories: DataFrame) -> DataFrame:
    """Factories named by readings but missing in the registry, with their row counts.

    Counting first leaves one row per factory for the anti join, however many
    readings a factory has. A missing factory counts as unknown.
    """
    used = events.groupBy("factory_id").agg(F.count("*").alias("events"))
    known = factories.select(F.col("_id").alias("factory_id"))
    return used.join(known, "factory_id", "left_anti")


def factory_conflicts(**sources: DataFrame) -> DataFrame:
    """Equipment that the sources place in more than one factory: who says what.

    One row per equipment, source and factory, with the number of factories
    named in all. Distinct pairs come first, so a hot equipment is a few rows.
    """
    named = [
        df.select("equipment_id", "factory_id").withColumn("source", F.lit(name))
        for name, df in sources.items()
    ]
    pairs = union_feeds(*named).where("factory_id IS NOT NULL").distinct()
    totals = pairs.groupBy("equipment_id").agg(F.count_distinct("factory_id").alias("factories"))
    return pairs.join(totals.where("factories > 1"), "equipment_id")
