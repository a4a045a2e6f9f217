"""Data-quality rules, evaluated in one aggregation pass.

Rules on raw events look at the JSON text itself, because a schema would turn a
wrongly typed field into a null and hide the fault.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.functions.scalars import lookup


@dataclass(frozen=True)
class Rule:
    """``ok`` must be true wherever ``applies`` is; null counts as failed."""

    name: str
    ok: Column
    applies: Column | None = None

    def relevant(self) -> Column:
        return F.lit(True) if self.applies is None else F.coalesce(self.applies, F.lit(False))

    def broken(self) -> Column:
        return self.relevant() & ~F.coalesce(self.ok, F.lit(False))


def report(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, checked, failed, passed) for every rule, from one pass over ``rows``."""
    counts = []
    for i, rule in enumerate(rules):
        counts += [
            F.count_if(rule.relevant()).alias(f"checked_{i}"),
            F.count_if(rule.broken()).alias(f"failed_{i}"),
        ]
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"checked_{i}").alias("checked"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col(f"failed_{i}") == 0).alias("passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return rows.agg(*counts).select(F.inline(F.array(*lines)))


def violations(rows: DataFrame, rules: list[Rule], *keep: str) -> DataFrame:
    """One row per broken rule and record, with the ``keep`` columns."""
    names = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    return rows.select(*keep, F.explode(names).alias("rule"))


# --- raw events --------------------------------------------------------------


TEXT_KEYS = ["event_id", "factory_id", "measurement_type", "timestamp", "quality"]
NUMBER_KEYS = ["value", "battery_level", "signal_strength"]
DEVICE_KEYS = ["battery_level", "signal_strength"]

#: Every field as a variant: one parse per line keeps the JSON types apart.
ANY_TYPES = (
    ", ".join(f"{key} variant" for key in schemas.CONTRACT_KEYS)
    + ", metadata struct<"
    + ", ".join(f"{key}: variant" for key in DEVICE_KEYS)
    + ">"
)


def inspect(messages: DataFrame) -> DataFrame:
    """Per key its JSON type (null if the key is absent), and the values the rules read."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), ANY_TYPES).alias("d"))
    fields = parsed.select("d.*").select(*schemas.CONTRACT_KEYS, "metadata.*")
    return fields.select(
        *[F.schema_of_variant(k).alias(f"{k}_type") for k in schemas.CONTRACT_KEYS + DEVICE_KEYS],
        *[F.try_variant_get(k, "$", "string").alias(k) for k in TEXT_KEYS],
        *[F.try_variant_get(k, "$", "double").alias(k) for k in NUMBER_KEYS],
    )


def missing_keys(messages: DataFrame, required: list[str] = schemas.REQUIRED_KEYS) -> DataFrame:
    """Lines that lack a required key, with the missing keys; a null value is present."""
    wanted = F.array(*[F.lit(k) for k in required])
    present = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    return messages.select(
        "value", F.array_except(wanted, present).alias("missing")
    ).filter(F.size("missing") > 0)


def _is_text(key: str) -> Column:
    return F.col(f"{key}_type") == "STRING"


def _is_number(key: str) -> Column:
    kind = F.col(f"{key}_type")
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _is_whole(key: str) -> Column:
    return _is_number(key) & (F.col(key) == F.floor(key))


def _one_of(key: str, domain: list[str]) -> Column:
    return _is_text(key) & F.col(key).isin(*domain)


def _known_key(key: str) -> Column:
    return F.col(f"{key}_type").isNotNull()


def event_rules(factories: list[str] = schemas.FACTORIES) -> list[Rule]:
    """The rules of the raw-event checks, for :func:`inspect` rows."""
    low = lookup(F.col("measurement_type"), {k: v[0] for k, v in schemas.PHYSICAL_RANGE.items()})
    high = lookup(F.col("measurement_type"), {k: v[1] for k, v in schemas.PHYSICAL_RANGE.items()})
    present = F.lit(True)
    for key in schemas.REQUIRED_KEYS:
        present = present & _known_key(key)
    return [
        Rule("required_fields", present),
        Rule("measurement_type", _one_of("measurement_type", schemas.MEASUREMENTS)),
        Rule("quality", _one_of("quality", schemas.QUALITIES)),
        Rule("factory_known", _one_of("factory_id", factories)),
        Rule(
            "physical_range",
            _is_number("value") & F.col("value").between(low, high),
            applies=F.col("measurement_type").isin(*schemas.MEASUREMENTS),
        ),
        Rule("is_anomaly_boolean", F.col("is_anomaly_type") == "BOOLEAN"),
        Rule("value_numeric", _is_number("value")),
        Rule("timestamp_text", _is_text("timestamp") & (F.length("timestamp") > 0)),
        Rule("event_id_uuid", _is_text("event_id") & F.col("event_id").rlike(schemas.UUID_PATTERN)),
    ]


def contract_rules() -> list[Rule]:
    """The declared event contract: required keys, then each key where present."""
    rules = [Rule(f"required:{k}", _known_key(k)) for k in schemas.CONTRACT_KEYS]
    checks = {
        "event_id": _is_text("event_id") & F.col("event_id").rlike("(?i)" + schemas.UUID_PATTERN),
        "sensor_id": _is_text("sensor_id"),
        "equipment_id": _is_text("equipment_id"),
        "factory_id": _is_text("factory_id"),
        "measurement_type": _one_of("measurement_type", schemas.MEASUREMENTS),
        "value": _is_number("value"),
        "unit": _is_text("unit"),
        "timestamp": _is_text("timestamp")
        & F.col("timestamp").rlike(f"^{schemas.ISO_DATE}{schemas.ISO_CLOCK}$")
        & F.try_to_timestamp("timestamp").isNotNull(),
        "quality": _one_of("quality", schemas.QUALITIES),
        "is_anomaly": F.col("is_anomaly_type") == "BOOLEAN",
        "battery_level": _is_whole("battery_level")
        & F.col("battery_level").between(0, 100),
        "signal_strength": _is_whole("signal_strength"),
    }
    return rules + [Rule(f"valid:{k}", ok, applies=_known_key(k)) for k, ok in checks.items()]


def json_types(messages: DataFrame) -> DataFrame:
    """How often ``is_anomaly`` and ``value`` come with which kind of JSON value."""
    def kind(key: str) -> Column:
        column = F.col(f"{key}_type")
        return (
            F.when(column.isNull(), "absent")
            .when(column == "VOID", "null")
            .when(_is_number(key), "number")
            .when(column == "STRING", "string")
            .when(column == "BOOLEAN", "boolean")
            .otherwise("other")
        )

    return (
        inspect(messages)
        .groupBy(kind("is_anomaly").alias("is_anomaly_kind"), kind("value").alias("value_kind"))
        .agg(F.count("*").alias("events"))
    )


def duplicate_rate(events: DataFrame, limit: float = schemas.MAX_DUPLICATE_RATE) -> DataFrame:
    """Share of repeated ids. Nothing to check is no failure (the rate is null).

    A missing id counts as one more distinct id, as in a set of the ids.
    """
    per_id = events.groupBy("event_id").agg(F.count("*").alias("n"))
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
    rate = F.try_divide(F.col("duplicates").cast("double"), F.col("checked").cast("double"))
    return totals.withColumn("duplicate_rate", rate).withColumn(
        "passed", F.coalesce(rate < limit, F.lit(True))
    )


def gate(messages: DataFrame, limit: float = schemas.MAX_DUPLICATE_RATE) -> DataFrame:
    """Every rule of the raw events and the duplicate rate, from one read of the lines.

    Lines are counted per event id first, with the faults of its lines, so the
    duplicate rate needs no second pass and a hot id is one row per task.
    """
    rules = event_rules()
    checks = [F.count_if(r.relevant()).alias(f"checked_{i}") for i, r in enumerate(rules)]
    faults = [F.count_if(r.broken()).alias(f"failed_{i}") for i, r in enumerate(rules)]
    per_id = inspect(messages).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), *checks, *faults)
    sums = [F.sum(c) for c in per_id.columns[1:]]
    names = per_id.columns[1:]
    totals = per_id.agg(
        *[F.coalesce(s, F.lit(0)).alias(c) for s, c in zip(sums, names, strict=True)],
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"),
    )

    def line(name: str, checked: Column, failed: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), checked.alias("checked"), failed.alias("failed"), passed.alias("passed")
        )

    rate = F.try_divide(F.col("repeats").cast("double"), F.col("n").cast("double"))
    lines = [
        line(r.name, F.col(f"checked_{i}"), F.col(f"failed_{i}"), F.col(f"failed_{i}") == 0)
        for i, r in enumerate(rules)
    ]
    lines.append(line("duplicate_rate", F.col("n"), F.col("repeats"), F.coalesce(rate < limit, F.lit(True))))
    return totals.select(F.inline(F.array(*lines)))


# --- layers and registry -----------------------------------------------------


def silver_guarantees(silver: DataFrame) -> DataFrame:
    """What Silver promises: unique ids, no nulls in the essential columns."""
    per_id = silver.groupBy("event_id").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in ("sensor_id", "value", "timestamp")],
    )
    essential = ["event_id", "sensor_id", "value", "timestamp"]
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("unique_event_id"),
        F.coalesce(F.sum(F.when(F.col("event_id").isNull(), F.col("n"))), F.lit(0)).alias("null_event_id"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"null_{c}") for c in essential[1:]],
    )
    faults = ["unique_event_id", *[f"null_{c}" for c in essential]]
    lines = [
        F.struct(
            F.lit(f).alias("rule"),
            "checked",
            F.col(f).alias("failed"),
            (F.col(f) == 0).alias("passed"),
        )
        for f in faults
    ]
    return totals.select(F.inline(F.array(*lines)))


def _given(*columns: str) -> Column:
    ok = F.lit(True)
    for column in columns:
        ok = ok & F.col(column).isNotNull()
    return ok


def equipment_rules() -> list[Rule]:
    """The contract of an equipment document."""
    required = ["_id", "name", "type", "factory_id", "factory", "sensors", "status", "installed_at"]
    each_sensor = F.forall(
        "sensors",
        lambda s: s["id"].isNotNull() & s["type"].isNotNull()
        & s["unit"].isNotNull() & s["range"].isNotNull(),
    )
    return [
        Rule("required", _given(*required)),
        Rule("type", F.col("type").isin(*schemas.EQUIPMENT_TYPES), F.col("type").isNotNull()),
        Rule("status", F.col("status").isin(*schemas.EQUIPMENT_STATUS), F.col("status").isNotNull()),
        Rule(
            "sensor_count",
            F.size("sensors").between(1, schemas.MAX_SENSORS),
            F.col("sensors").isNotNull(),
        ),
        Rule("sensor_fields", each_sensor, F.col("sensors").isNotNull()),
        Rule(
            "factory_fields",
            _given("factory.id", "factory.name", "factory.location"),
            F.col("factory").isNotNull(),
        ),
    ]


def factory_rules() -> list[Rule]:
    """The contract of a factory document (types come from its layout)."""
    return [
        Rule("required", _given("_id", "name", "location", "active")),
        Rule("location", _given("location.lat", "location.lng"), F.col("location").isNotNull()),
    ]


def obeys(rules: list[Rule]) -> Column:
    """True for a record that breaks none of the rules."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & ~rule.broken()
    return ok
