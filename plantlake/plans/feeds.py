"""The lakehouse's feeds, derived row by row from the given tables.

Readings come from ``events``, ERP records from ``orders``, maintenance records
from ``lineitem``, equipment from ``customer`` and factories from ``supplier``,
so every feed grows with its table. Fixed arithmetic on the keys adds the dirt a
real feed has: blanks, wrong case, nulls, bad times, wrong JSON types, broken
lines and exact duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.functions.records import as_json
from plantlake.functions.scalars import (
    display_name,
    equipment_code,
    iso_text,
    lookup,
    next_due,
    padded,
    round_robin,
    sensor_code,
)

# --- fixed values of the derivation ------------------------------------------

MEASUREMENT_OF = {
    "click": "temperature", "error": "vibration", "purchase": "current",
    "signup": "humidity", "view": "pressure",
}
SENSOR_ORDER = ["temperature", "vibration", "current", "humidity", "pressure"]
TYPE_OF = {
    "AUTOMOBILE": "compressor", "BUILDING": "pump", "FURNITURE": "motor",
    "HOUSEHOLD": "conveyor", "MACHINERY": "turbine",
}
STATES = ["SP", "RJ", "MG"]
ERP_TYPES = ["preventive_maintenance", "corrective_maintenance", "inspection", "replacement"]
ORDER_TYPES = ["preventive", "corrective", "inspection"]
ORDER_STATUS = ["scheduled", "in_progress", "completed", "cancelled"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream (a glob also matches a single file)."""
    layout = table(spark, sf_dir, name).schema
    return spark.readStream.schema(layout).parquet(f"{sf_dir}/{name}*.parquet")


def every(number: str, step: int) -> Column:
    return F.col(number) % step == 0


# --- sensor readings ---------------------------------------------------------


#: Faults by reading number ``n``; everything else passes unchanged.
WIRE_RULES = {
    "event_id": "CASE WHEN n % 113 = 0 THEN NULL WHEN n % 127 = 0 THEN upper(uid) ELSE uid END",
    "sensor_id": """CASE WHEN n % 83 = 0 THEN NULL WHEN n % 131 = 0 THEN '  '
        WHEN n % 11 = 0 THEN concat(' ', sensor, ' ') ELSE sensor END""",
    "equipment_id": "CASE WHEN n % 13 = 0 THEN concat(equipment, ' ') ELSE equipment END",
    "factory_id": """CASE WHEN n % 107 = 0 THEN NULL WHEN n % 103 = 0 THEN 'FAB-XX-99'
        ELSE factory END""",
    "measurement_type": "CASE WHEN n % 7 = 0 THEN concat(' ', upper(kind), ' ') ELSE kind END",
    "value": "CASE WHEN n % 97 != 0 THEN v END",
    "unit": "CASE WHEN n % 17 = 0 THEN upper(unit) ELSE unit END",
    "timestamp": """CASE WHEN n % 89 = 0 THEN 'not-a-time' WHEN n % 167 = 0 THEN '12:30'
        WHEN n % 173 = 0 THEN '2024' WHEN n % 179 = 0 THEN 'T01' ELSE iso END""",
    "quality": "CASE WHEN n % 19 = 0 THEN upper(grade) ELSE grade END",
    "is_anomaly": "CASE WHEN n % 101 != 0 THEN k < 5 + 10 * (i % 4) END",
    "metadata": """CASE WHEN n % 137 != 0 THEN named_struct(
        'firmware_version', concat('1.', k % 10, '.0'),
        'battery_level', CASE WHEN n % 109 = 0 THEN 3000000000L ELSE cast(20 + k % 81 AS bigint) END,
        'signal_strength', cast(-30 - k % 61 AS bigint)) END""",
}

#: Fields a decoder loses: broken lines, and values sent with the wrong JSON type.
LOST_WHEN = {
    "value": "n % 139 = 0",
    "is_anomaly": "n % 149 = 0 AND n % 139 != 0",
    "quality": "n % 151 = 0 AND n % 139 != 0 AND n % 149 != 0",
}


def _numbered(events: DataFrame) -> DataFrame:
    """Readings with their faults and their number ``n``; some appear twice."""
    kind = lookup(F.col("event_type"), MEASUREMENT_OF)
    numbers = events.select(
        F.col("event_id").alias("n"),
        F.expr("user_id div 10 + 1").alias("i"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        kind.alias("kind"),
        F.col("value").alias("v0"),
        F.col("ts").cast("timestamp").alias("sent"),
        F.expr("explode(sequence(1, CASE WHEN event_id % 200 = 0 THEN 2 ELSE 1 END))").alias("copy"),
    )
    # some second copies tell another time and value
    moved = """sent + make_dt_interval(CASE WHEN copy = 2 AND n % 800 = 0 THEN -1 ELSE 0 END,
        CASE WHEN copy = 2 AND n % 800 = 400 THEN 1 ELSE 0 END)"""
    numbers = numbers.select(
        "n", "i", "k", "kind",
        F.expr("v0 + CASE WHEN copy = 2 AND n % 400 = 0 THEN 1 ELSE 0 END").alias("v"),
        iso_text(F.expr(moved)).alias("iso"),
    )
    place = F.array_position(F.array(*[F.lit(m) for m in SENSOR_ORDER]), F.col("kind"))
    clean = numbers.select(
        "*",
        F.format_string("%08x-0000-4000-8000-%012x", "n", "n").alias("uid"),
        sensor_code((F.col("i") - 1) * 5 + place).alias("sensor"),
        equipment_code(F.col("i")).alias("equipment"),
        round_robin(F.col("i"), schemas.FACTORIES).alias("factory"),
        lookup(F.col("kind"), schemas.UNITS).alias("unit"),
        F.expr("CASE WHEN k % 6 < 4 THEN 'good' WHEN k % 6 = 4 THEN 'warning' ELSE 'bad' END").alias("grade"),
    )
    return clean.selectExpr("n", *[f"{rule} AS {name}" for name, rule in WIRE_RULES.items()])


def sensor_lines(events: DataFrame) -> DataFrame:
    """Readings as JSON text, as they come off the wire."""
    rows = _numbered(events).withColumn("line", as_json(*WIRE_RULES))
    return rows.selectExpr(
        """CASE
        WHEN n % 157 = 0 THEN substring(line, 1, 40)
        WHEN n % 139 = 0 THEN coalesce(
            replace(line, concat('"value":', value), concat('"value":"', value, '"')), line)
        WHEN n % 149 = 0 THEN coalesce(
            replace(line, concat('"is_anomaly":', is_anomaly), concat('"is_anomaly":"', is_anomaly, '"')),
            line)
        WHEN n % 151 = 0 THEN replace(line, concat('"quality":"', quality, '",'), '')
        ELSE line END AS value"""
    )


def sensor_events(events: DataFrame) -> DataFrame:
    """The same readings already decoded, without the detour over text."""
    return _numbered(events).selectExpr(
        *[
            f"CASE WHEN n % 157 != 0 AND NOT ({LOST_WHEN.get(name, 'false')}) THEN {name} END AS {name}"
            for name in WIRE_RULES
        ]
    )


# --- ERP and maintenance -----------------------------------------------------


def _choice(number: Column, options: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


def erp_table(orders: DataFrame) -> DataFrame:
    """The relational ERP table; its factory rule differs from the registry's on purpose."""
    i = F.col("o_custkey") + 1
    cost = F.col("o_totalprice").cast("decimal(10,2)")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        equipment_code(i).alias("equipment_id"),
        _choice(i, schemas.FACTORIES).alias("factory_id"),
        _choice(F.col("o_orderkey"), ERP_TYPES).alias("event_type"),
        F.concat(F.lit("Service of "), equipment_code(i)).alias("description"),
        F.concat(F.lit("Tech-"), padded(F.col("o_orderkey") % 10 + 1, 2)).alias("technician"),
        F.when(every("o_orderkey", 77), None)
        .when(every("o_orderkey", 50), F.lit(0).cast("decimal(10,2)"))
        .otherwise(cost)
        .alias("cost"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        (
            F.col("o_orderdate").cast("timestamp")
            + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
        ).alias("created_at"),
    )


def maintenance_records(lineitem: DataFrame) -> DataFrame:
    """Maintenance records with several snapshots per id, each with its landing time."""
    i = F.col("l_suppkey") + 1
    return lineitem.select(
        F.concat(F.lit("MNT-"), padded(F.col("l_orderkey"), 5)).alias("id"),
        equipment_code(i).alias("equipment_id"),
        round_robin(i, schemas.FACTORIES).alias("factory_id"),
        _choice(F.col("l_partkey"), ORDER_TYPES).alias("maintenance_type"),
        _choice(F.col("l_linenumber"), ORDER_STATUS).alias("status"),
        F.col("l_shipdate").cast("date").alias("scheduled_date"),
        F.concat(F.lit("Tech-"), padded(F.col("l_suppkey") % 10 + 1, 2)).alias("technician"),
        F.round(F.col("l_quantity") / 10, 1).alias("estimated_duration_hours"),
        (
            F.col("l_shipdate").cast("timestamp")
            + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
        ).alias("landed_at"),
    )


# --- registry ----------------------------------------------------------------


def _plant_name(state: Column) -> Column:
    return F.concat(F.lit("Plant "), state)


def _grid(state: Column, origin: float, step: float) -> Column:
    """A coordinate by the state's number; unknown states have none."""
    return lookup(state, {s: origin - step * k for k, s in enumerate(STATES)})


def factories(supplier: DataFrame) -> DataFrame:
    """One factory per supplier; the first three are the factories the readings name."""
    s = F.col("s_suppkey")
    state = _choice(s, STATES)
    number = F.expr("s_suppkey div 3 + 1")
    extra = F.when(number > 1, F.concat(F.lit(" "), number.cast("string"))).otherwise("")
    shift = (number - 1).cast("double") * 0.01
    return supplier.select(
        F.format_string("FAB-%s-%02d", state, number).alias("_id"),
        F.when(s % 29 != 7, F.concat(_plant_name(state), extra)).alias("name"),
        F.struct(
            F.when(s % 13 != 5, _grid(state, -10.0, 5.0) + shift).alias("lat"),
            (_grid(state, -40.0, 2.5) + shift).alias("lng"),
        ).alias("location"),
        F.concat(F.lit("Plant road "), (s * 10).cast("string")).alias("address"),
        (F.col("s_acctbal") >= 0).alias("active"),
    )


def renamed_factories(supplier: DataFrame) -> DataFrame:
    """Factories that got a new name."""
    changed = supplier.filter(F.col("s_acctbal") > 1000)
    return factories(changed).withColumn("name", F.concat("name", F.lit(" II")))


def _sensor(i: Column, position: Column, units_known: Column, last: Column) -> Column:
    order = F.array(*[F.lit(m) for m in SENSOR_ORDER])
    kind = F.element_at(order, ((position - 1) % 5 + 1).cast("int"))

    def bounds(table: dict[str, tuple[int, int]]) -> Column:
        return F.struct(
            lookup(kind, {k: float(lo) for k, (lo, _) in table.items()}).alias("min"),
            lookup(kind, {k: float(hi) for k, (_, hi) in table.items()}).alias("max"),
        )

    return F.struct(
        sensor_code((i - 1) * 5 + position).alias("id"),
        kind.alias("type"),
        F.when(units_known, lookup(kind, schemas.UNITS)).alias("unit"),
        bounds(schemas.PHYSICAL_RANGE).alias("range"),
        bounds(schemas.NORMAL_RANGE).alias("normal_range"),
        (~((i % 5 == 0) & (position == last))).alias("active"),
    )


def equipment(customer: DataFrame) -> DataFrame:
    """One document per customer, with embedded sensors and factory."""
    c = F.col("c_custkey")
    i = c + 1
    kind = F.when(every("c_custkey", 89), "motor2").otherwise(
        lookup(F.col("c_mktsegment"), TYPE_OF)
    )
    factory = F.when(every("c_custkey", 103), "FAB-XX-99").otherwise(
        round_robin(i, schemas.FACTORIES)
    )
    state = F.substring(factory, 5, 2)
    count = (
        F.when(every("c_custkey", 101), F.lit(0))
        .when(every("c_custkey", 211), F.lit(51))
        .otherwise(2 + c % 4)
        .cast("int")
    )
    positions = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )
    installed = F.date_add(F.lit("2022-01-01").cast("date"), (i * 37 % 700).cast("int"))
    last = F.date_add(installed, (30 + c % 271).cast("int"))
    schedule = _choice(c, list(schemas.SCHEDULE_DAYS))
    return customer.select(
        equipment_code(i).alias("_id"),
        F.when(~every("c_custkey", 113), display_name(kind, i)).alias("name"),
        kind.alias("type"),
        factory.alias("factory_id"),
        F.when(
            ~every("c_custkey", 131),
            F.struct(
                factory.alias("id"),
                F.when(state.isin(*STATES), _plant_name(state)).alias("name"),
                F.struct(_grid(state, -10.0, 5.0).alias("lat"), _grid(state, -40.0, 2.5).alias("lng")).alias(
                    "location"
                ),
            ),
        ).alias("factory"),
        F.transform(
            positions,
            lambda p: _sensor(i, p, ~(every("c_custkey", 107) & (p == 1)), count),
        ).alias("sensors"),
        F.struct(
            schedule.alias("schedule"),
            last.cast("string").alias("last_maintenance"),
            next_due(last, schedule).cast("string").alias("next_maintenance"),
        ).alias("maintenance"),
        F.when(~every("c_custkey", 127), installed.cast("string")).alias("installed_at"),
        F.when(every("c_custkey", 97), "broken")
        .otherwise(_choice(c, schemas.EQUIPMENT_STATUS))
        .alias("status"),
    )


def incoming_equipment(customer: DataFrame) -> DataFrame:
    """A delivery of changed documents (customers in debt) and new ones (rich customers)."""
    changed = equipment(customer.filter(F.col("c_acctbal") < 0)).withColumn(
        "status", F.lit("maintenance")
    )
    new = equipment(customer.filter(F.col("c_acctbal") >= 9000)).withColumn(
        "_id", F.concat(F.lit("NEW-"), "_id")
    )
    return changed.unionByName(new)
