"""Every operator as a query over the given tables: ``(spark, sf_dir) → DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake import schemas
from plantlake.functions.records import decode_events, encode_events
from plantlake.functions.scalars import clamp, event_time, lookup
from plantlake.operators import alerts, bronze, contracts, gold, quality, registry, silver
from plantlake.plans import compaction, feeds, ingest
from plantlake.plans.daily import lines_to_silver, run_daily, update_silver
from plantlake.plans.ledger import RunLedger
from plantlake.session import fresh_path, pin_utc
from plantlake.sinks import files as sinks
from plantlake.sinks.serving import counted
from plantlake.sources import files as sources
from plantlake.streaming import alerts_job, arrivals_job, landing_job

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: One day of the ERP and maintenance feeds, and the day retention counts back from.
EXTRACT_DAY = "1998-10-03"
RETENTION_DAY = "2001-06-30"


def query(build: Query) -> Query:
    """Register under the function's name, in UTC and with comparable columns."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return comparable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, timestamps without zone, dates as text: the same in any client."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- the feeds ---------------------------------------------------------------


def _lines(spark, sf_dir):
    return feeds.sensor_lines(feeds.table(spark, sf_dir, "events"))


def _events(spark, sf_dir):
    return feeds.sensor_events(feeds.table(spark, sf_dir, "events"))


def _silver(spark, sf_dir):
    return silver.clean(_events(spark, sf_dir))


def _gold(spark, sf_dir):
    return gold.hourly(_silver(spark, sf_dir))


def _erp(spark, sf_dir):
    return feeds.erp_table(feeds.table(spark, sf_dir, "orders"))


def _maintenance(spark, sf_dir):
    return feeds.maintenance_records(feeds.table(spark, sf_dir, "lineitem"))


def _equipment(spark, sf_dir):
    return feeds.equipment(feeds.table(spark, sf_dir, "customer"))


def _factories(spark, sf_dir):
    return feeds.factories(feeds.table(spark, sf_dir, "supplier"))


def _flat_metadata(events):
    return events.select(*[c for c in events.columns if c != "metadata"], "metadata.*")


# --- events on the wire ------------------------------------------------------


@query
def event_encode(spark, sf_dir):
    return encode_events(_events(spark, sf_dir))


@query
def event_decode(spark, sf_dir):
    return _flat_metadata(decode_events(_lines(spark, sf_dir)))


@query
def event_totals(spark, sf_dir):
    return gold.event_totals(_events(spark, sf_dir))


@query
def event_sample(spark, sf_dir):
    """The first three readings by time."""
    return (
        _silver(spark, sf_dir)
        .orderBy("timestamp", "event_id")
        .limit(3)
        .select("event_id", "sensor_id", "measurement_type", "value", "timestamp")
    )


# --- Bronze ------------------------------------------------------------------


@query
def bronze_scan(spark, sf_dir):
    """A mixed tree of three feeds, read recursively as sensor rows.

    Its files are packed, a tenth of the bytes; a packed file is one task, so their rows are bounded.
    """
    root = fresh_path(spark, "mixed")
    erp, orders = bronze.erp_records(_erp(spark, sf_dir)), _maintenance(spark, sf_dir)
    landed = landing_job.landing_rows(_lines(spark, sf_dir))
    packed = {"compression": "gzip", "maxRecordsPerFile": landing_job.LARGE_FILES}
    landed.write.options(**packed).partitionBy(*landing_job.PARTITIONS).text(root)
    erp.write.options(**packed).json(f"{root}/erp")
    orders.write.options(**packed).json(f"{root}/maintenance")
    return _flat_metadata(silver.sensor_rows(sources.mixed_bronze(spark, root)))


@query
def bronze_landing(spark, sf_dir):
    """Stream → raw lines by factory and arrival date; every line comes back unchanged."""
    root = fresh_path(spark, "landing")
    stream = feeds.sensor_lines(feeds.table_stream(spark, sf_dir, "events"))
    landing_job.start_landing(
        stream, f"{root}/sensors", f"{root}/checkpoint", interval=None
    ).awaitTermination()
    return spark.read.text(f"{root}/sensors").select("value", "factory_id")


@query
def bronze_compaction(spark, sf_dir):
    """Lines landed on three days in small files, two days packed, all read from their tiers."""
    root = fresh_path(spark, "compaction")
    day = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)).cast("int")
    arrival = F.date_add(F.lit("2024-06-01").cast("date"), day).cast("timestamp")
    stream = feeds.sensor_lines(feeds.table_stream(spark, sf_dir, "events"))
    landing_job.start_landing(
        stream, f"{root}/sensors", f"{root}/checkpoint", None, landing_job.SMALL_FILES, arrival=arrival
    ).awaitTermination()
    compaction.compact(spark, f"{root}/sensors", f"{root}/packed", "2024-06-03")
    return compaction.bronze_lines(spark, f"{root}/sensors", f"{root}/packed").select("value", "factory_id")


@query
def bronze_union(spark, sf_dir):
    """The three feeds as one relation."""
    return bronze.union_feeds(
        _flat_metadata(_events(spark, sf_dir)).withColumn("feed", F.lit("sensors")),
        bronze.erp_records(_erp(spark, sf_dir)).withColumns(
            {"feed": F.lit("erp"), "id": F.col("id").cast("string")}
        ),
        _maintenance(spark, sf_dir).withColumn("feed", F.lit("maintenance")),
    )


@query
def erp_extract(spark, sf_dir):
    return bronze.erp_records(bronze.on_date(_erp(spark, sf_dir), "event_date", EXTRACT_DAY))


@query
def erp_landing(spark, sf_dir):
    """The whole table as a backfill in monthly runs."""
    path = fresh_path(spark, "erp")
    sinks.land_erp(bronze.erp_records(_erp(spark, sf_dir)), path, "month")
    return sources.erp(spark, path)


@query
def erp_ingest(spark, sf_dir):
    """One day from the table to its Bronze folder, twice: the rerun replaces."""
    path = fresh_path(spark, "erp")
    for _ in range(2):
        landed = ingest.ingest_erp(_erp(spark, sf_dir), EXTRACT_DAY, path)
    if not landed:  # a day without events leaves no folder
        return spark.createDataFrame([], sources.ERP_LANDED)
    return sources.erp(spark, path)


@query
def erp_ingest_since(spark, sf_dir):
    """Runs by high-water mark: a part of the last days becomes visible late, the last run finds nothing new."""
    path, marks = fresh_path(spark, "erp"), fresh_path(spark, "erp-marks")
    table, created = _erp(spark, sf_dir), F.col("created_at")
    late = (F.col("id") % 10 == 3) & (created >= F.lit("1997-02-10").cast("timestamp"))
    first = table.where((created < F.lit("1997-03-01").cast("timestamp")) & ~late)
    second = table.where(created < F.lit("1999-01-01").cast("timestamp"))
    for visible in (first, second, second):
        ingest.ingest_erp_since(visible, path, marks, "2100-01-01", "INTERVAL 30 DAYS", "month")
    return sources.erp(spark, path)


def _retained(spark, sf_dir, grain):
    path = fresh_path(spark, "erp")
    sinks.land_erp(bronze.erp_records(_erp(spark, sf_dir)), path, grain)
    as_of = F.lit(RETENTION_DAY).cast("date")
    kept = bronze.retained(sources.erp(spark, path), as_of, "event_date", grain)
    return kept.select("id", "equipment_id", "event_date")


@query
def bronze_retention(spark, sf_dir):
    return _retained(spark, sf_dir, "month")


@query
def bronze_retention_week(spark, sf_dir):
    """Week folders start before the month of their records."""
    return _retained(spark, sf_dir, "week")


@query
def bronze_expiry(spark, sf_dir):
    """What expiry does to every folder, and the rows left in it."""
    path = fresh_path(spark, "erp")
    sinks.land_erp(bronze.erp_records(_erp(spark, sf_dir)), path, "month")
    plan = sinks.expire(sources.erp(spark, path), path, RETENTION_DAY, "event_date", "month")
    plan = spark.createDataFrame([(n.split("=")[1], a) for n, a in plan], "run_date string, action string")
    left = sources.erp(spark, path).groupBy(F.col("run_date").cast("string").alias("run_date")).count()
    return plan.join(left, "run_date", "left").select("run_date", "action", F.coalesce("count", F.lit(0)).alias("rows_left"))


@query
def maintenance_extract(spark, sf_dir):
    day = bronze.on_date(_maintenance(spark, sf_dir), "scheduled_date", EXTRACT_DAY)
    return day.drop("landed_at")


@query
def maintenance_landing(spark, sf_dir):
    path = fresh_path(spark, "maintenance")
    sinks.land_maintenance(_maintenance(spark, sf_dir), path, "month")
    return sources.maintenance(spark, path)


@query
def maintenance_latest(spark, sf_dir):
    return bronze.latest_per_id(_maintenance(spark, sf_dir))


@query
def maintenance_fallback(spark, sf_dir):
    """The snapshot is missing, so the records come from the fallback."""
    missing = fresh_path(spark, "no-snapshot")
    return sources.read_or_else(
        lambda: sources.maintenance_snapshot(spark, missing),
        lambda: _maintenance(spark, sf_dir).drop("landed_at"),
    )


# --- Silver ------------------------------------------------------------------


@query
def silver_flatten(spark, sf_dir):
    return silver.flatten(_events(spark, sf_dir))


@query
def silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def silver_scan(spark, sf_dir):
    """Silver written as flat JSON and read back with its layout."""
    path = fresh_path(spark, "silver")
    sinks.write_silver(_silver(spark, sf_dir), path)
    return sources.silver(spark, path)


@query
def silver_explore(spark, sf_dir):
    """The same files with an inferred schema; times are parsed again."""
    path = fresh_path(spark, "silver")
    sinks.write_silver(_silver(spark, sf_dir), path, max_files=4)
    inferred = sources.explore(spark, path)
    numbers = {c: F.col(c).cast("int") for c in ("battery_level", "signal_strength", "year", "month", "day")}
    return inferred.withColumns({"timestamp": event_time(), **numbers})


@query
def silver_by_month(spark, sf_dir):
    """Silver partitioned by year, month and factory."""
    path = fresh_path(spark, "silver")
    sinks.write_silver(_silver(spark, sf_dir), path, partition_by=sinks.BY_MONTH)
    return sources.silver(spark, path)


@query
def silver_rejects(spark, sf_dir):
    """Every line that Silver does not take, with its reasons, from the reject sink."""
    path = fresh_path(spark, "silver")
    lines_to_silver(_lines(spark, sf_dir), f"{path}/silver", f"{path}/rejects")
    found = spark.read.schema("line string, reasons array<string>").json(f"{path}/rejects")
    return found.select("line", F.array_join("reasons", ",").alias("reasons"))


@query
def silver_account(spark, sf_dir):
    """What became of all lines; accepted, duplicate and rejected ones add up to those read."""
    path = fresh_path(spark, "silver")
    told = lines_to_silver(_lines(spark, sf_dir), f"{path}/silver", f"{path}/rejects")
    return spark.createDataFrame(list(told.items()), "fate string, lines long")


@query
def silver_dedup(spark, sf_dir):
    return _flat_metadata(silver.dedup(_events(spark, sf_dir)))


@query
def reading_clamp(spark, sf_dir):
    """Values moved into the normal range of their measurement."""
    kind = F.col("measurement_type")
    low = lookup(kind, {k: float(v[0]) for k, v in schemas.NORMAL_RANGE.items()})
    high = lookup(kind, {k: float(v[1]) for k, v in schemas.NORMAL_RANGE.items()})
    return _silver(spark, sf_dir).select(
        "event_id", "value", clamp(F.col("value"), low, high).alias("clamped")
    )


# --- Gold --------------------------------------------------------------------


@query
def gold_hourly(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def gold_daily(spark, sf_dir):
    return gold.score(gold.rollup(_silver(spark, sf_dir), "day"))


@query
def gold_daily_from_hourly(spark, sf_dir):
    """The same as ``gold_daily``, from hourly Gold alone."""
    return gold.coarser(_gold(spark, sf_dir), "day")


@query
def dash_factory_spread(spark, sf_dir):
    """Deviation and criticality per factory, measurement and month, from Gold."""
    return gold.spread(_gold(spark, sf_dir), "factory_id", "measurement_type", "year", "month")


@query
def criticality(spark, sf_dir):
    daily = gold.score(gold.rollup(_silver(spark, sf_dir), "day"))
    return daily.groupBy("equipment_id", "measurement_type").agg(
        F.max("criticality_score").alias("worst_score"),
        F.max("anomaly_rate").alias("worst_rate"),
        F.count("criticality_score").alias("scored_days"),
    )


@query
def top_critical(spark, sf_dir):
    columns = ["equipment_id", "factory_id", "measurement_type", "timestamp_hour", "criticality_score"]
    return gold.top_critical(_gold(spark, sf_dir), 10).select(*columns)


@query
def gold_scan(spark, sf_dir):
    path = fresh_path(spark, "gold")
    sinks.write_gold(_gold(spark, sf_dir), path)
    return sources.gold(spark, path)


@query
def gold_export_count(spark, sf_dir):
    """Rows written, counted by the pass that writes them."""
    rows, seen = counted(_gold(spark, sf_dir))
    sinks.write_gold(rows, fresh_path(spark, "gold"))
    return spark.range(1).select(F.lit(seen.get["rows"]).alias("rows"))


@query
def gold_by_factory_month(spark, sf_dir):
    """One factory and month, read from its folder only, working hours."""
    path = fresh_path(spark, "gold")
    sinks.write_gold(_gold(spark, sf_dir), path)
    return sources.gold(spark, path).filter(
        (F.col("factory_id") == "FAB-SP-01")
        & (F.col("year") == 2024)
        & (F.col("month") == 1)
        & F.col("hour").between(8, 17)
    )


def _by_total(df):
    """The sum behind a mean: it has few decimals, so all engines round it alike."""
    return df.withColumn("value_total", F.col("avg_value") * F.col("event_count")).drop("avg_value")


@query
def dash_factory(spark, sf_dir):
    totals = gold.regroup(_gold(spark, sf_dir), "factory_id", "year", "month")
    return _by_total(totals)


@query
def dash_metric_trend(spark, sf_dir):
    totals = gold.regroup(_gold(spark, sf_dir), "measurement_type", "year", "month", "day")
    return _by_total(totals)


def _money(df, *columns):
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query
def dash_event_type(spark, sf_dir):
    totals = gold.event_type_totals(bronze.erp_records(_erp(spark, sf_dir)))
    return _money(totals, "total_cost", "avg_cost")


@query
def dash_trend(spark, sf_dir):
    return _money(gold.event_trend(_erp(spark, sf_dir)), "total_cost").withColumn(
        "total_cost", F.col("total_cost").cast("double")
    )


@query
def daily_chain(spark, sf_dir):
    """Raw lines on disk → Silver JSON → Gold Parquet → read back."""
    root = fresh_path(spark, "daily")
    landed = landing_job.landing_rows(_lines(spark, sf_dir))
    landed.write.partitionBy(*landing_job.PARTITIONS).text(f"{root}/bronze")
    run_daily(
        spark, sources.bronze_sensors(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/gold"
    )
    return sources.gold(spark, f"{root}/gold")


def _three_arrivals(spark, sf_dir):
    """Landed lines of three arrival days, each as a read of its own, and the folder they lie in."""
    root = fresh_path(spark, "daily")
    day = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)).cast("int")
    arrival = F.date_add(F.lit("2024-06-01").cast("date"), day).cast("timestamp")
    landed = landing_job.landing_rows(_lines(spark, sf_dir), arrival)
    landed.write.partitionBy(*landing_job.PARTITIONS).text(f"{root}/bronze")
    landed = sources.bronze_sensors(spark, f"{root}/bronze")
    return [landed.where(F.col("day") == k + 1) for k in range(3)], root


@query
def daily_chain_incremental(spark, sf_dir):
    """The same chain fed by three arrival days, each merged as it comes."""
    days, root = _three_arrivals(spark, sf_dir)
    for arrived in days:
        paths = f"{root}/silver", f"{root}/gold"
        run_daily(spark, arrived, *paths, silver_format="parquet", incremental=True)
    return sources.gold(spark, f"{root}/gold")


@query
def daily_chain_resumed(spark, sf_dir):
    """The same, but every run stops after Silver once before it is run again."""
    days, root = _three_arrivals(spark, sf_dir)
    for arrived in days:
        update_silver(arrived, f"{root}/silver", "parquet", RunLedger(spark, f"{root}/silver_runs"))
        paths = f"{root}/silver", f"{root}/gold"
        run_daily(spark, arrived, *paths, silver_format="parquet", incremental=True)
    return sources.gold(spark, f"{root}/gold")


# --- alerts ------------------------------------------------------------------


def _flat_window(rows):
    return rows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in rows.columns if c != "window"],
    )


def _through_stream(spark, alerts_of):
    root = fresh_path(spark, "alerts")
    alerts_job.start_file_sink(
        alerts_of, f"{root}/streaming", f"{root}/checkpoint", interval=None
    ).awaitTermination()
    return _flat_window(sources.alerts(spark, f"{root}/streaming"))


@query
def alerts_batch(spark, sf_dir):
    return _flat_window(alerts.windowed_alerts(_events(spark, sf_dir).drop("metadata")))


@query
def alerts_daily(spark, sf_dir):
    """The same alerts over windows of a day."""
    events = _events(spark, sf_dir).drop("metadata")
    return _flat_window(alerts.windowed_alerts(events, window="1 day"))


@query
def alerts_stream(spark, sf_dir):
    lines = feeds.sensor_lines(feeds.table_stream(spark, sf_dir, "events"))
    return _through_stream(spark, alerts_job.alerts_from_messages(lines))


@query
def range_alerts_stream(spark, sf_dir):
    """Alerts from the registry's ranges instead of the event's own flag."""
    lines = feeds.sensor_lines(feeds.table_stream(spark, sf_dir, "events"))
    events = decode_events(lines, schemas.STREAM_EVENT)
    ranges = registry.sensor_ranges(_equipment(spark, sf_dir))
    flagged = registry.flag_out_of_range(events, ranges)
    return _through_stream(spark, alerts.windowed_alerts(flagged, flag="out_of_range"))


def _four_triggers(spark, sf_dir, root):
    """The readings as a stream whose triggers come in no order of time, of files of bounded size."""
    lines = _lines(spark, sf_dir)
    readings = feeds.table(spark, sf_dir, "events").count()
    files = max(1, -(-readings // (4 * landing_job.LARGE_FILES)))  # of a trigger
    part = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(4 * files)).cast("int")
    lines.withColumn("part", part).repartitionById(4 * files, "part").select("value").write.text(f"{root}/topic")
    stream = spark.readStream.option("maxFilesPerTrigger", files).text(f"{root}/topic")
    return decode_events(stream, schemas.STREAM_EVENT)


def _split(events, root, **options):
    arrivals_job.start_split(
        events, f"{root}/split", f"{root}/split-checkpoint", interval=None, **options
    ).awaitTermination()


@query
def alerts_corrected(spark, sf_dir):
    """Alerts of a stream that runs out of order, and the windows of its late readings counted anew."""
    root, layout = fresh_path(spark, "arrivals"), schemas.STREAM_EVENT
    _split(_four_triggers(spark, sf_dir, root), root)
    in_time = alerts.windowed_alerts(arrivals_job.follow(spark, f"{root}/split", layout))
    alerts_job.start_file_sink(in_time, f"{root}/alerts", f"{root}/checkpoint", interval=None).awaitTermination()
    kept = [arrivals_job.arrived(spark, f"{root}/split", part, layout) for part in (arrivals_job.IN_TIME, arrivals_job.LATE)]
    return _flat_window(arrivals_job.corrected(sources.alerts(spark, f"{root}/alerts"), *kept))


@query
def range_dated_stream(spark, sf_dir):
    """Every reading of the stream, late or not, with the range in force at its time."""
    root, registry_root = fresh_path(spark, "arrivals"), fresh_path(spark, "snapshots")
    base = _equipment(spark, sf_dir)
    narrower = F.transform("sensors", lambda s: s.withField("normal_range.max", s["normal_range"]["max"] * 0.5))
    sinks.write_snapshot(base, registry_root, "2024-01-05")
    sinks.write_snapshot(base.withColumn("sensors", narrower), registry_root, "2024-01-15")

    versions = ingest.RangeVersions(registry_root)

    def flagged(rows):
        return registry.flag_out_of_range_dated(rows, versions.read(rows.sparkSession))

    _split(_four_triggers(spark, sf_dir, root), root, prepare=flagged)
    layout = schemas.STREAM_EVENT + ", normal_min double, normal_max double, out_of_range boolean"
    kept = [arrivals_job.arrived(spark, f"{root}/split", part, layout) for part in (arrivals_job.IN_TIME, arrivals_job.LATE)]
    return bronze.union_feeds(*kept).select(
        "event_id", "equipment_id", "sensor_id", "timestamp", "value", "normal_min", "normal_max", "out_of_range"
    )


# --- registry ----------------------------------------------------------------


def _flat_equipment(docs):
    return docs.select(
        F.col("_id").alias("equipment_id"),
        "name", "type", "factory_id",
        F.col("factory.id").alias("embedded_id"),
        F.col("factory.name").alias("embedded_name"),
        F.col("factory.location.lat").alias("lat"),
        F.col("factory.location.lng").alias("lng"),
        F.size("sensors").alias("sensors"),
        F.col("maintenance.schedule").alias("schedule"),
        "installed_at", "status",
    )


def _flat_sensors(docs):
    sensors = docs.select(F.col("_id").alias("equipment_id"), F.explode("sensors").alias("s"))
    return sensors.select(
        "equipment_id",
        F.col("s.id").alias("sensor_id"),
        F.col("s.type").alias("type"),
        F.col("s.unit").alias("unit"),
        F.col("s.range.min").alias("range_min"),
        F.col("s.range.max").alias("range_max"),
        F.col("s.normal_range.min").alias("normal_min"),
        F.col("s.normal_range.max").alias("normal_max"),
        F.col("s.active").alias("active"),
    )


@query
def registry_scan(spark, sf_dir):
    """Nested documents written as JSON and read back, one row per sensor."""
    path = fresh_path(spark, "registry")
    sinks.write_documents(_equipment(spark, sf_dir), path)
    return _flat_sensors(sources.equipment(spark, path))


@query
def registry_denormalize(spark, sf_dir):
    return _flat_equipment(
        registry.denormalize(_equipment(spark, sf_dir), _factories(spark, sf_dir))
    )


@query
def registry_refresh(spark, sf_dir):
    changed = feeds.renamed_factories(feeds.table(spark, sf_dir, "supplier"))
    return _flat_equipment(registry.refresh_factory_names(_equipment(spark, sf_dir), changed))


@query
def registry_upsert(spark, sf_dir):
    """A delivery of changed and new documents; only the valid ones count."""
    incoming = feeds.incoming_equipment(feeds.table(spark, sf_dir, "customer"))
    valid = quality.obeys(quality.equipment_rules())
    return _flat_equipment(registry.upsert(_equipment(spark, sf_dir), incoming, valid=valid))


@query
def registry_build(spark, sf_dir):
    """Factories embedded, contract checked, snapshot written and read back."""
    path = fresh_path(spark, "registry")
    base = _equipment(spark, sf_dir)
    incoming = feeds.incoming_equipment(feeds.table(spark, sf_dir, "customer"))
    ingest.build_registry(base, incoming, _factories(spark, sf_dir), path)
    return _flat_equipment(sources.equipment(spark, path))


@query
def registry_rejects(spark, sf_dir):
    """The delivered documents that the registry refuses, and why."""
    incoming = feeds.incoming_equipment(feeds.table(spark, sf_dir, "customer"))
    rules = quality.equipment_rules()
    assessed = registry.assessed(incoming, _factories(spark, sf_dir), rules)
    return assessed.where(F.size("reasons") > 0).select(
        F.col("_id").alias("equipment_id"), F.array_join("reasons", ",").alias("reason")
    )


@query
def registry_find(spark, sf_dir):
    """The most frequent lookup: active equipment of one factory."""
    found = registry.find(_equipment(spark, sf_dir), factory_id="FAB-SP-01", status="active")
    return _flat_equipment(found)


@query
def registry_find_type(spark, sf_dir):
    return _flat_equipment(registry.find(_equipment(spark, sf_dir), type="pump"))


@query
def registry_find_status(spark, sf_dir):
    return _flat_equipment(registry.find(_equipment(spark, sf_dir), status="maintenance"))


@query
def registry_find_sensor(spark, sf_dir):
    return _flat_equipment(registry.find(_equipment(spark, sf_dir), sensor_id="SENS-00042"))


@query
def registry_find_sensor_type(spark, sf_dir):
    return _flat_equipment(registry.find(_equipment(spark, sf_dir), sensor_type="humidity"))


@query
def registry_active_factories(spark, sf_dir):
    factories = registry.active_factories(_factories(spark, sf_dir))
    return factories.select(F.col("_id").alias("factory_id"), "name", "location.*", "address")


@query
def registry_range_find(spark, sf_dir):
    return _flat_equipment(registry.with_normal_max_below(_equipment(spark, sf_dir), 15.0))


@query
def registry_active_sensors(spark, sf_dir):
    return _flat_sensors(registry.active_sensors(_equipment(spark, sf_dir)))


@query
def registry_sensor_total(spark, sf_dir):
    return registry.sensor_total(_equipment(spark, sf_dir))


@query
def maintenance_due(spark, sf_dir):
    return registry.maintenance_due(_equipment(spark, sf_dir))


def _range_anomaly(spark, sf_dir, **join_options):
    events = _events(spark, sf_dir)
    ranges = registry.sensor_ranges(_equipment(spark, sf_dir))
    # before the dedup no key has fewer rows, and counting them needs no wide shuffle
    readings = silver.tidy_events(silver.sensor_rows(events))
    return registry.flag_out_of_range(silver.clean(events), ranges, counted=readings, **join_options).select(
        "event_id", "equipment_id", "sensor_id", "value", "is_anomaly",
        "normal_min", "normal_max", "out_of_range",
    )


@query
def range_anomaly(spark, sf_dir):
    return _range_anomaly(spark, sf_dir)


@query
def range_anomaly_large(spark, sf_dir):
    """The same as if the registry were too large to broadcast, with some hot sensors."""
    return _range_anomaly(spark, sf_dir, max_broadcast_bytes=0, hot_rows=20)


@query
def unknown_factory(spark, sf_dir):
    return registry.unknown_factories(_events(spark, sf_dir), _factories(spark, sf_dir))


@query
def factory_conflicts(spark, sf_dir):
    # distinct pairs do not care about repeats, so the readings need no dedup
    readings = silver.complete(silver.tidy_events(silver.sensor_rows(_events(spark, sf_dir))))
    return registry.factory_conflicts(
        sensors=readings,
        erp=_erp(spark, sf_dir),
        registry=_equipment(spark, sf_dir).withColumnRenamed("_id", "equipment_id"),
    )


# --- data quality ------------------------------------------------------------


@query
def dq_report(spark, sf_dir):
    return quality.report(quality.inspect(_lines(spark, sf_dir)), quality.event_rules())


@query
def dq_gate(spark, sf_dir):
    """All rules and the duplicate rate from one read."""
    return quality.gate(_lines(spark, sf_dir))


@query
def dq_violations(spark, sf_dir):
    rows = quality.inspect(_lines(spark, sf_dir))
    return quality.violations(rows, quality.event_rules(), "event_id")


@query
def dq_missing_fields(spark, sf_dir):
    missing = quality.missing_keys(_lines(spark, sf_dir))
    return missing.select("value", F.array_join("missing", ",").alias("missing"))


@query
def dq_duplicate_rate(spark, sf_dir):
    return quality.duplicate_rate(_events(spark, sf_dir))


@query
def dq_types(spark, sf_dir):
    return quality.json_types(_lines(spark, sf_dir))


@query
def dq_contract_event(spark, sf_dir):
    return quality.report(quality.inspect(_lines(spark, sf_dir)), quality.contract_rules())


def event_contract() -> dict:
    """The event contract as a JSON Schema document."""
    text, number = {"type": "string"}, {"type": "integer"}
    keys = {key: text for key in schemas.CONTRACT_KEYS}
    device = {
        "firmware_version": text,
        "battery_level": {**number, "minimum": 0, "maximum": 100},
        "signal_strength": number,
    }
    return {
        "type": "object",
        "required": schemas.CONTRACT_KEYS,
        "properties": {
            **keys,
            "event_id": {**text, "format": "uuid"},
            "measurement_type": {**text, "enum": schemas.MEASUREMENTS},
            "value": {"type": "number"},
            "timestamp": {**text, "format": "date-time"},
            "quality": {**text, "enum": schemas.QUALITIES},
            "is_anomaly": {"type": "boolean"},
            "metadata": {"type": "object", "properties": device},
        },
    }


@query
def dq_contract_compiled(spark, sf_dir):
    """The same contract, compiled from its document."""
    rules = contracts.compiled(event_contract())
    return quality.report(contracts.documents(_lines(spark, sf_dir)), rules)


@query
def dq_contract_equipment(spark, sf_dir):
    return quality.report(_equipment(spark, sf_dir), quality.equipment_rules())


@query
def dq_contract_factory(spark, sf_dir):
    return quality.report(_factories(spark, sf_dir), quality.factory_rules())


@query
def dq_silver(spark, sf_dir):
    return quality.silver_guarantees(_silver(spark, sf_dir))
