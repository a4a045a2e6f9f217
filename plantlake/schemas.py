"""Column layouts and value domains of the feeds and layers.

Layouts are DDL strings, as taken by ``spark.read.schema`` and ``from_json``.
"""

from __future__ import annotations

# --- layouts ----------------------------------------------------------------

#: A sensor reading as decoded by the alert stream (no device metadata).
STREAM_EVENT = """
    event_id string, sensor_id string, equipment_id string, factory_id string,
    measurement_type string, value double, unit string, timestamp string,
    quality string, is_anomaly boolean
"""

#: A sensor reading as stored in Bronze.
SENSOR_EVENT = STREAM_EVENT + """,
    metadata struct<firmware_version: string, battery_level: bigint, signal_strength: bigint>
"""

SILVER = """
    event_id string, sensor_id string, equipment_id string, factory_id string,
    measurement_type string, value double, unit string, timestamp timestamp,
    quality string, is_anomaly boolean, firmware_version string,
    battery_level int, signal_strength int, year int, month int, day int
"""

GOLD = """
    equipment_id string, factory_id string, measurement_type string,
    timestamp_hour timestamp, year int, month int, day int, hour int,
    avg_value double, min_value double, max_value double, std_value double,
    event_count bigint, anomaly_count bigint, anomaly_rate double,
    criticality_score double
"""

ALERT = """
    window struct<start: timestamp, end: timestamp>, factory_id string,
    equipment_id string, measurement_type string, event_count bigint,
    anomaly_count bigint, avg_value double, anomaly_rate double,
    alert_level string
"""

#: ERP events as landed: dates as text, cost as double, tagged with the source.
ERP = """
    source string, id bigint, equipment_id string, factory_id string,
    event_type string, description string, technician string, cost double,
    event_date string, created_at string
"""

MAINTENANCE = """
    id string, equipment_id string, factory_id string, maintenance_type string,
    status string, scheduled_date date, technician string,
    estimated_duration_hours double
"""

FACTORY = """
    _id string, name string, location struct<lat: double, lng: double>,
    address string, active boolean
"""

EQUIPMENT = """
    _id string, name string, type string, factory_id string,
    factory struct<id: string, name: string, location: struct<lat: double, lng: double>>,
    sensors array<struct<id: string, type: string, unit: string,
        range: struct<min: double, max: double>,
        normal_range: struct<min: double, max: double>, active: boolean>>,
    maintenance struct<schedule: string, last_maintenance: string, next_maintenance: string>,
    installed_at string, status string
"""

# --- fixed values: domains, ranges and thresholds of the data model ----------

MEASUREMENTS = ["temperature", "humidity", "pressure", "vibration", "current"]
QUALITIES = ["good", "warning", "bad"]
FACTORIES = ["FAB-SP-01", "FAB-RJ-01", "FAB-MG-01"]
EQUIPMENT_TYPES = ["compressor", "pump", "motor", "conveyor", "turbine"]
EQUIPMENT_STATUS = ["active", "inactive", "maintenance"]

#: Keys every raw event carries (quality rule) / the event contract demands.
REQUIRED_KEYS = [
    "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type",
    "value", "timestamp", "quality", "is_anomaly",
]
CONTRACT_KEYS = [
    "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type",
    "value", "unit", "timestamp", "quality", "is_anomaly",
]

UNITS = {
    "temperature": "celsius", "humidity": "percent", "pressure": "bar",
    "vibration": "mm/s", "current": "ampere",
}
PHYSICAL_RANGE = {
    "temperature": (0, 150), "humidity": (0, 100), "pressure": (0, 20),
    "vibration": (0, 50), "current": (0, 100),
}
NORMAL_RANGE = {
    "temperature": (30, 70), "humidity": (40, 60), "pressure": (5, 15),
    "vibration": (0, 10), "current": (10, 50),
}
SCHEDULE_DAYS = {"weekly": 7, "monthly": 30, "quarterly": 90, "semiannual": 180}

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
MAX_DUPLICATE_RATE = 0.01
WARNING_RATE, CRITICAL_RATE = 0.1, 0.3
RATE_WEIGHT, VARIATION_WEIGHT = 0.6, 0.4
ALERT_WINDOW, ALERT_DELAY, ALERT_TRIGGER = "5 minutes", "10 minutes", "1 minute"
MAX_SENSORS = 50
RETENTION_MONTHS = 24
SENSOR_TOPIC = "iot-sensors"
SERVING_TABLE = "gold_equipment_metrics"

#: Periods that a landing folder may cover.
GRAINS = ["day", "week", "month", "quarter", "year"]

#: ISO-8601 text: a full date, for readings with a time of day and perhaps a zone.
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
ISO_CLOCK = r"[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s?(Z|[+-]\d{2}(:?\d{2})?)?"
