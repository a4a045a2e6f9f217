"""For every query of the catalogue, the same result in plain SQL.

The feeds are spelled out again here as common table expressions, so the SQL
shares no code with the Spark side.
"""

from __future__ import annotations

# --- sensor feed -------------------------------------------------------------

READINGS = """
num AS (
  SELECT event_id AS n, user_id // 10 + 1 AS i,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         ts + CASE WHEN copy = 2 AND event_id % 800 = 0 THEN INTERVAL (-1) DAY
                   WHEN copy = 2 AND event_id % 800 = 400 THEN INTERVAL 1 HOUR
                   ELSE INTERVAL 0 DAY END AS ts,
         value + CASE WHEN copy = 2 AND event_id % 400 = 0 THEN 1 ELSE 0 END AS v,
         CASE event_type WHEN 'click' THEN 'temperature' WHEN 'error' THEN 'vibration'
              WHEN 'purchase' THEN 'current' WHEN 'signup' THEN 'humidity'
              WHEN 'view' THEN 'pressure' END AS kind,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS mi
  FROM (SELECT *, unnest(CASE WHEN event_id % 200 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM events)),
named AS (
  SELECT *, format('{:08x}-0000-4000-8000-{:012x}', n, n) AS uid,
         printf('SENS-%05d', (i - 1) * 5 + mi) AS sensor, printf('EQ-%04d', i) AS eq,
         CASE kind WHEN 'temperature' THEN 'celsius' WHEN 'vibration' THEN 'mm/s'
              WHEN 'current' THEN 'ampere' WHEN 'humidity' THEN 'percent'
              WHEN 'pressure' THEN 'bar' END AS u,
         CASE WHEN k % 6 < 4 THEN 'good' WHEN k % 6 = 4 THEN 'warning' ELSE 'bad' END AS q
  FROM num),
base AS (
  SELECT n,
    CASE WHEN n % 113 = 0 THEN NULL WHEN n % 127 = 0 THEN upper(uid) ELSE uid END AS event_id,
    CASE WHEN n % 83 = 0 THEN NULL WHEN n % 131 = 0 THEN '  '
         WHEN n % 11 = 0 THEN ' ' || sensor || ' ' ELSE sensor END AS sensor_id,
    CASE WHEN n % 13 = 0 THEN eq || ' ' ELSE eq END AS equipment_id,
    CASE WHEN n % 107 = 0 THEN NULL WHEN n % 103 = 0 THEN 'FAB-XX-99'
         ELSE CASE (i - 1) % 3 WHEN 0 THEN 'FAB-SP-01' WHEN 1 THEN 'FAB-RJ-01'
                   ELSE 'FAB-MG-01' END END AS factory_id,
    CASE WHEN n % 7 = 0 THEN ' ' || upper(kind) || ' ' ELSE kind END AS measurement_type,
    CASE WHEN n % 97 <> 0 THEN v END AS value,
    CASE WHEN n % 17 = 0 THEN upper(u) ELSE u END AS unit,
    CASE WHEN n % 89 = 0 THEN 'not-a-time' WHEN n % 167 = 0 THEN '12:30'
         WHEN n % 173 = 0 THEN '2024' WHEN n % 179 = 0 THEN 'T01'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS "timestamp",
    CASE WHEN n % 19 = 0 THEN upper(q) ELSE q END AS quality,
    CASE WHEN n % 101 <> 0 THEN k < 5 + 10 * (i % 4) END AS is_anomaly,
    CASE WHEN n % 137 <> 0 THEN
      {'firmware_version': '1.' || CAST(k % 10 AS VARCHAR) || '.0',
       'battery_level': CASE WHEN n % 109 = 0 THEN 3000000000 ELSE CAST(20 + k % 81 AS BIGINT) END,
       'signal_strength': CAST(-30 - k % 61 AS BIGINT)} END AS metadata
  FROM named),
copies AS (SELECT * FROM base)
"""

LINES = READINGS + """,
clean_lines AS (
  SELECT n, value, is_anomaly, quality,
    CAST(to_json({'event_id': event_id, 'sensor_id': sensor_id, 'equipment_id': equipment_id,
      'factory_id': factory_id, 'measurement_type': measurement_type, 'value': value,
      'unit': unit, 'timestamp': "timestamp", 'quality': quality, 'is_anomaly': is_anomaly,
      'metadata': metadata}) AS VARCHAR) AS line,
    factory_id
  FROM copies),
lines AS (
  SELECT CASE WHEN n % 157 = 0 THEN substr(line, 1, 40)
      WHEN n % 139 = 0 AND value IS NOT NULL THEN replace(line, '"value":' || CAST(value AS VARCHAR),
                                    '"value":"' || CAST(value AS VARCHAR) || '"')
      WHEN n % 139 = 0 THEN line
      WHEN n % 149 = 0 AND is_anomaly IS NOT NULL
        THEN replace(line, '"is_anomaly":' || CAST(is_anomaly AS VARCHAR),
                     '"is_anomaly":"' || CAST(is_anomaly AS VARCHAR) || '"')
      WHEN n % 149 = 0 THEN line
      WHEN n % 151 = 0 THEN replace(line, '"quality":"' || quality || '",', '')
      ELSE line END AS value,
    CASE WHEN n % 157 = 0 OR factory_id IS NULL THEN 'unknown' ELSE factory_id END AS landed_factory
  FROM clean_lines),
docs AS (SELECT value AS line, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM lines)
"""

#: Readings after decoding: wrongly typed fields and broken lines are null.
EVENTS = READINGS + """,
ev AS (
  SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN sensor_id END AS sensor_id,
    CASE WHEN ok THEN equipment_id END AS equipment_id, CASE WHEN ok THEN factory_id END AS factory_id,
    CASE WHEN ok THEN measurement_type END AS measurement_type,
    CASE WHEN ok AND n % 139 <> 0 THEN value END AS value, CASE WHEN ok THEN unit END AS unit,
    CASE WHEN ok THEN "timestamp" END AS "timestamp",
    CASE WHEN ok AND (n % 151 <> 0 OR n % 139 = 0 OR n % 149 = 0) THEN quality END AS quality,
    CASE WHEN ok AND (n % 149 <> 0 OR n % 139 = 0) THEN is_anomaly END AS is_anomaly,
    CASE WHEN ok THEN metadata END AS metadata
  FROM (SELECT *, n % 157 <> 0 AS ok FROM copies))
"""

SILVER = EVENTS + """,
tidy AS (
  SELECT event_id, trim(sensor_id) AS sensor_id, trim(equipment_id) AS equipment_id,
    trim(factory_id) AS factory_id, lower(trim(measurement_type)) AS measurement_type, value,
    lower(trim(unit)) AS unit,
    CASE WHEN regexp_matches("timestamp", '^[0-9]{4}-[0-9]{2}-[0-9]{2}')
         THEN TRY_CAST("timestamp" AS TIMESTAMP) END AS "timestamp",
    lower(trim(quality)) AS quality, is_anomaly,
    metadata.firmware_version AS firmware_version,
    TRY_CAST(metadata.battery_level AS INTEGER) AS battery_level,
    TRY_CAST(metadata.signal_strength AS INTEGER) AS signal_strength
  FROM ev WHERE sensor_id IS NOT NULL),
sv AS (
  SELECT *, CAST(year("timestamp") AS INTEGER) AS year,
    CAST(month("timestamp") AS INTEGER) AS month, CAST(day("timestamp") AS INTEGER) AS day
  FROM tidy WHERE event_id IS NOT NULL AND value IS NOT NULL AND "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp", sensor_id, equipment_id,
    factory_id NULLS FIRST, measurement_type, value, unit, quality NULLS FIRST,
    is_anomaly NULLS FIRST) = 1)
"""


def _rollup(grain: str, source: str = "sv") -> str:
    units = ["year", "month", "day", "hour"]
    units = units[: units.index(grain) + 1]
    parts = ", ".join(f"CAST({u}(bucket) AS INTEGER) AS {u}" for u in units)
    return f"""
metrics AS (
  SELECT equipment_id, factory_id, measurement_type, date_trunc('{grain}', "timestamp") AS bucket,
    avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
    CASE WHEN count(*) > 1 THEN stddev_samp(value) END AS std_value, count(*) AS event_count,
    CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count
  FROM {source} GROUP BY ALL),
gold AS (
  SELECT equipment_id, factory_id, measurement_type, CAST(bucket AS TIMESTAMP) AS timestamp_{grain},
    {parts}, avg_value, min_value, max_value, std_value, event_count, anomaly_count,
    anomaly_count / CAST(event_count AS DOUBLE) AS anomaly_rate,
    anomaly_count / CAST(event_count AS DOUBLE) * 0.6::DOUBLE
      + std_value / nullif(avg_value, 0) * 0.4::DOUBLE AS criticality_score
  FROM metrics)
"""


HOURLY = SILVER + "," + _rollup("hour")
DAILY = SILVER + "," + _rollup("day")

GOLD_ROWS = """
  round(avg_value, 6) AS avg_value, round(min_value, 6) AS min_value,
  round(max_value, 6) AS max_value, round(std_value, 6) AS std_value, event_count, anomaly_count,
  round(anomaly_rate, 6) AS anomaly_rate, round(criticality_score, 6) AS criticality_score
"""
GOLD_KEYS = "equipment_id, factory_id, measurement_type, timestamp_hour, year, month, day, hour"


def _alerts(width: str, flag: str = "is_anomaly", source: str = "ev") -> str:
    return f"""
timed AS (
  SELECT *, CASE WHEN regexp_matches("timestamp", '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
    THEN TRY_CAST("timestamp" AS TIMESTAMP) END AS event_ts FROM {source}),
windowed AS (
  SELECT time_bucket(INTERVAL '{width}', event_ts, TIMESTAMP '1970-01-01') AS window_start,
    factory_id, equipment_id, measurement_type, count(*) AS event_count,
    CAST(sum(CAST({flag} AS INTEGER)) AS BIGINT) AS anomaly_count, avg(value) AS avg_value
  FROM timed WHERE event_ts IS NOT NULL GROUP BY ALL),
levels AS (
  SELECT window_start, window_start + INTERVAL '{width}' AS window_end, factory_id, equipment_id,
    measurement_type, event_count, anomaly_count, round(avg_value, 6) AS avg_value,
    round(anomaly_count / CAST(event_count AS DOUBLE), 6) AS anomaly_rate,
    CASE WHEN anomaly_count / CAST(event_count AS DOUBLE) >= 0.3::DOUBLE THEN 'critical'
         WHEN anomaly_count / CAST(event_count AS DOUBLE) >= 0.1::DOUBLE THEN 'warning'
         ELSE 'normal' END AS alert_level
  FROM windowed),
alerts AS (SELECT * FROM levels WHERE alert_level <> 'normal')
"""


CLOSED = """
SELECT * FROM alerts
WHERE window_end <= (SELECT max(event_ts) FROM timed) - INTERVAL '10 minutes'
"""

# --- ERP and maintenance feeds -----------------------------------------------

ERP = """
erp AS (
  SELECT o_orderkey AS id, printf('EQ-%04d', o_custkey + 1) AS equipment_id,
    CASE (o_custkey + 1) % 3 WHEN 0 THEN 'FAB-SP-01' WHEN 1 THEN 'FAB-RJ-01'
         ELSE 'FAB-MG-01' END AS factory_id,
    CASE o_orderkey % 4 WHEN 0 THEN 'preventive_maintenance' WHEN 1 THEN 'corrective_maintenance'
         WHEN 2 THEN 'inspection' ELSE 'replacement' END AS event_type,
    'Service of ' || printf('EQ-%04d', o_custkey + 1) AS description,
    printf('Tech-%02d', o_orderkey % 10 + 1) AS technician,
    CASE WHEN o_orderkey % 77 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 0.0::DOUBLE
         ELSE CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS DOUBLE) END AS cost,
    CAST(o_orderdate AS DATE) AS event_date,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created_at
  FROM orders)
"""
ERP_ROWS = """
  'erp' AS source, id, equipment_id, factory_id, event_type, description, technician,
  round(cost, 6) AS cost, strftime(event_date, '%Y-%m-%d') AS event_date,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
"""

MAINTENANCE = """
mnt AS (
  SELECT printf('MNT-%05d', l_orderkey) AS id, printf('EQ-%04d', l_suppkey + 1) AS equipment_id,
    CASE l_suppkey % 3 WHEN 0 THEN 'FAB-SP-01' WHEN 1 THEN 'FAB-RJ-01' ELSE 'FAB-MG-01' END AS factory_id,
    CASE l_partkey % 3 WHEN 0 THEN 'preventive' WHEN 1 THEN 'corrective'
         ELSE 'inspection' END AS maintenance_type,
    CASE l_linenumber % 4 WHEN 0 THEN 'scheduled' WHEN 1 THEN 'in_progress'
         WHEN 2 THEN 'completed' ELSE 'cancelled' END AS status,
    CAST(l_shipdate AS DATE) AS scheduled_date,
    printf('Tech-%02d', l_suppkey % 10 + 1) AS technician,
    round(l_quantity / 10, 1) AS estimated_duration_hours,
    l_shipdate + to_hours(l_linenumber) AS landed_at
  FROM lineitem)
"""
MAINTENANCE_COLUMNS = """
  id, equipment_id, factory_id, maintenance_type, status,
  strftime(mnt.scheduled_date, '%Y-%m-%d') AS scheduled_date, technician, estimated_duration_hours
"""

# --- registry ----------------------------------------------------------------

FACTORIES = """
fac AS (
  SELECT printf('FAB-%s-%02d', st, no) AS id,
    CASE WHEN s_suppkey % 29 <> 7 THEN
      'Plant ' || st
      || CASE WHEN no > 1 THEN ' ' || CAST(no AS VARCHAR) ELSE '' END END AS name,
    CASE WHEN s_suppkey % 13 <> 5 THEN
      CASE st WHEN 'SP' THEN -10.0::DOUBLE WHEN 'RJ' THEN -15.0::DOUBLE ELSE -20.0::DOUBLE END
      + (no - 1) * 0.01::DOUBLE END AS lat,
    CASE st WHEN 'SP' THEN -40.0::DOUBLE WHEN 'RJ' THEN -42.5::DOUBLE ELSE -45.0::DOUBLE END
      + (no - 1) * 0.01::DOUBLE AS lng,
    'Plant road ' || CAST(s_suppkey * 10 AS VARCHAR) AS address,
    s_acctbal >= 0 AS active, s_acctbal
  FROM (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' ELSE 'MG' END AS st,
               s_suppkey // 3 + 1 AS no FROM supplier))
"""

EQUIPMENT = """
eq0 AS (
  SELECT *, c_custkey + 1 AS i,
    CASE WHEN c_custkey % 89 = 0 THEN 'motor2' ELSE
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'compressor' WHEN 'BUILDING' THEN 'pump'
           WHEN 'FURNITURE' THEN 'motor' WHEN 'HOUSEHOLD' THEN 'conveyor'
           WHEN 'MACHINERY' THEN 'turbine' END END AS kind,
    CASE WHEN c_custkey % 103 = 0 THEN 'FAB-XX-99' ELSE
      CASE c_custkey % 3 WHEN 0 THEN 'FAB-SP-01' WHEN 1 THEN 'FAB-RJ-01'
           ELSE 'FAB-MG-01' END END AS fid,
    CASE WHEN c_custkey % 101 = 0 THEN 0 WHEN c_custkey % 211 = 0 THEN 51
         ELSE 2 + c_custkey % 4 END AS cnt,
    DATE '2022-01-01' + CAST((c_custkey + 1) * 37 % 700 AS INTEGER) AS installed,
    CASE c_custkey % 4 WHEN 0 THEN 'weekly' WHEN 1 THEN 'monthly' WHEN 2 THEN 'quarterly'
         ELSE 'semiannual' END AS schedule
  FROM customer),
eq AS (
  SELECT c_custkey, c_acctbal, i, printf('EQ-%04d', i) AS equipment_id,
    CASE WHEN c_custkey % 113 <> 0
         THEN upper(substr(kind, 1, 1)) || substr(kind, 2) || ' ' || CAST(i AS VARCHAR) END AS name,
    kind AS type, fid AS factory_id,
    CASE WHEN c_custkey % 131 <> 0 THEN fid END AS embedded_id,
    CASE WHEN c_custkey % 131 <> 0 THEN
      CASE WHEN substr(fid, 5, 2) IN ('SP', 'RJ', 'MG') THEN 'Plant ' || substr(fid, 5, 2) END END AS embedded_name,
    CASE WHEN c_custkey % 131 <> 0 THEN
      CASE substr(fid, 5, 2) WHEN 'SP' THEN -10.0::DOUBLE WHEN 'RJ' THEN -15.0::DOUBLE
           WHEN 'MG' THEN -20.0::DOUBLE END END AS lat,
    CASE WHEN c_custkey % 131 <> 0 THEN
      CASE substr(fid, 5, 2) WHEN 'SP' THEN -40.0::DOUBLE WHEN 'RJ' THEN -42.5::DOUBLE
           WHEN 'MG' THEN -45.0::DOUBLE END END AS lng,
    CAST(cnt AS INTEGER) AS sensors, schedule, installed + CAST(30 + c_custkey % 271 AS INTEGER) AS last_m,
    CASE WHEN c_custkey % 127 <> 0 THEN strftime(installed, '%Y-%m-%d') END AS installed_at,
    CASE WHEN c_custkey % 97 = 0 THEN 'broken' ELSE
      CASE c_custkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'maintenance' END END AS status
  FROM eq0),
pos AS (SELECT eq.*, unnest(range(1, sensors + 1)) AS p FROM eq),
sen AS (
  SELECT equipment_id, printf('SENS-%05d', (i - 1) * 5 + p) AS sensor_id, kind AS type,
    CASE WHEN c_custkey % 107 = 0 AND p = 1 THEN NULL ELSE
      CASE kind WHEN 'temperature' THEN 'celsius' WHEN 'vibration' THEN 'mm/s'
           WHEN 'current' THEN 'ampere' WHEN 'humidity' THEN 'percent' ELSE 'bar' END END AS unit,
    0.0::DOUBLE AS range_min,
    CASE kind WHEN 'temperature' THEN 150.0::DOUBLE WHEN 'vibration' THEN 50.0::DOUBLE
         WHEN 'pressure' THEN 20.0::DOUBLE ELSE 100.0::DOUBLE END AS range_max,
    CASE kind WHEN 'temperature' THEN 30.0::DOUBLE WHEN 'vibration' THEN 0.0::DOUBLE
         WHEN 'current' THEN 10.0::DOUBLE WHEN 'humidity' THEN 40.0::DOUBLE ELSE 5.0::DOUBLE END AS normal_min,
    CASE kind WHEN 'temperature' THEN 70.0::DOUBLE WHEN 'vibration' THEN 10.0::DOUBLE
         WHEN 'current' THEN 50.0::DOUBLE WHEN 'humidity' THEN 60.0::DOUBLE ELSE 15.0::DOUBLE END AS normal_max,
    NOT (i % 5 = 0 AND p = sensors) AS active
  FROM (SELECT *, CASE (p - 1) % 5 WHEN 0 THEN 'temperature' WHEN 1 THEN 'vibration'
        WHEN 2 THEN 'current' WHEN 3 THEN 'humidity' ELSE 'pressure' END AS kind
        FROM (SELECT * EXCLUDE (type) FROM pos)))
"""
EQUIPMENT_ROWS = """
  equipment_id, name, type, factory_id, embedded_id, embedded_name, round(lat, 6) AS lat,
  round(lng, 6) AS lng, sensors, schedule, installed_at, status
"""

#: Documents that break no rule of the equipment contract.
VALID_EQUIPMENT = """
  name IS NOT NULL AND embedded_id IS NOT NULL AND installed_at IS NOT NULL
  AND type <> 'motor2' AND status <> 'broken' AND sensors BETWEEN 1 AND 50
  AND embedded_name IS NOT NULL
  AND NOT (c_custkey % 107 = 0)
"""

# --- data quality ------------------------------------------------------------


def _rules(source: str, rules: list[tuple[str, str, str]]) -> str:
    """(rule, checked, failed, passed) for (name, applies, ok) triples."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) FILTER (WHERE coalesce({applies}, false)) AS checked,
        count(*) FILTER (WHERE coalesce({applies}, false) AND NOT coalesce({ok}, false)) AS failed,
        count(*) FILTER (WHERE coalesce({applies}, false) AND NOT coalesce({ok}, false)) = 0 AS passed
        FROM {source}"""
        for name, applies, ok in rules
    )


def _kind(key: str) -> str:
    return f"json_type(j, '$.{key}')"


def _text(key: str) -> str:
    return f"json_extract_string(j, '$.{key}')"


def _number(key: str) -> str:
    return f"({_kind(key)} IN ('DOUBLE', 'UBIGINT', 'BIGINT', 'HUGEINT'))"


def _string(key: str) -> str:
    return f"({_kind(key)} = 'VARCHAR')"


REQUIRED = [
    "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type",
    "value", "timestamp", "quality", "is_anomaly",
]
UUID = "'[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}'"
TYPES_IN = "IN ('temperature', 'humidity', 'pressure', 'vibration', 'current')"
UPPER_LIMIT = f"""CASE {_text('measurement_type')} WHEN 'temperature' THEN 150 WHEN 'humidity' THEN 100
  WHEN 'pressure' THEN 20 WHEN 'vibration' THEN 50 ELSE 100 END"""

EVENT_RULES = [
    ("required_fields", "true", " AND ".join(f"{_kind(k)} IS NOT NULL" for k in REQUIRED)),
    ("measurement_type", "true", f"{_string('measurement_type')} AND {_text('measurement_type')} {TYPES_IN}"),
    ("quality", "true", f"{_string('quality')} AND {_text('quality')} IN ('good', 'warning', 'bad')"),
    ("factory_known", "true",
     f"{_string('factory_id')} AND {_text('factory_id')} IN ('FAB-SP-01', 'FAB-RJ-01', 'FAB-MG-01')"),
    ("physical_range", f"{_text('measurement_type')} {TYPES_IN}",
     f"{_number('value')} AND TRY_CAST({_text('value')} AS DOUBLE) BETWEEN 0 AND {UPPER_LIMIT}"),
    ("is_anomaly_boolean", "true", f"{_kind('is_anomaly')} = 'BOOLEAN'"),
    ("value_numeric", "true", _number("value")),
    ("timestamp_text", "true", f"{_string('timestamp')} AND length({_text('timestamp')}) > 0"),
    ("event_id_uuid", "true",
     f"{_string('event_id')} AND regexp_full_match({_text('event_id')}, {UUID})"),
]
EVENT_RULES = [(n, f"({a})", f"({o})") for n, a, o in EVENT_RULES]


def _contract() -> list[tuple[str, str, str]]:
    rules = [
        (f"required:{k}", "true", f"({_kind(k)} IS NOT NULL)")
        for k in [*REQUIRED[:6], "unit", *REQUIRED[6:]]
    ]
    battery = f"TRY_CAST({_text('metadata.battery_level')} AS DOUBLE)"
    signal = f"TRY_CAST({_text('metadata.signal_strength')} AS DOUBLE)"
    checks = {
        "event_id": f"{_string('event_id')} AND regexp_full_match(lower({_text('event_id')}), {UUID})",
        "sensor_id": _string("sensor_id"),
        "equipment_id": _string("equipment_id"),
        "factory_id": _string("factory_id"),
        "measurement_type": EVENT_RULES[1][2],
        "value": _number("value"),
        "unit": _string("unit"),
        "timestamp": f"{_string('timestamp')} AND regexp_matches({_text('timestamp')}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T')"
        f" AND TRY_CAST({_text('timestamp')} AS TIMESTAMP) IS NOT NULL",
        "quality": EVENT_RULES[2][2],
        "is_anomaly": f"{_kind('is_anomaly')} = 'BOOLEAN'",
        "battery_level": f"{_number('metadata.battery_level')} AND {battery} = floor({battery})"
        f" AND {battery} BETWEEN 0 AND 100",
        "signal_strength": f"{_number('metadata.signal_strength')} AND {signal} = floor({signal})",
    }
    for key, ok in checks.items():
        path = f"metadata.{key}" if key in ("battery_level", "signal_strength") else key
        rules.append((f"valid:{key}", f"({_kind(path)} IS NOT NULL)", f"({ok})"))
    return rules


def _documented() -> list[tuple[str, str, str]]:
    """The same with names by path, and what only the document says."""
    device = ("valid:battery_level", "valid:signal_strength")
    named = [(n.replace(":", ":metadata.") if n in device else n, applies, ok) for n, applies, ok in _contract()]
    version = "metadata.firmware_version"
    return [
        *named,
        ("valid:$", "true", "json_type(j) = 'OBJECT'"),
        ("valid:metadata", f"({_kind('metadata')} IS NOT NULL)", f"({_kind('metadata')} = 'OBJECT')"),
        (f"valid:{version}", f"({_kind(version)} IS NOT NULL)", f"({_string(version)})"),
    ]


def _json_kind(key: str) -> str:
    return f"""CASE WHEN {_kind(key)} IS NULL THEN 'absent' WHEN {_kind(key)} = 'NULL' THEN 'null'
      WHEN {_number(key)} THEN 'number' WHEN {_kind(key)} = 'VARCHAR' THEN 'string'
      WHEN {_kind(key)} = 'BOOLEAN' THEN 'boolean' ELSE 'other' END"""


def _missing(key: str) -> str:
    return f"CASE WHEN {_kind(key)} IS NULL THEN '{key}' END"


#: What Silver refuses and why, from the lines themselves.
REJECTS = f"""
judged AS (
  SELECT line, {_text('event_id')} AS id, CASE WHEN j IS NULL THEN 'broken_line' ELSE concat_ws(',',
    CASE WHEN {_text('sensor_id')} IS NULL THEN 'no_sensor_id' END,
    CASE WHEN {_text('event_id')} IS NULL THEN 'no_event_id' END,
    CASE WHEN {_text('value')} IS NULL THEN 'no_value' WHEN NOT {_number('value')} THEN 'bad_value' END,
    CASE WHEN {_text('timestamp')} IS NULL THEN 'no_timestamp'
      WHEN NOT regexp_matches({_text('timestamp')}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
        OR TRY_CAST({_text('timestamp')} AS TIMESTAMP) IS NULL THEN 'bad_timestamp' END) END AS reasons
  FROM docs)
"""

EQUIPMENT_RULES = [
    ("required", "true", "(name IS NOT NULL AND type IS NOT NULL AND embedded_id IS NOT NULL"
     " AND status IS NOT NULL AND installed_at IS NOT NULL)"),
    ("type", "(type IS NOT NULL)", "(type IN ('compressor', 'pump', 'motor', 'conveyor', 'turbine'))"),
    ("status", "(status IS NOT NULL)", "(status IN ('active', 'inactive', 'maintenance'))"),
    ("sensor_count", "true", "(sensors BETWEEN 1 AND 50)"),
    ("sensor_fields", "true", "(replace(equipment_id, 'NEW-', '') NOT IN (SELECT equipment_id FROM sen WHERE unit IS NULL))"),
    ("factory_fields", "(embedded_id IS NOT NULL)", "(embedded_name IS NOT NULL)"),
]
FACTORY_RULES = [
    ("required", "true", "(name IS NOT NULL AND active IS NOT NULL)"),
    ("location", "true", "(lat IS NOT NULL AND lng IS NOT NULL)"),
]
SILVER_RULES = [
    (f"null_{c}", "true", f'("{c}" IS NOT NULL)')
    for c in ("event_id", "sensor_id", "value", "timestamp")
]

# --- the queries -------------------------------------------------------------


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


EVENT_COLUMNS = """
  event_id, sensor_id, equipment_id, factory_id, measurement_type, round(value, 6) AS value, unit,
  "timestamp", quality, is_anomaly
"""
DECODED = EVENT_COLUMNS + """,
  metadata.firmware_version AS firmware_version, metadata.battery_level AS battery_level,
  metadata.signal_strength AS signal_strength
"""

REGROUPED = """
  CAST(sum(event_count) AS BIGINT) AS event_count, CAST(sum(anomaly_count) AS BIGINT) AS anomaly_count,
  round(sum(avg_value * event_count), 6) AS value_total,
  min(min_value) AS min_value, max(max_value) AS max_value,
  round(CAST(sum(anomaly_count) AS DOUBLE) / CAST(sum(event_count) AS DOUBLE), 6) AS anomaly_rate
"""


def oracle_sql() -> dict[str, str]:
    day, cut = "DATE '1998-10-03'", "DATE '2001-06-30' - INTERVAL '24 months'"
    chained = SILVER.replace(
        "trim(factory_id) AS factory_id", "trim(coalesce(factory_id, 'unknown')) AS factory_id"
    )
    changed = f"""
new AS (
  SELECT * REPLACE ('maintenance' AS status) FROM eq WHERE c_acctbal < 0
  UNION ALL SELECT * REPLACE ('NEW-' || equipment_id AS equipment_id) FROM eq WHERE c_acctbal >= 9000),
good AS (SELECT * FROM new WHERE {VALID_EQUIPMENT})
"""
    rebuilt = changed.replace("FROM eq WHERE", "FROM located WHERE").replace("new AS (", """
located AS (
  SELECT eq.* REPLACE (fac.id AS embedded_id, fac.name AS embedded_name, fac.lat AS lat, fac.lng AS lng)
  FROM eq JOIN fac ON eq.factory_id = fac.id),
new AS (""")
    delivered = changed[: changed.index("good AS (")].replace("new AS (", "undelivered AS (")
    judged = rebuilt[: rebuilt.index("good AS (")].replace("new AS (", "judged AS (")
    refused = delivered.rstrip() + judged.strip().rstrip(",")
    flagged = """
flagged AS (
  SELECT ev.*, NOT (ev.value BETWEEN sen.normal_min AND sen.normal_max) AS out_of_range
  FROM ev LEFT JOIN sen ON ev.equipment_id = sen.equipment_id AND ev.sensor_id = sen.sensor_id)
"""
    gold_rows = f"SELECT {GOLD_KEYS}, {GOLD_ROWS} FROM gold"
    daily_rows = f"""SELECT equipment_id, factory_id, measurement_type, timestamp_day, year, month, day,
      {GOLD_ROWS} FROM gold"""
    return {
        # events on the wire
        "event_encode": _with(EVENTS, """
            SELECT equipment_id AS key, CAST(to_json({'event_id': event_id, 'sensor_id': sensor_id,
              'equipment_id': equipment_id, 'factory_id': factory_id,
              'measurement_type': measurement_type, 'value': value, 'unit': unit,
              'timestamp': "timestamp", 'quality': quality, 'is_anomaly': is_anomaly,
              'metadata': metadata}) AS VARCHAR) AS value FROM ev"""),
        "event_decode": _with(EVENTS, f"SELECT {DECODED} FROM ev"),
        "event_totals": _with(EVENTS, """
            SELECT count(*) AS event_count,
              CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
              round(sum(CAST(is_anomaly AS INTEGER)) / CAST(count(*) AS DOUBLE) * 100, 6) AS anomaly_pct
            FROM ev"""),
        "event_sample": _with(SILVER, """
            SELECT event_id, sensor_id, measurement_type, value, "timestamp" FROM sv
            ORDER BY "timestamp", event_id LIMIT 3"""),
        # Bronze
        "bronze_scan": _with(EVENTS, f"SELECT {DECODED} FROM ev WHERE sensor_id IS NOT NULL"),
        **{
            name: _with(LINES, "SELECT value, landed_factory AS factory_id FROM lines")
            for name in ("bronze_landing", "bronze_compaction")
        },
        "bronze_union": _with(EVENTS + "," + ERP + "," + MAINTENANCE, f"""
            SELECT {DECODED}, 'sensors' AS feed FROM ev
            UNION ALL BY NAME
            SELECT 'erp' AS source, CAST(id AS VARCHAR) AS id, equipment_id, factory_id, event_type, description,
              technician, cost, strftime(event_date, '%Y-%m-%d') AS event_date,
              strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, 'erp' AS feed FROM erp
            UNION ALL BY NAME
            SELECT {MAINTENANCE_COLUMNS}, landed_at, 'maintenance' AS feed FROM mnt"""),
        "erp_extract": _with(ERP, f"SELECT {ERP_ROWS} FROM erp WHERE event_date = {day}"),
        "erp_ingest": _with(ERP, f"""
            SELECT {ERP_ROWS}, strftime(erp.event_date, '%Y-%m-%d') AS run_date FROM erp
            WHERE erp.event_date = {day}"""),
        "erp_ingest_since": _with(ERP, f"""SELECT {ERP_ROWS},
            strftime(date_trunc('month', erp.event_date), '%Y-%m-%d') AS run_date FROM erp
            WHERE erp.created_at < TIMESTAMP '1999-01-01'"""),
        "erp_landing": _with(ERP, f"""SELECT {ERP_ROWS},
            strftime(date_trunc('month', erp.event_date), '%Y-%m-%d') AS run_date FROM erp"""),
        **{
            name: _with(ERP, f"""
            SELECT id, equipment_id, strftime(event_date, '%Y-%m-%d') AS event_date FROM erp
            WHERE erp.event_date >= {cut}""")
            for name in ("bronze_retention", "bronze_retention_week")
        },
        "bronze_expiry": _with(ERP, f"""
            SELECT strftime(date_trunc('month', event_date), '%Y-%m-%d') AS run_date,
              CASE WHEN date_trunc('month', event_date) >= {cut} THEN 'kept'
                   WHEN date_trunc('month', event_date) + INTERVAL 1 MONTH <= {cut} THEN 'dropped'
                   ELSE 'rewritten' END AS action,
              count(*) FILTER (event_date >= {cut}) AS rows_left
            FROM erp GROUP BY ALL"""),
        "maintenance_extract": _with(
            MAINTENANCE, f"SELECT {MAINTENANCE_COLUMNS} FROM mnt WHERE scheduled_date = {day}"),
        "maintenance_landing": _with(
            MAINTENANCE,
            f"""SELECT {MAINTENANCE_COLUMNS}, landed_at,
            strftime(date_trunc('month', mnt.scheduled_date), '%Y-%m-%d') AS run_date FROM mnt"""),
        "maintenance_latest": _with(MAINTENANCE, f"""
            SELECT {MAINTENANCE_COLUMNS}, landed_at FROM mnt
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY landed_at DESC, equipment_id DESC,
              factory_id DESC, maintenance_type DESC, status DESC, scheduled_date DESC,
              technician DESC, estimated_duration_hours DESC) = 1"""),
        "maintenance_fallback": _with(
            MAINTENANCE, f"SELECT {MAINTENANCE_COLUMNS}, 'fallback' AS source FROM mnt"),
        # Silver
        "silver_flatten": _with(EVENTS, f"""
            SELECT {EVENT_COLUMNS}, metadata.firmware_version AS firmware_version,
              TRY_CAST(metadata.battery_level AS INTEGER) AS battery_level,
              TRY_CAST(metadata.signal_strength AS INTEGER) AS signal_strength FROM ev"""),
        **{
            name: _with(SILVER, "SELECT * REPLACE (round(value, 6) AS value) FROM sv")
            for name in ("silver_clean", "silver_scan", "silver_explore", "silver_by_month")
        },
        "silver_dedup": _with(EVENTS, f"""
            SELECT {DECODED} FROM (
              SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "timestamp" NULLS FIRST,
                sensor_id NULLS FIRST, equipment_id NULLS FIRST, factory_id NULLS FIRST,
                measurement_type NULLS FIRST, value NULLS FIRST, unit NULLS FIRST,
                quality NULLS FIRST, is_anomaly NULLS FIRST) AS rn FROM ev)
            WHERE rn = 1"""),
        "reading_clamp": _with(SILVER, """
            SELECT event_id, round(value, 6) AS value, round(least(greatest(value,
                CASE measurement_type WHEN 'temperature' THEN 30 WHEN 'humidity' THEN 40
                  WHEN 'pressure' THEN 5 WHEN 'vibration' THEN 0 ELSE 10 END),
                CASE measurement_type WHEN 'temperature' THEN 70 WHEN 'humidity' THEN 60
                  WHEN 'pressure' THEN 15 WHEN 'vibration' THEN 10 ELSE 50 END), 2) AS clamped FROM sv"""),
        # Gold
        "silver_rejects": _with(LINES + "," + REJECTS, "SELECT line, reasons FROM judged WHERE reasons <> ''"),
        "silver_account": _with(LINES + "," + REJECTS + """,
            fate AS (SELECT count(*) AS seen, count(*) FILTER (reasons <> '') AS refused,
              count(DISTINCT id) FILTER (reasons = '') AS kept FROM judged)""", """
            SELECT 'read' AS fate, seen AS lines FROM fate UNION ALL
            SELECT 'accepted', kept FROM fate UNION ALL SELECT 'rejected', refused FROM fate UNION ALL
            SELECT 'duplicates', seen - kept - refused FROM fate"""),
        "gold_hourly": _with(HOURLY, gold_rows),
        "gold_daily": _with(DAILY, daily_rows),
        "gold_daily_from_hourly": _with(DAILY, daily_rows),
        "dash_factory_spread": _with(SILVER, """
            SELECT factory_id, measurement_type, year, month, round(avg(value), 6) AS avg_value,
              round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
              round(CASE WHEN count(*) > 1 THEN stddev_samp(value) END, 6) AS std_value,
              count(*) AS event_count, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
              round(sum(CAST(is_anomaly AS INTEGER)) / CAST(count(*) AS DOUBLE), 6) AS anomaly_rate,
              round(sum(CAST(is_anomaly AS INTEGER)) / CAST(count(*) AS DOUBLE) * 0.6::DOUBLE
                + CASE WHEN count(*) > 1 THEN stddev_samp(value) END / nullif(avg(value), 0) * 0.4::DOUBLE, 6)
                AS criticality_score
            FROM sv GROUP BY ALL"""),
        "criticality": _with(DAILY, """
            SELECT equipment_id, measurement_type, round(max(criticality_score), 6) AS worst_score,
              round(max(anomaly_rate), 6) AS worst_rate, count(criticality_score) AS scored_days
            FROM gold GROUP BY ALL"""),
        "top_critical": _with(HOURLY, """
            SELECT equipment_id, factory_id, measurement_type, timestamp_hour,
              round(criticality_score, 6) AS criticality_score FROM gold
            ORDER BY gold.criticality_score DESC NULLS LAST, equipment_id, factory_id,
              measurement_type, timestamp_hour LIMIT 10"""),
        "gold_scan": _with(HOURLY, gold_rows),
        "gold_export_count": _with(HOURLY, "SELECT count(*) AS rows FROM gold"),
        "gold_by_factory_month": _with(HOURLY, f"""{gold_rows}
            WHERE factory_id = 'FAB-SP-01' AND year = 2024 AND month = 1 AND hour BETWEEN 8 AND 17"""),
        "dash_factory": _with(
            HOURLY, f"SELECT factory_id, year, month, {REGROUPED} FROM gold GROUP BY ALL"),
        "dash_metric_trend": _with(
            HOURLY,
            f"SELECT measurement_type, year, month, day, {REGROUPED} FROM gold GROUP BY ALL"),
        "dash_event_type": _with(ERP, """
            SELECT event_type, count(*) AS events, round(sum(cost), 2) AS total_cost,
              round(avg(cost), 2) AS avg_cost FROM erp GROUP BY ALL"""),
        "dash_trend": _with(ERP, """
            SELECT strftime(date_trunc('month', event_date), '%Y-%m-%d') AS period, event_type,
              count(*) AS events, round(sum(cost), 2) AS total_cost FROM erp GROUP BY ALL"""),
        "daily_chain": _with(chained + "," + _rollup("hour"), gold_rows),
        "daily_chain_incremental": _with(chained + "," + _rollup("hour"), gold_rows),
        "daily_chain_resumed": _with(chained + "," + _rollup("hour"), gold_rows),
        # alerts
        "alerts_batch": _with(EVENTS + "," + _alerts("5 minutes"), "SELECT * FROM alerts"),
        "alerts_daily": _with(EVENTS + "," + _alerts("1 day"), "SELECT * FROM alerts"),
        **{
            name: _with(EVENTS + "," + _alerts("5 minutes"), CLOSED)
            for name in ("alerts_stream", "alerts_corrected")
        },
        "range_dated_stream": _with(EVENTS + "," + EQUIPMENT + "," + _alerts("5 minutes") + """,
            versions AS (
              SELECT equipment_id, sensor_id, normal_min, normal_max, TIMESTAMP '2024-01-05' AS effective_from FROM sen
              UNION ALL
              SELECT equipment_id, sensor_id, normal_min, normal_max * 0.5::DOUBLE, TIMESTAMP '2024-01-15' FROM sen)""", """
            SELECT t.event_id, t.equipment_id, t.sensor_id, t."timestamp", t.value, v.normal_min, v.normal_max,
              NOT (t.value BETWEEN v.normal_min AND v.normal_max) AS out_of_range
            FROM timed t ASOF LEFT JOIN versions v
              ON t.equipment_id = v.equipment_id AND t.sensor_id = v.sensor_id AND t.event_ts >= v.effective_from"""),
        "range_alerts_stream": _with(
            EVENTS + "," + EQUIPMENT + "," + flagged + "," + _alerts("5 minutes", "out_of_range", "flagged"),
            CLOSED),
        # registry
        "registry_scan": _with(EQUIPMENT, "SELECT * FROM sen"),
        "registry_denormalize": _with(EQUIPMENT + "," + FACTORIES, """
            SELECT equipment_id, eq.name, type, factory_id, fac.id AS embedded_id,
              fac.name AS embedded_name, round(fac.lat, 6) AS lat, round(fac.lng, 6) AS lng, sensors,
              schedule, installed_at, status FROM eq JOIN fac ON eq.factory_id = fac.id"""),
        "registry_refresh": _with(EQUIPMENT + "," + FACTORIES, """
            SELECT equipment_id, eq.name, type, factory_id, embedded_id,
              CASE WHEN embedded_id IS NOT NULL THEN coalesce(fac.name || ' II', embedded_name) END
                AS embedded_name,
              round(eq.lat, 6) AS lat, round(eq.lng, 6) AS lng, sensors, schedule, installed_at, status
            FROM eq LEFT JOIN fac ON eq.factory_id = fac.id AND fac.s_acctbal > 1000"""),
        "registry_upsert": _with(EQUIPMENT + "," + changed, f"""
            SELECT {EQUIPMENT_ROWS} FROM good
            UNION ALL SELECT {EQUIPMENT_ROWS} FROM eq
            WHERE equipment_id NOT IN (SELECT equipment_id FROM good)"""),
        "registry_build": _with(EQUIPMENT + "," + FACTORIES + "," + rebuilt, f"""
            SELECT {EQUIPMENT_ROWS} FROM good
            UNION ALL SELECT {EQUIPMENT_ROWS} FROM eq
            WHERE equipment_id NOT IN (SELECT equipment_id FROM good)"""),
        "registry_find": _with(EQUIPMENT, f"""
            SELECT {EQUIPMENT_ROWS} FROM eq WHERE factory_id = 'FAB-SP-01' AND status = 'active'"""),
        "registry_find_type": _with(EQUIPMENT, f"SELECT {EQUIPMENT_ROWS} FROM eq WHERE type = 'pump'"),
        "registry_find_status": _with(
            EQUIPMENT, f"SELECT {EQUIPMENT_ROWS} FROM eq WHERE status = 'maintenance'"),
        "registry_find_sensor": _with(EQUIPMENT, f"""
            SELECT {EQUIPMENT_ROWS} FROM eq
            WHERE equipment_id IN (SELECT equipment_id FROM sen WHERE sensor_id = 'SENS-00042')"""),
        "registry_find_sensor_type": _with(EQUIPMENT, f"""
            SELECT {EQUIPMENT_ROWS} FROM eq
            WHERE equipment_id IN (SELECT equipment_id FROM sen WHERE type = 'humidity')"""),
        "registry_active_factories": _with(FACTORIES, """
            SELECT id AS factory_id, name, round(lat, 6) AS lat, round(lng, 6) AS lng, address
            FROM fac WHERE active"""),
        "registry_range_find": _with(EQUIPMENT, f"""
            SELECT {EQUIPMENT_ROWS} FROM eq
            WHERE equipment_id IN (SELECT equipment_id FROM sen WHERE normal_max < 15)"""),
        "registry_active_sensors": _with(EQUIPMENT, "SELECT * FROM sen WHERE active"),
        "registry_sensor_total": _with(EQUIPMENT, """
            SELECT count(*) AS equipment, CAST(sum(sensors) AS BIGINT) AS sensors FROM eq"""),
        "maintenance_due": _with(EQUIPMENT, """
            SELECT equipment_id AS _id, schedule, strftime(last_m, '%Y-%m-%d') AS last_maintenance,
              strftime(last_m + CASE schedule WHEN 'weekly' THEN 7 WHEN 'monthly' THEN 30
                WHEN 'quarterly' THEN 90 ELSE 180 END, '%Y-%m-%d') AS next_maintenance FROM eq"""),
        **{
            name: _with(SILVER + "," + EQUIPMENT, """
            SELECT event_id, sv.equipment_id, sv.sensor_id, round(value, 6) AS value, is_anomaly,
              normal_min, normal_max, NOT (value BETWEEN normal_min AND normal_max) AS out_of_range
            FROM sv LEFT JOIN sen ON sv.equipment_id = sen.equipment_id AND sv.sensor_id = sen.sensor_id""")
            for name in ("range_anomaly", "range_anomaly_large")
        },
        "unknown_factory": _with(EVENTS + "," + FACTORIES, """
            SELECT factory_id, count(*) AS events FROM ev
            WHERE NOT EXISTS (SELECT 1 FROM fac WHERE fac.id = ev.factory_id) GROUP BY factory_id"""),
        "factory_conflicts": _with(SILVER + "," + ERP + "," + EQUIPMENT + """,
said AS (
  SELECT DISTINCT * FROM (
    SELECT equipment_id, factory_id, 'sensors' AS source FROM sv
    UNION ALL SELECT equipment_id, factory_id, 'erp' FROM erp
    UNION ALL SELECT equipment_id, factory_id, 'registry' FROM eq) WHERE factory_id IS NOT NULL),
many AS (
  SELECT equipment_id, count(DISTINCT factory_id) AS factories FROM said
  GROUP BY equipment_id HAVING count(DISTINCT factory_id) > 1)
""", "SELECT said.*, factories FROM said JOIN many USING (equipment_id)"),
        "registry_rejects": _with(EQUIPMENT + "," + FACTORIES + "," + refused, f"""
            SELECT equipment_id, 'unknown_factory' AS reason FROM undelivered WHERE factory_id NOT IN (SELECT id FROM fac)
            UNION ALL
            SELECT equipment_id, concat_ws(',', {', '.join(f"CASE WHEN coalesce({a}, false) AND NOT coalesce({ok}, false) THEN '{n}' END" for n, a, ok in EQUIPMENT_RULES)}) AS reason
            FROM judged WHERE NOT coalesce({' AND '.join(f"(NOT coalesce({a}, false) OR coalesce({ok}, false))" for _, a, ok in EQUIPMENT_RULES)}, false)"""),
        # data quality
        "dq_gate": _with(LINES, _rules("docs", EVENT_RULES) + f""" UNION ALL
            SELECT 'duplicate_rate', count(*), count(*) - (count(DISTINCT {_text('event_id')})
                + count(DISTINCT CASE WHEN {_text('event_id')} IS NULL THEN 1 END)),
              (count(*) - (count(DISTINCT {_text('event_id')})
                + count(DISTINCT CASE WHEN {_text('event_id')} IS NULL THEN 1 END))) / CAST(count(*) AS DOUBLE) < 0.01
            FROM docs"""),
        "dq_report": _with(LINES, _rules("docs", EVENT_RULES)),
        "dq_violations": _with(LINES, " UNION ALL ".join(
            f"""SELECT {_text('event_id')} AS event_id, '{name}' AS rule FROM docs
            WHERE coalesce({applies}, false) AND NOT coalesce({ok}, false)"""
            for name, applies, ok in EVENT_RULES)),
        "dq_missing_fields": _with(LINES, f"""
            SELECT line AS value, concat_ws(',', {', '.join(_missing(k) for k in REQUIRED)}) AS missing
            FROM docs WHERE {' OR '.join(f'{_kind(k)} IS NULL' for k in REQUIRED)}"""),
        "dq_duplicate_rate": _with(EVENTS, """
            SELECT count(*) AS checked, count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM ev))
                AS duplicates,
              round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM ev)))
                / CAST(count(*) AS DOUBLE), 6) AS duplicate_rate,
              (count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM ev)))
                / CAST(count(*) AS DOUBLE) < 0.01 AS passed FROM ev"""),
        "dq_types": _with(LINES, f"""
            SELECT {_json_kind('is_anomaly')} AS is_anomaly_kind, {_json_kind('value')} AS value_kind,
              count(*) AS events FROM docs GROUP BY ALL"""),
        "dq_contract_event": _with(LINES, _rules("docs", _contract())),
        "dq_contract_compiled": _with(LINES, _rules("docs", _documented())),
        "dq_contract_equipment": _with(EQUIPMENT, _rules("eq", EQUIPMENT_RULES)),
        "dq_contract_factory": _with(FACTORIES, _rules("fac", FACTORY_RULES)),
        "dq_silver": _with(SILVER, """
            SELECT 'unique_event_id' AS rule, count(*) AS checked,
              count(*) - count(DISTINCT event_id) AS failed,
              count(*) = count(DISTINCT event_id) AS passed FROM sv UNION ALL """
            + _rules("sv", SILVER_RULES)),
    }
