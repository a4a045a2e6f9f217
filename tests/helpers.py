"""Shared by the tests: readings from keyword arguments, and relation equality."""

import json

READING = {
    "event_id": "00000000-0000-4000-8000-000000000001",
    "sensor_id": "SENS-00001",
    "equipment_id": "EQ-0001",
    "factory_id": "FAB-SP-01",
    "measurement_type": "temperature",
    "value": 50.0,
    "unit": "celsius",
    "timestamp": "2024-05-01T00:00:00.000000+00:00",
    "quality": "good",
    "is_anomaly": False,
    "metadata": {"firmware_version": "1.0.0", "battery_level": 80, "signal_strength": -50},
}


def reading(number=1, drop=(), **changes):
    """A correct reading with the changes applied and the ``drop`` keys left out."""
    row = {**READING, "event_id": f"{number:08x}-0000-4000-8000-{number:012x}", **changes}
    return {k: v for k, v in row.items() if k not in drop}


def line(number=1, drop=(), **changes):
    return json.dumps(reading(number, drop, **changes))


def messages(spark, lines):
    return spark.createDataFrame([(text,) for text in lines], "value string")


def events(spark, *rows, layout=None):
    from plantlake import schemas

    return spark.createDataFrame(rows, layout or schemas.SENSOR_EVENT)


def assert_same(left, right):
    """Equal as bags of rows, whatever the row order."""
    right = right.select(*left.columns)
    assert left.exceptAll(right).limit(3).collect() == []
    assert right.exceptAll(left).limit(3).collect() == []
