"""Bronze → Silver on hand-made rows."""

import json
import os

import pytest
from helpers import assert_same, events, line, messages, reading
from pyspark.sql import functions as F

from plantlake.functions.records import decode_events, encode_events
from plantlake.operators import silver
from plantlake.plans.daily import bronze_to_silver
from plantlake.sinks.files import write_silver
from plantlake.sources import files


def decoded(spark, *lines):
    return decode_events(messages(spark, lines))


def test_bad_lines_and_wrong_types_become_nulls(spark):
    rows = decoded(
        spark, "{broken", line(1, value="12.5"), '{"source": "erp", "id": 7}', line(2)
    ).collect()
    assert rows[0].event_id is None
    assert rows[1].value is None and rows[1].sensor_id == "SENS-00001"
    assert rows[2].sensor_id is None
    assert rows[3].value == 50.0


def test_binary_messages_decode(spark):
    raw = messages(spark, [line(1)]).select(F.col("value").cast("binary").alias("value"))
    assert decode_events(raw).first().equipment_id == "EQ-0001"


def test_encode_decode_round_trip(spark):
    rows = events(spark, reading(1), reading(2, quality=None, metadata=None))
    sent = encode_events(rows)
    assert [r.key for r in sent.collect()] == ["EQ-0001", "EQ-0001"]
    assert '"quality":null' in sent.collect()[1].value
    assert_same(rows, decode_events(sent))


def test_blank_sensor_id_is_kept_as_empty_text(spark):
    out = silver.clean(events(spark, reading(1, sensor_id="  "), reading(2, sensor_id=None)))
    assert [r.sensor_id for r in out.collect()] == [""]


def test_incomplete_rows_are_dropped_without_error(spark):
    out = silver.clean(
        events(
            spark,
            reading(1, timestamp="not-a-time"),
            reading(2, value=None),
            {**reading(3), "event_id": None},
            reading(4),
        )
    )
    assert [r.event_id[:8] for r in out.collect()] == ["00000004"]


def test_text_is_tidied_and_event_id_is_not(spark):
    row = reading(
        1, sensor_id=" S ", equipment_id=" E ", factory_id=" F ",
        measurement_type=" TEMPERATURE ", unit=" Celsius", quality="GOOD ",
    )
    row["event_id"] = " id "
    out = silver.clean(events(spark, row)).first()
    assert (out.event_id, out.sensor_id, out.equipment_id, out.factory_id) == (" id ", "S", "E", "F")
    assert (out.measurement_type, out.unit, out.quality) == ("temperature", "celsius", "good")


def test_battery_overflow_becomes_null(spark):
    device = {"firmware_version": "1", "battery_level": 3_000_000_000, "signal_strength": -1}
    out = silver.clean(events(spark, reading(1, metadata=device))).first()
    assert out.battery_level is None and out.signal_strength == -1
    assert (out.year, out.month, out.day) == (2024, 5, 1)


def test_first_survivor_does_not_depend_on_order(spark):
    early = reading(1, timestamp="2024-05-01T00:00:00+00:00", value=1.0)
    late = reading(1, timestamp="2024-05-01T00:00:01+00:00", value=2.0)
    tie = reading(1, timestamp="2024-05-01T00:00:00+00:00", value=3.0)
    for rows in ([early, late, tie], [tie, late, early]):
        assert [r.value for r in silver.clean(events(spark, *rows)).collect()] == [1.0]
    assert silver.clean(events(spark, early, late, tie), keep="any").count() == 1


def test_hot_event_id_is_combined_before_the_shuffle(spark):
    """A third of all rows with one id crosses the shuffle as one row per map task."""
    hot = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").cast("timestamp").alias("timestamp"),
        F.col("id").alias("value"),
    )
    out = silver.dedup(hot)
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange hashpartitioning(event_id"):]
    assert "partial_min" in before_exchange
    assert out.count() == 2001
    assert out.filter("event_id = 'hot'").first().value == 0


def test_json_silver_round_trip_keeps_types_and_microseconds(spark, folder):
    rows = silver.clean(
        events(spark, reading(1, timestamp="2024-05-01T10:11:12.123456+00:00", quality=None), reading(2))
    )
    for options in ({}, {"max_files": 4}, {"partition_by": ["year", "month", "factory_id"]}):
        path = os.path.join(folder, "-".join(options) or "flat")
        write_silver(rows, path, **options)
        back = files.silver(spark, path)
        assert_same(rows, back)
        assert dict(back.dtypes)["timestamp"] == "timestamp"
    assert os.path.isdir(os.path.join(folder, "partition_by", "year=2024", "month=5"))


def test_at_most_the_wanted_number_of_files(spark, folder):
    rows = silver.clean(events(spark, *[reading(i) for i in range(1, 200)]))
    write_silver(rows, folder + "/four", max_files=4)
    assert len([f for f in os.listdir(folder + "/four") if f.startswith("part-")]) <= 4


def test_no_sensor_rows_writes_nothing(spark, folder):
    foreign = decoded(spark, '{"source": "erp", "id": 7}')
    assert bronze_to_silver(foreign, folder + "/silver") is False
    assert not os.path.exists(folder + "/silver")


def test_blank_lines_are_skipped_by_the_file_scan(spark, folder):
    with open(folder + "/a.json", "w") as f:
        f.write("\n" + json.dumps(reading(1)) + "\n\n" + json.dumps(reading(2)) + "\n")
    assert files.mixed_bronze(spark, folder).count() == 2


@pytest.mark.parametrize("text", ["12:30", "2024", "T01", "2024-05", "2024-05-01T", "05-01-2024", "", " "])
def test_text_without_a_full_date_is_no_time(spark, text):
    from plantlake.functions.scalars import event_time

    row = spark.createDataFrame([(text,)], "timestamp string").select(event_time().alias("t")).first()
    assert row.t is None


@pytest.mark.parametrize(
    "text", ["2024-05-01", "2024-05-01T10:00", "2024-05-01 10:00:00", "2024-05-01T10:00:00.123456Z", " 2024-05-01T10:00:00+02:00 "]
)
def test_iso_texts_are_times(spark, text):
    from plantlake.functions.scalars import event_time

    row = spark.createDataFrame([(text,)], "timestamp string").select(event_time().alias("t")).first()
    assert row.t is not None
