"""Readings in time and late ones: none is lost, and the windows come out right."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import assert_same, events, line, messages
from plantlake import schemas
from plantlake.functions.records import decode_events
from plantlake.operators import alerts, registry
from plantlake.sinks import files as sinks
from plantlake.sources import files
from plantlake.streaming import alerts_job, arrivals_job
from plantlake.streaming.arrivals_job import IN_TIME, LATE


def clock(text):
    return f"2024-05-01T{text}+00:00"


class Plant:
    """A topic of files, one trigger per send, the split and the alert job behind it."""

    def __init__(self, spark, root, prepare=None, layout=schemas.STREAM_EVENT):
        self.spark, self.root, self.prepare, self.layout, self.files = spark, root, prepare, layout, 0
        os.makedirs(f"{root}/topic")

    def send(self, *lines):
        self.files += 1
        with open(f"{self.root}/topic/{self.files}.txt", "w") as f:
            f.write("\n".join(lines))
        self.split()

    def split(self):
        stream = decode_events(self.spark.readStream.text(f"{self.root}/topic"), schemas.STREAM_EVENT)
        query = arrivals_job.start_split(
            stream, f"{self.root}/split", f"{self.root}/check", prepare=self.prepare, interval=None
        )
        query.awaitTermination()

    def follow(self):
        stream = arrivals_job.follow(self.spark, f"{self.root}/split", self.layout)
        query = alerts_job.start_file_sink(
            alerts.windowed_alerts(stream), f"{self.root}/alerts", f"{self.root}/check2", interval=None
        )
        query.awaitTermination()
        dropped = [o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators]
        assert not any(dropped)
        return files.alerts(self.spark, f"{self.root}/alerts")

    def kept(self, part):
        return arrivals_job.arrived(self.spark, f"{self.root}/split", part, self.layout)


def numbers(df):
    return sorted(int(i[:8], 16) for (i,) in df.select("event_id").collect())


@pytest.fixture
def plant(spark, folder):
    return Plant(spark, folder)


def bad(number, at, **changes):
    return line(number, timestamp=clock(at), is_anomaly=True, **changes)


def good(number, at, **changes):
    return line(number, timestamp=clock(at), is_anomaly=False, **changes)


def test_late_is_what_comes_after_its_window_was_closed(plant):
    plant.send(bad(1, "00:01:00"), bad(2, "00:15:00"))
    # the newest so far is 00:15, less 10 minutes: windows that end by 00:05 are closed
    plant.send(bad(3, "00:04:59"), bad(4, "00:05:00"), bad(5, "01:00:00"), line(6, timestamp="never"), "no json")
    plant.send(bad(7, "00:49:59"), bad(8, "00:50:00"))
    assert numbers(plant.kept(IN_TIME)) == [1, 2, 4, 5, 8]
    reasons = {r.event_id and int(r.event_id[:8], 16): r.reason for r in plant.kept(LATE).collect()}
    assert reasons == {3: "late", 6: "no_time", 7: "late", None: "no_time"}


def test_same_trigger_is_never_late(plant):
    plant.send(bad(1, "05:00:00"), bad(2, "00:00:00"))
    assert numbers(plant.kept(IN_TIME)) == [1, 2] and plant.kept(LATE).count() == 0


def test_alerts_and_late_readings_make_the_alerts_of_all(spark, plant):
    sent = [
        [bad(1, "00:01:00"), good(2, "00:01:00", equipment_id="B"), good(3, "00:11:00"), good(4, "00:40:00")],
        # raises an alert for B, takes none back, adds a window, and one without an equipment
        [bad(5, "00:02:00", equipment_id="B"), bad(6, "00:12:00", equipment_id=None), bad(7, "00:41:00")],
        # takes the first window's alert back
        [good(100 + i, "00:03:00") for i in range(20)] + [bad(8, "02:00:00")],
        [bad(9, "02:30:00", equipment_id="C")],
    ]
    for batch in sent:
        plant.send(*batch)
    written = plant.follow()
    in_time, late = plant.kept(IN_TIME), plant.kept(LATE)
    everything = [text for batch in sent for text in batch]
    assert in_time.count() + late.count() == len(everything) and late.count() == 22
    all_alerts = alerts.windowed_alerts(decode_events(messages(spark, everything), schemas.STREAM_EVENT))
    closed = all_alerts.where("window.end <= timestamp'2024-05-01 02:20:00'")
    assert written.exceptAll(closed).count() > 0
    assert_same(arrivals_job.corrected(written, in_time, late), closed)


@pytest.mark.parametrize("step", ["move", "_note"])
def test_a_trigger_that_failed_is_repeated_once(spark, plant, monkeypatch, step):
    plant.send(bad(1, "00:01:00"), bad(2, "01:00:00"))
    owner = arrivals_job.Folders if step == "move" else arrivals_job
    real, calls = getattr(owner, step), []

    def failing(*args):
        done = real(*args)
        calls.append(args)
        if len(calls) == 1:
            raise OSError("stopped")
        return done

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(Exception, match="stopped"):
        plant.send(bad(3, "00:02:00"), bad(4, "03:00:00"), bad(5, "01:01:00"))
    plant.split()
    assert numbers(plant.kept(IN_TIME)) == [1, 2, 4, 5]
    assert numbers(plant.kept(LATE)) == [3]


def registry_of(spark, high, equipment="EQ-0001"):
    sensor = {"id": "SENS-00001", "normal_range": {"min": 0.0, "max": high}}
    return spark.createDataFrame([{"_id": equipment, "sensors": [sensor]}], schemas.EQUIPMENT)


def test_a_range_changed_between_triggers_takes_effect_in_the_second(spark, folder):
    root = f"{folder}/registry"

    def flagged(rows):
        versions = registry.dated_ranges(files.equipment_snapshots(rows.sparkSession, root))
        return registry.flag_out_of_range_dated(rows, versions)

    layout = schemas.STREAM_EVENT + ", normal_min double, normal_max double, out_of_range boolean"
    plant = Plant(spark, folder, flagged, layout)
    sinks.write_snapshot(registry_of(spark, 100.0), root, "2024-01-01")
    plant.send(line(1, value=50.0, timestamp=clock("00:01:00")))
    sinks.write_snapshot(registry_of(spark, 40.0), root, "2024-05-01 00:01:30")
    plant.send(
        line(2, value=50.0, timestamp=clock("00:01:00")),
        line(3, value=50.0, timestamp=clock("00:01:30")),
        line(4, value=50.0, timestamp="2023-12-31T00:00:00+00:00"),
    )
    seen = plant.kept(IN_TIME).unionByName(plant.kept(LATE), allowMissingColumns=True)
    found = {int(r.event_id[:8], 16): (r.normal_max, r.out_of_range) for r in seen.collect()}
    assert found == {1: (100.0, False), 2: (100.0, False), 3: (40.0, True), 4: (None, None)}


def test_versions_are_changes_only(spark, folder):
    root = f"{folder}/registry"
    for day, high in (("2024-01-01", 5.0), ("2024-01-02", 5.0), ("2024-01-03", 7.0), ("2024-01-04", 5.0)):
        sinks.write_snapshot(registry_of(spark, high), root, day)
    sinks.write_snapshot(registry_of(spark, 9.0, "EQ-0002"), root, "2024-01-05")
    sinks.write_snapshot(registry_of(spark, 9.0, "EQ-0002"), root, "2024-01-05")
    rows = {r.equipment_id: [(v.effective_from.day, v.normal_max) for v in r.versions]
            for r in registry.dated_ranges(files.equipment_snapshots(spark, root)).collect()}
    assert rows == {"EQ-0001": [(1, 5.0), (3, 7.0), (4, 5.0)], "EQ-0002": [(5, 9.0)]}


def test_a_reading_without_time_or_sensor_has_no_range(spark, folder):
    sinks.write_snapshot(registry_of(spark, 5.0), f"{folder}/r", "2024-01-01")
    versions = registry.dated_ranges(files.equipment_snapshots(spark, f"{folder}/r"))
    rows = events(
        spark,
        {"event_id": "a", "equipment_id": "EQ-0001", "sensor_id": "SENS-00001", "timestamp": "soon", "value": 1.0},
        {"event_id": "b", "equipment_id": "EQ-0001", "sensor_id": None, "timestamp": clock("00:00:00"), "value": 1.0},
        {"event_id": "c", "equipment_id": "EQ-0001", "sensor_id": "SENS-00001", "timestamp": clock("00:00:00"), "value": None},
    )
    out = registry.flag_out_of_range_dated(rows, versions)
    assert {r.event_id: (r.normal_max, r.out_of_range) for r in out.collect()} == {
        "a": (None, None), "b": (None, None), "c": (5.0, None)}
