"""Alert levels, and the timing of the streaming job."""

import os
import time

from helpers import assert_same, events, line, messages, reading

from plantlake import schemas
from plantlake.functions.records import decode_events
from plantlake.operators import alerts, registry
from plantlake.plans import feeds
from plantlake.plans.catalog import QUERIES
from plantlake.sources import files
from plantlake.streaming import alerts_job


def clock(text):
    return f"2024-05-01T{text}+00:00"


def batch_alerts(spark, *rows, **options):
    return alerts.windowed_alerts(events(spark, *rows).drop("metadata"), **options)


def test_rates_on_the_thresholds(spark):
    rows = []
    for share, equipment in ((1, "W"), (3, "C")):
        for i in range(10):
            rows.append(reading(len(rows), equipment_id=equipment, is_anomaly=i < share))
    levels = {r.equipment_id: r.alert_level for r in batch_alerts(spark, *rows).collect()}
    assert levels == {"W": "warning", "C": "critical"}


def test_below_the_threshold_or_unknown_raises_nothing(spark):
    rows = [reading(i, is_anomaly=i == 0) for i in range(11)]
    rows += [reading(20 + i, equipment_id="N", is_anomaly=None) for i in range(2)]
    assert batch_alerts(spark, *rows).count() == 0


def test_windows_are_tumbling_and_skip_unreadable_times(spark):
    rows = [
        reading(1, timestamp=clock("00:04:59.999999"), is_anomaly=True),
        reading(2, timestamp=clock("00:05:00"), is_anomaly=True),
        reading(3, timestamp="never", is_anomaly=True),
        reading(4, timestamp=None, is_anomaly=True),
    ]
    out = batch_alerts(spark, *rows).orderBy("window").collect()
    assert [(r.window.start.minute, r.window.end.minute, r.event_count) for r in out] == [
        (0, 5, 1), (5, 10, 1),
    ]


def test_repeats_count_unless_asked_not_to(spark):
    rows = [reading(1, is_anomaly=True), reading(1, is_anomaly=True)]
    assert batch_alerts(spark, *rows).first().event_count == 2
    assert batch_alerts(spark, *rows, distinct_events=True).first().event_count == 1


class Topic:
    """A folder of JSON-line files standing in for the topic, and one alert job over it."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options = spark, root, options
        self.files = 0
        os.makedirs(root + "/topic")

    def send(self, *lines):
        self.files += 1
        path = f"{self.root}/topic/{self.files}.txt"
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (time.time(), time.time() - 1000 + self.files))

    def run(self):
        """Start from the checkpoint, read what is new, stop."""
        source = self.spark.readStream.text(self.root + "/topic")
        job = alerts_job.start_file_sink(
            alerts_job.alerts_from_messages(source, **self.options),
            self.root + "/alerts", self.root + "/checkpoint", interval=None,
        )
        job.awaitTermination()
        return job

    def alerts(self):
        rows = files.alerts(self.spark, self.root + "/alerts").collect()
        return sorted((r.window.start.strftime("%H:%M"), r.event_count) for r in rows)


def test_window_comes_out_when_the_watermark_reaches_its_end(spark, folder):
    topic = Topic(spark, folder)
    topic.send(line(1, timestamp=clock("00:01:00"), is_anomaly=True))
    topic.run()
    assert topic.alerts() == []
    topic.send(line(2, timestamp=clock("00:14:59")))
    topic.run()
    assert topic.alerts() == []
    topic.send(line(3, timestamp=clock("00:15:00")))
    topic.run()
    assert topic.alerts() == [("00:00", 1)]


def test_late_events_are_dropped_and_counted(spark, folder):
    topic = Topic(spark, folder)
    topic.send(line(1, timestamp=clock("00:01:00"), is_anomaly=True))
    topic.send(line(2, timestamp=clock("00:15:00")))
    topic.run()
    topic.send(line(3, timestamp=clock("00:04:00"), is_anomaly=True))
    job = topic.run()
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in job.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1
    assert topic.alerts() == [("00:00", 1)]


def test_restart_neither_loses_nor_repeats(spark, folder):
    topic = Topic(spark, folder)
    for step, text in enumerate(["00:01:00", "00:02:00", "00:20:00", "00:40:00"]):
        topic.send(line(step, timestamp=clock(text), is_anomaly=True))
        topic.run()
    topic.run()
    assert topic.alerts() == [("00:00", 2), ("00:20", 1)]


def test_stream_can_drop_repeats(spark, folder):
    topic = Topic(spark, folder, distinct_events=True)
    same = line(1, timestamp=clock("00:01:00"), is_anomaly=True)
    topic.send(same, same)
    topic.send(line(2, timestamp=clock("00:30:00")))
    topic.run()
    assert topic.alerts() == [("00:00", 1)]


def test_alert_files_lie_by_factory(spark, folder):
    topic = Topic(spark, folder)
    topic.send(line(1, timestamp=clock("00:01:00"), is_anomaly=True), "{broken")
    topic.send(line(2, timestamp=clock("00:30:00")))
    topic.run()
    assert os.path.isdir(folder + "/alerts/factory_id=FAB-SP-01")


def test_console_follows_the_alert_files(spark, folder):
    topic = Topic(spark, folder)
    topic.send(line(1, timestamp=clock("00:01:00"), is_anomaly=True))
    topic.send(line(2, timestamp=clock("00:30:00")))
    topic.run()
    job = alerts_job.start_console_sink(spark, folder + "/alerts", interval=None)
    job.awaitTermination()
    assert all("Console" in p["sink"]["description"] for p in job.recentProgress)
    assert sum(p["sink"]["numOutputRows"] for p in job.recentProgress) == 1


def test_console_may_start_before_the_first_alert(spark, folder):
    """Starting the alert job is enough for the folder to be there."""
    topic = Topic(spark, folder)
    topic.send(line(1, timestamp=clock("00:01:00"), is_anomaly=True))
    topic.run()
    job = alerts_job.start_console_sink(spark, folder + "/alerts", interval="1 second")
    try:
        job.processAllAvailable()
        topic.send(line(2, timestamp=clock("00:30:00")))
        topic.run()
        job.processAllAvailable()
        assert job.exception() is None
        assert sum(p["numInputRows"] for p in job.recentProgress) == 1
    finally:
        job.stop()


def test_stream_equals_batch_for_closed_windows(spark, sf_dir):
    lines = feeds.sensor_lines(feeds.table(spark, sf_dir, "events"))
    decoded = decode_events(lines, schemas.STREAM_EVENT)
    last = decoded.selectExpr("max(try_to_timestamp(CASE WHEN length(timestamp) > 9 THEN timestamp END)) AS t").first().t
    closed = QUERIES["alerts_batch"](spark, sf_dir).filter(
        f"window_end <= timestamp'{last}' - interval 10 minutes"
    )
    assert_same(closed, QUERIES["alerts_stream"](spark, sf_dir))


def test_tables_of_many_files_stream_the_same(spark, sf_dir, folder):
    """A table may be a folder of part files, in no order of time."""
    feeds.table(spark, sf_dir, "events").repartition(5).write.parquet(folder + "/events.parquet")
    for name in ("alerts_stream", "bronze_landing"):
        assert_same(QUERIES[name](spark, sf_dir), QUERIES[name](spark, folder))


def test_readings_without_an_id_all_count(spark, folder):
    at = clock("00:01:00")
    rows = [reading(k, event_id=None, timestamp=at, is_anomaly=True) for k in (1, 1, 2)]
    assert batch_alerts(spark, *rows, distinct_events=True).first().event_count == 3
    topic = Topic(spark, folder, distinct_events=True)
    topic.send(*[line(k, event_id=None, timestamp=at, is_anomaly=True) for k in (1, 1, 2)])
    topic.send(line(9, timestamp=clock("00:30:00")))
    topic.run()
    assert topic.alerts() == [("00:00", 3)]


def test_registry_ranges_can_replace_the_flag(spark):
    ranges = spark.createDataFrame(
        [("EQ-0001", "SENS-00001", 30.0, 70.0)],
        "equipment_id string, sensor_id string, normal_min double, normal_max double",
    )
    rows = events(spark, reading(1, value=80.0), reading(2, sensor_id="SENS-9", value=80.0))
    flagged = registry.flag_out_of_range(rows, ranges)
    out = alerts.windowed_alerts(flagged, flag="out_of_range").first()
    assert (out.event_count, out.anomaly_count, out.alert_level) == (2, 1, "critical")


def test_stream_joins_the_registry_by_broadcast_and_by_salted_shuffle(spark, folder):
    ranges = spark.createDataFrame(
        [("EQ-0001", "SENS-00001", 30.0, 70.0)],
        "equipment_id string, sensor_id string, normal_min double, normal_max double",
    )
    os.makedirs(folder + "/topic")
    with open(folder + "/topic/1.txt", "w") as f:
        f.write("\n".join([line(1, value=80.0), line(2, value=50.0), line(3, sensor_id="S")]))
        f.write("\n" + line(4, timestamp=clock("01:00:00")) + "\n")
    for name, limit in (("broadcast", 10**6), ("salted", 0)):
        lines = spark.readStream.text(folder + "/topic")
        flagged = registry.flag_out_of_range(
            decode_events(lines, schemas.STREAM_EVENT), ranges, max_broadcast_bytes=limit
        )
        alerts_job.start_file_sink(
            alerts.windowed_alerts(flagged, flag="out_of_range"),
            f"{folder}/{name}", f"{folder}/{name}-checkpoint", interval=None,
        ).awaitTermination()
        out = files.alerts(spark, f"{folder}/{name}").collect()
        assert [(r.event_count, r.anomaly_count, r.alert_level) for r in out] == [(3, 1, "critical")]


def test_messages_helper_matches_the_stream_layout(spark):
    decoded = decode_events(messages(spark, [line(1)]), schemas.STREAM_EVENT)
    assert "metadata" not in decoded.columns
