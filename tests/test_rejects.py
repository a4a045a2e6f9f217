"""Lines that Silver refuses are counted and kept with their reasons; Gold's moments merge."""

import statistics

import pytest
from helpers import assert_same, events, line, messages, reading
from pyspark.sql import functions as F

from plantlake.functions.records import decode_events
from plantlake.operators import gold, silver
from plantlake.plans.daily import lines_to_silver
from plantlake.sources import files

CASES = [
    (line(1), []),
    (line(2)[:40], ["broken_line"]),
    ("no json", ["broken_line"]),
    ("", ["broken_line"]),
    (None, ["broken_line"]),
    ('{"source":"erp","id":7}', ["no_sensor_id", "no_event_id", "no_value", "no_timestamp"]),
    (line(3, drop=["value"]), ["no_value"]),
    (line(4, value=None), ["no_value"]),
    (line(5, value="12.5"), ["bad_value"]),
    (line(6, timestamp="yesterday"), ["bad_timestamp"]),
    (line(7, timestamp=None, event_id=None), ["no_event_id", "no_timestamp"]),
    (line(8, sensor_id=None), ["no_sensor_id"]),
    (line(9, sensor_id="  ", quality=7), []),
    (line(10, is_anomaly="yes"), []),
    (line(11, timestamp="12:30"), ["bad_timestamp"]),
    (line(12, event_id=None, value="x", timestamp="2024"), ["no_event_id", "bad_value", "bad_timestamp"]),
]


def test_reasons(spark):
    judged = silver.assessed(messages(spark, [text for text, _ in CASES]))
    got = sorted((str(r.line), r.reasons) for r in judged.collect())
    assert got == sorted((str(text), reasons) for text, reasons in CASES)


def test_survivors_equal_clean(spark):
    lines = messages(spark, [text for text, _ in CASES] + [line(1), line(1, value=1.0)])
    assert_same(silver.survivors(silver.assessed(lines)), silver.clean(decode_events(lines)))


def test_every_line_is_accounted_for(spark, folder):
    texts = [text for text, _ in CASES] + [line(1)] * 3
    told = lines_to_silver(messages(spark, texts), f"{folder}/silver", f"{folder}/rejects")
    assert told == {"read": len(texts), "accepted": 3, "duplicates": 3, "rejected": 13}
    assert files.silver(spark, f"{folder}/silver").count() == 3
    kept = spark.read.schema("line string, reasons array<string>").json(f"{folder}/rejects").collect()
    assert sorted((str(r.line), r.reasons) for r in kept) == sorted((str(t), r) for t, r in CASES if r)


def test_all_lines_refused_and_none_at_all(spark, folder):
    told = lines_to_silver(messages(spark, ["x"]), f"{folder}/silver", f"{folder}/rejects")
    assert told == {"read": 1, "accepted": 0, "duplicates": 0, "rejected": 1}
    told = lines_to_silver(messages(spark, ["x"]).limit(0), f"{folder}/s", f"{folder}/r")
    assert told == {"read": 0, "accepted": 0, "duplicates": 0, "rejected": 0}


def test_a_rerun_replaces_the_rejects(spark, folder):
    for texts in (["x", "y"], ["z"]):
        lines_to_silver(messages(spark, [*texts, line(1)]), f"{folder}/silver", f"{folder}/rejects")
    assert [r.line for r in spark.read.json(f"{folder}/rejects").collect()] == ["z"]


# --- moments -------------------------------------------------------------------


def readings(spark, values, **more):
    rows = [
        reading(k, value=float(v), timestamp=f"2024-05-{1 + k % 3:02d}T{k % 24:02d}:00:00+00:00", is_anomaly=k % 4 == 0, **more)
        for k, v in enumerate(values)
    ]
    return silver.clean(events(spark, *rows))


def near(left, right, keys):
    names = [c for c in left.columns if c not in keys]
    one, two = ({tuple(r[k] for k in keys): r for r in df.collect()} for df in (left, right))
    assert left.columns == right.columns and one.keys() == two.keys()
    for key in one:
        for c in names:
            a, b = one[key][c], two[key][c]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-12)), (key, c)


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_coarser_gold_equals_gold_from_silver(spark, grain):
    rows = readings(spark, [3, 8, 1, 7.5, -2, 0, 11, 4] * 9).unionByName(readings(spark, [5], factory_id=None))
    keys = ["equipment_id", "factory_id", "measurement_type", f"timestamp_{grain}"]
    near(gold.coarser(gold.hourly(rows), grain), gold.score(gold.rollup(rows, grain)), keys)
    if grain != "day":
        daily = gold.score(gold.rollup(rows, "day"))
        near(gold.coarser(daily, grain, "day"), gold.score(gold.rollup(rows, grain)), keys)


def test_large_means_do_not_cancel_small_spreads(spark):
    values = [1e9 + v for v in (0.1, 0.2, 0.15, 0.4, 0.05, 0.3, 0.25, 0.5)]
    found = gold.spread(gold.hourly(readings(spark, values)), "equipment_id").first()
    assert found.std_value == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert found.event_count == 8


def test_one_reading_has_no_spread(spark):
    found = gold.spread(gold.hourly(readings(spark, [4.0])), "factory_id").first()
    assert (found.std_value, found.criticality_score, found.avg_value) == (None, None, 4.0)


def test_only_a_coarser_grain(spark):
    with pytest.raises(ValueError, match="coarser"):
        gold.coarser(gold.hourly(readings(spark, [1])), "hour")
    assert gold.coarser(gold.hourly(readings(spark, [1]).where(F.lit(False))), "day").collect() == []
