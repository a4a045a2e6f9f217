"""Quality rules: each broken on purpose once, on raw text."""

import pytest
from helpers import events, line, messages, reading

from plantlake import schemas
from plantlake.operators import quality, silver


def failed(spark, rules, *lines):
    out = quality.report(quality.inspect(messages(spark, lines)), rules).collect()
    return {r.rule: r.failed for r in out if not r.passed}


def test_correct_readings_pass_every_rule(spark):
    good = [line(i) for i in range(1, 4)]
    assert failed(spark, quality.event_rules(), *good) == {}
    assert failed(spark, quality.contract_rules(), *good) == {}


@pytest.mark.parametrize(
    "change, rules",
    [
        ({"drop": ("quality",)}, {"required_fields", "quality"}),
        ({"measurement_type": "torque"}, {"measurement_type"}),
        ({"quality": "GOOD"}, {"quality"}),
        ({"factory_id": "FAB-XX-99"}, {"factory_known"}),
        ({"value": 150.5}, {"physical_range"}),
        ({"value": -0.1}, {"physical_range"}),
        ({"value": "50"}, {"physical_range", "value_numeric"}),
        ({"value": None}, {"physical_range", "value_numeric"}),
        ({"is_anomaly": "true"}, {"is_anomaly_boolean"}),
        ({"is_anomaly": 1}, {"is_anomaly_boolean"}),
        ({"timestamp": ""}, {"timestamp_text"}),
        ({"timestamp": 1714521600}, {"timestamp_text"}),
        ({"event_id": "00000000-0000-4000-8000-00000000000A"}, {"event_id_uuid"}),
        ({"event_id": "x"}, {"event_id_uuid"}),
    ],
)
def test_each_fault_is_found(spark, change, rules):
    change = dict(change)
    drop = change.pop("drop", ())
    assert set(failed(spark, quality.event_rules(), line(1, drop, **change))) == rules


def test_bounds_belong_to_the_range_and_null_counts_as_present(spark):
    assert failed(spark, quality.event_rules(), line(1, value=0), line(2, value=150)) == {}
    faults = failed(spark, quality.event_rules(), line(1, sensor_id=None))
    assert "required_fields" not in faults


def test_unknown_measurements_have_no_range(spark):
    rows = quality.inspect(messages(spark, [line(1, measurement_type="torque", value=1e9)]))
    report = {r.rule: r for r in quality.report(rows, quality.event_rules()).collect()}
    assert report["physical_range"].checked == 0 and report["physical_range"].passed


def test_broken_line_fails_everything_it_should(spark):
    assert "required_fields" in failed(spark, quality.event_rules(), "{broken")


def test_missing_keys_are_named(spark):
    out = quality.missing_keys(messages(spark, [line(1), line(2, ("unit", "value", "quality")), "{"]))
    missing = sorted((len(r.missing), sorted(r.missing)) for r in out.collect())
    assert missing == [(2, ["quality", "value"]), (9, sorted(schemas.REQUIRED_KEYS))]


def test_violations_list_rows_and_rules(spark):
    rows = quality.inspect(messages(spark, [line(1), line(2, quality="?", factory_id=None)]))
    out = quality.violations(rows, quality.event_rules(), "event_id").collect()
    assert {(r.event_id[:8], r.rule) for r in out} == {
        ("00000002", "quality"), ("00000002", "factory_known"),
    }


@pytest.mark.parametrize(
    "change, rules",
    [
        ({"drop": ("unit",)}, {"required:unit"}),
        ({"unit": 5}, {"valid:unit"}),
        ({"timestamp": "yesterday"}, {"valid:timestamp"}),
        ({"metadata": {"battery_level": 101}}, {"valid:battery_level"}),
        ({"metadata": {"battery_level": 50.5}}, {"valid:battery_level"}),
        ({"metadata": {"signal_strength": "weak"}}, {"valid:signal_strength"}),
        ({"metadata": {}}, set()),
        ({"drop": ("metadata",)}, set()),
    ],
)
def test_event_contract(spark, change, rules):
    change = dict(change)
    drop = change.pop("drop", ())
    assert set(failed(spark, quality.contract_rules(), line(1, drop, **change))) == rules


def test_duplicate_rate_and_its_limit(spark):
    few = events(spark, *[reading(i) for i in range(199)], reading(0))
    out = quality.duplicate_rate(few).first()
    assert (out.checked, out.duplicates, out.duplicate_rate, out.passed) == (200, 1, 0.005, True)
    many = events(spark, *[reading(i) for i in range(99)], reading(0))
    assert quality.duplicate_rate(many).first().passed is False


def test_empty_input_reports_and_does_not_divide_by_zero(spark):
    empty = events(spark)
    out = quality.duplicate_rate(empty).first()
    assert (out.checked, out.duplicate_rate, out.passed) == (0, None, True)
    report = quality.report(quality.inspect(messages(spark, [])), quality.event_rules())
    assert all(r.checked == 0 and r.passed for r in report.collect())
    assert all(r.passed for r in quality.silver_guarantees(silver.clean(empty)).collect())


def test_silver_guarantees_notice_faults(spark):
    rows = silver.tidy_events(
        events(spark, reading(1), reading(1), reading(2, value=None), reading(3, timestamp="?"))
    )
    out = {r.rule: r.failed for r in quality.silver_guarantees(rows).collect()}
    assert out == {
        "unique_event_id": 1, "null_event_id": 0, "null_sensor_id": 0,
        "null_value": 1, "null_timestamp": 1,
    }


def test_json_kinds(spark):
    lines = [line(1), line(2, value="5"), line(3, is_anomaly=None), line(4, ("value",))]
    out = quality.json_types(messages(spark, lines)).collect()
    assert {(r.is_anomaly_kind, r.value_kind, r.events) for r in out} == {
        ("boolean", "number", 1), ("boolean", "string", 1), ("null", "number", 1),
        ("boolean", "absent", 1),
    }
