"""Contracts compiled from JSON Schema documents."""

import json

import pytest

from helpers import line, messages
from plantlake.operators import contracts, quality
from plantlake.plans.catalog import QUERIES, event_contract


def broken(spark, schema, *values):
    """For each JSON value the rules it breaks."""
    rows = messages(spark, [v if isinstance(v, str) else json.dumps(v) for v in values])
    found = quality.violations(contracts.documents(rows), contracts.compiled(schema), "value").collect()
    return [sorted(r.rule for r in found if r.value == (v if isinstance(v, str) else json.dumps(v))) for v in values]


def test_compiled_rules_equal_the_written_ones(spark, sf_dir):
    written = {r.rule: tuple(r)[1:] for r in QUERIES["dq_contract_event"](spark, sf_dir).collect()}
    compiled = {r.rule.replace("metadata.", ""): tuple(r)[1:] for r in QUERIES["dq_contract_compiled"](spark, sf_dir).collect()}
    new = {"valid:$", "valid:metadata", "valid:firmware_version"}
    assert set(compiled) - set(written) == new
    assert written == {name: found for name, found in compiled.items() if name not in new}


def test_a_correct_reading_breaks_nothing(spark):
    assert broken(spark, event_contract(), line(1)) == [[]]


def test_bounds_and_enums(spark):
    schema = {"properties": {
        "n": {"type": "integer", "minimum": 0, "exclusiveMaximum": 10},
        "t": {"enum": ["a", 1, True, None]},
        "s": {"minLength": 2, "maxLength": 3, "pattern": "^x"}}}
    good = [{"n": 0}, {"n": 9.0}, {"t": "a"}, {"t": 1}, {"t": 1.0}, {"t": True}, {"t": None}, {"s": "xy"}, {"s": 5}]
    bad = [{"n": -1}, {"n": 10}, {"n": 1.5}, {"n": "1"}, {"n": None}, {"t": "1"}, {"t": 2}, {"t": False}, {"s": "x"}, {"s": "xyzw"}, {"s": "ab"}]
    assert broken(spark, schema, *good) == [[]] * len(good)
    assert broken(spark, schema, *bad) == [[f"valid:{next(iter(b))}"] for b in bad]


def test_nested_objects_and_arrays(spark):
    schema = {
        "type": "object", "required": ["_id", "sensors"],
        "properties": {
            "_id": {"type": "string"},
            "place": {"type": "object", "required": ["lat"], "properties": {"lat": {"type": ["number", "null"]}}},
            "sensors": {"type": "array", "minItems": 1, "maxItems": 2, "items": {
                "type": "object", "required": ["id"],
                "properties": {"id": {"type": "string"},
                               "marks": {"type": "array", "items": {"type": "number", "maximum": 5}}}}}}}
    cases = [
        ({"_id": "a", "sensors": [{"id": "x", "marks": [1, 5]}], "place": {"lat": None}}, []),
        ({"_id": "a", "sensors": []}, ["valid:sensors"]),
        ({"_id": "a", "sensors": [{"id": "x"}, {}]}, ["required:sensors[].id"]),
        ({"_id": "a", "sensors": [{"id": 7}]}, ["valid:sensors[].id"]),
        ({"_id": "a", "sensors": [{"id": "x"}] * 3}, ["valid:sensors"]),
        ({"_id": "a", "sensors": [{"id": "x", "marks": [1, 6]}]}, ["valid:sensors[].marks[]"]),
        ({"_id": "a", "sensors": [None]}, ["valid:sensors[]"]),
        ({"_id": "a", "sensors": {"id": "x"}}, ["valid:sensors"]),
        ({"_id": "a", "sensors": [{"id": "x"}], "place": {}}, ["required:place.lat"]),
        ({"_id": "a", "sensors": [{"id": "x"}], "place": None}, ["valid:place"]),
        ({"_id": None}, ["required:sensors", "valid:_id"]),
        ("[]", ["required:_id", "required:sensors", "valid:$"]),
        ("{broken", ["required:_id", "required:sensors", "valid:$"]),
        ("", ["required:_id", "required:sensors", "valid:$"]),
    ]
    found = broken(spark, schema, *[value for value, _ in cases])
    assert found == [rules for _, rules in cases]


def test_formats(spark):
    schema = {"properties": {"d": {"format": "date"}, "t": {"format": "date-time"}, "u": {"format": "uuid"}}}
    good = [{"d": "2024-02-29"}, {"t": "2024-05-01T00:00:00Z"}, {"u": "0000000A-0000-4000-8000-00000000000a"}, {"d": 5}]
    bad = [{"d": "2023-02-29"}, {"d": "2024-2-1"}, {"t": "2024-05-01"}, {"t": "12:30"}, {"u": "x"}]
    assert broken(spark, schema, *good) == [[]] * len(good)
    assert broken(spark, schema, *bad) == [[f"valid:{next(iter(b))}"] for b in bad]


@pytest.mark.parametrize("schema", [
    {"oneOf": []}, {"properties": {"a": {"type": "text"}}}, {"properties": {"a": {"format": "email"}}},
    {"items": {"not": {}}}, {"enum": [[1]]}, {"properties": {'a"': {"type": "string"}}},
])
def test_what_is_not_understood_is_refused(spark, schema):
    with pytest.raises(ValueError):
        contracts.compiled(schema)


def test_a_contract_is_read_from_its_document(spark, folder):
    with open(f"{folder}/c.json", "w") as f:
        json.dump(event_contract(), f, indent=2)
    assert contracts.load(spark, f"{folder}/c.json") == event_contract()
