"""Registry documents, lookups, upserts and the range join."""

import pytest
from helpers import assert_same, events, reading
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.operators import quality, registry, silver
from plantlake.plans import feeds
from plantlake.sinks.files import write_documents
from plantlake.sources import files


def sensor(number, kind="temperature", low=30.0, high=70.0, **changes):
    base = {
        "id": f"SENS-{number:05d}", "type": kind, "unit": "celsius",
        "range": {"min": 0.0, "max": 150.0}, "normal_range": {"min": low, "max": high}, "active": True,
    }
    return {**base, **changes}


def document(number=1, **changes):
    base = {
        "_id": f"EQ-{number:04d}", "name": f"Pump {number}", "type": "pump", "factory_id": "FAB-SP-01",
        "factory": {"id": "FAB-SP-01", "name": "São Paulo", "location": {"lat": -23.5, "lng": -46.6}},
        "sensors": [sensor(1), sensor(2, "vibration", 0.0, 10.0)],
        "maintenance": {"schedule": "monthly", "last_maintenance": "2024-01-31", "next_maintenance": "2024-03-01"},
        "installed_at": "2022-01-01", "status": "active",
    }
    return {**base, **changes}


def documents(spark, *docs):
    return spark.createDataFrame(docs, schemas.EQUIPMENT)


def factory(code, name="F", active=True):
    return {"_id": code, "name": name, "location": {"lat": 1.0, "lng": 2.0}, "address": "a", "active": active}


def factories(spark, *rows):
    return spark.createDataFrame(rows, schemas.FACTORY)


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_lookups(spark):
    docs = documents(
        spark,
        document(1),
        document(2, type="motor", status="inactive", sensors=[sensor(9, "humidity", 40.0, 60.0)]),
        document(3, factory_id="FAB-RJ-01"),
    )
    assert ids(registry.find(docs, factory_id="FAB-SP-01", status="active")) == ["EQ-0001"]
    assert ids(registry.find(docs, type="motor")) == ["EQ-0002"]
    assert ids(registry.find(docs, status="inactive")) == ["EQ-0002"]
    assert ids(registry.find(docs, sensor_id="SENS-00009")) == ["EQ-0002"]
    assert ids(registry.find(docs, sensor_type="vibration")) == ["EQ-0001", "EQ-0003"]
    assert ids(registry.with_normal_max_below(docs, 60.0)) == ["EQ-0001", "EQ-0003"]


def test_only_active_sensors_remain_and_totals_count_all(spark):
    docs = documents(
        spark, document(1, sensors=[sensor(1), sensor(2, active=False)]), document(2, sensors=None)
    )
    active = registry.active_sensors(docs).filter("_id = 'EQ-0001'").first()
    assert [s.id for s in active.sensors] == ["SENS-00001"]
    assert registry.sensor_total(docs).first().sensors == 2


def test_active_factories(spark):
    rows = factories(spark, factory("A"), factory("B", active=False))
    assert ids(registry.active_factories(rows)) == ["A"]


@pytest.mark.parametrize(
    "schedule, due", [("weekly", "2024-02-07"), ("monthly", "2024-03-01"),
                      ("quarterly", "2024-04-30"), ("semiannual", "2024-07-29"), ("never", None)]
)
def test_next_maintenance(spark, schedule, due):
    doc = document(1, maintenance={"schedule": schedule, "last_maintenance": "2024-01-31", "next_maintenance": None})
    out = registry.maintenance_due(documents(spark, doc)).first()
    assert (out.next_maintenance and out.next_maintenance.isoformat()) == due


def test_documents_round_trip_as_json(spark, folder):
    docs = documents(spark, document(1), document(2, factory=None, sensors=[]))
    write_documents(docs, folder + "/registry")
    assert_same(docs, files.equipment(spark, folder + "/registry"))


def test_denormalize_embeds_and_drops_unknown_factories(spark):
    docs = documents(spark, document(1), document(2, factory_id="FAB-XX-99"))
    out = registry.denormalize(docs, factories(spark, factory("FAB-SP-01", "New"))).collect()
    assert [(r["_id"], r.factory.id, r.factory.name, r.factory.location.lat) for r in out] == [
        ("EQ-0001", "FAB-SP-01", "New", 1.0)
    ]


def test_refresh_changes_only_renamed_factories(spark):
    docs = documents(spark, document(1), document(2, factory_id="FAB-RJ-01"))
    changed = factories(spark, factory("FAB-SP-01", "Renamed"))
    out = {r["_id"]: r.factory for r in registry.refresh_factory_names(docs, changed).collect()}
    assert out["EQ-0001"].name == "Renamed" and out["EQ-0001"].location.lat == -23.5
    assert out["EQ-0002"].name == "São Paulo"


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    base = documents(spark, document(1), document(2))
    incoming = documents(spark, document(2, name="Changed"), document(3))
    once = registry.upsert(base, incoming)
    assert {r["_id"]: r.name for r in once.collect()} == {
        "EQ-0001": "Pump 1", "EQ-0002": "Changed", "EQ-0003": "Pump 3",
    }
    assert_same(once, registry.upsert(once, incoming))


def test_upsert_checks_only_the_incoming_side(spark):
    base = documents(spark, document(1, status="broken"), document(2))
    incoming = documents(spark, document(2, type="motor2"), document(3))
    out = registry.upsert(base, incoming, valid=quality.obeys(quality.equipment_rules()))
    assert {r["_id"]: (r.status, r.type) for r in out.collect()} == {
        "EQ-0001": ("broken", "pump"), "EQ-0002": ("active", "pump"), "EQ-0003": ("active", "pump"),
    }


def test_newest_of_repeated_deliveries_wins(spark):
    base = documents(spark, document(1))
    versions = [document(1, name=f"v{i}") for i in (2, 9, 4)]
    incoming = spark.createDataFrame(
        [{**d, "v": int(d["name"][1:])} for d in versions], schemas.EQUIPMENT + ", v int"
    )
    out = registry.upsert(base, incoming, version="v").collect()
    assert [r.name for r in out] == ["v9"]
    # without a version: still one document, the same one each time
    out = registry.upsert(base, incoming.drop("v")).collect()
    assert [r.name for r in out] == ["v9"]


def test_no_delivered_document_is_lost_silently(spark, folder):
    from plantlake.plans import ingest
    from plantlake.sources import files

    delivered = documents(
        spark, document(1), document(1, name="Again"), document(2, type="motor2"), document(3, factory_id="X"),
    )
    path = folder + "/registry"
    out = ingest.build_registry(
        documents(spark, document(9)), delivered, factories(spark, factory("FAB-SP-01")), path, folder + "/rejects"
    )
    assert {r.measure: r.n for r in out.collect() if r.measure != "sensors"} == {
        "equipment": 2, "delivered": 4, "accepted": 1, "superseded": 1, "refused": 2,
    }
    rejects = spark.read.json(folder + "/rejects")
    assert {r["_id"]: r.reasons for r in rejects.collect()} == {
        "EQ-0002": ["type"], "EQ-0003": ["unknown_factory"],
    }
    assert sorted(r["_id"] for r in files.equipment(spark, path).collect()) == ["EQ-0001", "EQ-0009"]


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"name": None}, "required"), ({"installed_at": None}, "required"),
        ({"type": "motor2"}, "type"), ({"status": "gone"}, "status"),
        ({"sensors": []}, "sensor_count"), ({"sensors": [sensor(i) for i in range(51)]}, "sensor_count"),
        ({"sensors": [sensor(1, unit=None)]}, "sensor_fields"),
        ({"factory": {"id": "A", "name": None, "location": {"lat": 1.0, "lng": 1.0}}}, "factory_fields"),
    ],
)
def test_equipment_contract(spark, change, rule):
    out = quality.report(documents(spark, document(1, **change)), quality.equipment_rules())
    assert [r.rule for r in out.collect() if not r.passed] == [rule]


def test_fifty_sensors_are_allowed(spark):
    docs = documents(spark, document(1, sensors=[sensor(i) for i in range(50)]))
    assert all(r.passed for r in quality.report(docs, quality.equipment_rules()).collect())


def test_factory_contract(spark):
    bad = {**factory("A"), "location": {"lat": None, "lng": 1.0}}
    out = quality.report(factories(spark, bad, factory("B")), quality.factory_rules()).collect()
    assert {r.rule: r.failed for r in out} == {"required": 0, "location": 1}


def test_range_flag_stands_beside_the_event_flag(spark):
    ranges = registry.sensor_ranges(documents(spark, document(1)))
    rows = silver.clean(
        events(
            spark,
            reading(1, value=70.0), reading(2, value=70.01, is_anomaly=False),
            reading(3, sensor_id="SENS-00002", measurement_type="vibration", value=0.0, is_anomaly=True),
            reading(4, sensor_id="SENS-09999"),
        )
    )
    out = registry.flag_out_of_range(rows, ranges).orderBy("event_id").collect()
    assert [(r.out_of_range, r.is_anomaly) for r in out] == [
        (False, False), (True, False), (False, True), (None, False),
    ]


def test_range_join_is_the_same_by_broadcast_and_by_salted_shuffle(spark, sf_dir):
    rows = silver.clean(feeds.sensor_events(feeds.table(spark, sf_dir, "events")))
    ranges = registry.sensor_ranges(feeds.equipment(feeds.table(spark, sf_dir, "customer")))
    assert_same(
        registry.flag_out_of_range(rows, ranges),
        registry.flag_out_of_range(rows, ranges, max_broadcast_bytes=0),
    )


def test_unknown_factories_include_missing_ones(spark):
    rows = events(spark, reading(1), reading(2, factory_id=None), reading(3, factory_id="X"), reading(4, factory_id="X"))
    out = registry.unknown_factories(rows, factories(spark, factory("FAB-SP-01")))
    assert {r.factory_id: r.events for r in out.collect()} == {None: 1, "X": 2}


def test_factory_conflicts_between_sources(spark):
    layout = "equipment_id string, factory_id string"
    a = spark.createDataFrame([("E1", "A"), ("E2", "A"), ("E2", "A")], layout)
    b = spark.createDataFrame([("E1", "B"), ("E2", "A"), ("E3", None)], layout)
    out = registry.factory_conflicts(erp=a, registry=b).collect()
    assert sorted((r.equipment_id, r.source, r.factory_id, r.factories) for r in out) == [
        ("E1", "erp", "A", 2), ("E1", "registry", "B", 2)
    ]


def test_no_python_udf_in_the_range_join(spark, sf_dir):
    rows = feeds.sensor_events(feeds.table(spark, sf_dir, "events"))
    ranges = registry.sensor_ranges(feeds.equipment(feeds.table(spark, sf_dir, "customer")))
    plan = registry.flag_out_of_range(rows, ranges).select(F.col("out_of_range"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
