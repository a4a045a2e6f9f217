"""Steps whose cost must not outgrow the input: what passes the driver, is written, or is worked out twice."""

import pytest
from pyspark.sql import functions as F

from helpers import assert_same, events, reading
from plantlake.operators import joins, registry
from plantlake.plans import catalog, daily, ingest
from plantlake.sinks import files as sinks
from plantlake.sources import files
from plantlake.streaming import landing_job


@pytest.fixture
def tables(spark, folder):
    """Small ``events``, ``customer``, ``orders`` and ``lineitem`` tables."""
    n = F.col("id")
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    day = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(n.cast("int") % 90)
    spark.range(1200).select(
        n.alias("event_id"), day.alias("ts"), (n % 300).alias("user_id"),
        F.get(kinds, (n % 5).cast("int")).alias("event_type"), (n % 70).cast("double").alias("value"),
        F.format_string('{"k": %d}', n % 50).alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    spark.range(60).select(
        n.alias("c_custkey"), F.lit("MACHINERY").alias("c_mktsegment"), F.lit(1.0).alias("c_acctbal")
    ).write.parquet(f"{folder}/customer.parquet")
    spark.range(400).select(
        n.alias("o_orderkey"), (n % 60).alias("o_custkey"), F.lit(5.0).alias("o_totalprice"), day.alias("o_orderdate")
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(1500).select(
        (n % 400).alias("l_orderkey"), (n % 70).alias("l_partkey"), (n % 9).alias("l_suppkey"),
        (n % 4 + 1).cast("int").alias("l_linenumber"), F.lit(3.0).alias("l_quantity"), day.alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_ranges_are_worked_out_again_only_after_a_change(spark, folder, monkeypatch):
    calls, plain = [], registry.dated_ranges
    monkeypatch.setattr(registry, "dated_ranges", lambda docs: calls.append(1) or plain(docs))
    docs = catalog.feeds.equipment(spark.range(20).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment")))
    sinks.write_snapshot(docs, f"{folder}/r", "2024-01-01")
    versions = ingest.RangeVersions(f"{folder}/r")
    for _ in range(3):
        assert_same(plain(files.equipment_snapshots(spark, f"{folder}/r")), versions.read(spark))
    assert len(calls) == 1
    wider = F.transform("sensors", lambda s: s.withField("normal_range.max", s["normal_range"]["max"] + 1))
    for day in ("2024-01-02", "2024-01-01"):  # a new version, and one written again
        sinks.write_snapshot(docs.withColumn("sensors", wider), f"{folder}/r", day)
        assert_same(plain(files.equipment_snapshots(spark, f"{folder}/r")), versions.read(spark))
    assert len(calls) == 3


def test_the_stream_works_out_its_ranges_once_and_keeps_its_files_small(spark, tables, folder, monkeypatch):
    calls, plain = [], registry.dated_ranges
    monkeypatch.setattr(registry, "dated_ranges", lambda docs: calls.append(1) or plain(docs))
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, label: f"{folder}/{label}")
    monkeypatch.setattr(landing_job, "LARGE_FILES", 100)
    found = catalog.QUERIES["range_dated_stream"](spark, tables)
    assert found.count() == catalog._lines(spark, tables).count()
    assert len(calls) == 1
    topic = spark.read.text(f"{folder}/arrivals/topic")
    assert len(topic.inputFiles()) == 12
    assert max(r["count"] for r in topic.groupBy(F.input_file_name()).count().collect()) <= 150
    assert spark.read.parquet(f"{folder}/arrivals/split/marks/batch=3").count() == 1  # four triggers
    assert not sinks.Folders(spark, folder).exists(f"{folder}/arrivals/split/marks/batch=4")



@pytest.mark.parametrize("limit", [-1, 10**6])
def test_many_ids_of_an_arrival_do_not_pass_the_driver(spark, folder, monkeypatch, limit):
    first = events(spark, *[reading(k, timestamp=f"2024-0{k % 3 + 4}-01T00:00:00+00:00") for k in range(1, 30)])
    second = events(
        spark,
        *[reading(k, value=60.0, timestamp=f"2024-0{k % 2 + 3}-01T00:00:00+00:00") for k in range(20, 40)],
    )
    plans, stage = [], daily.replace_months

    def staged(rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stage(rows, *rest)

    monkeypatch.setattr(daily, "replace_months", staged)
    monkeypatch.setattr(daily, "MAX_IDS_BYTES", limit, raising=False)
    for arrived in (first, second):
        daily.update_silver(arrived, f"{folder}/silver")
    assert ("Broadcast" in plans[-1]) == (limit > 0)
    whole = daily.silver.clean(first.unionByName(second))
    assert_same(whole, files.silver(spark, f"{folder}/silver", "parquet"))


def test_the_mixed_tree_is_packed(spark, tables, folder, monkeypatch):
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, label: f"{folder}/{label}")
    monkeypatch.setattr(landing_job, "LARGE_FILES", 500)
    found = catalog.QUERIES["bronze_scan"](spark, tables)
    assert all(f.endswith(".gz") for f in found.inputFiles())
    per_file = files.mixed_bronze(spark, f"{folder}/mixed").groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 500
    lines = catalog._events(spark, tables).where("sensor_id is not null").drop("metadata")
    assert_same(lines, found.select(*lines.columns))


def test_hot_keys_are_counted_before_the_dedup(spark, tables, monkeypatch):
    counted, plain = [], joins.hot_keys

    def hot(rows, *rest):
        counted.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return plain(rows, *rest)

    monkeypatch.setattr(joins, "hot_keys", hot)
    large = catalog.QUERIES["range_anomaly_large"](spark, tables)
    assert len(counted) == 1 and "Aggregate" not in counted[0]
    assert_same(catalog.QUERIES["range_anomaly"](spark, tables), large)
