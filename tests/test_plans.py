"""Plans: how often the main queries shuffle, what they read, what is pushed down."""

import re

import pytest

from plantlake.plans.catalog import QUERIES


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("event_decode", 0),
        ("silver_clean", 1),  # the dedup
        ("gold_hourly", 2),  # the dedup and the rollup
        ("alerts_batch", 1),
        ("range_anomaly", 1),  # the dedup; the ranges are broadcast
        ("maintenance_latest", 1),
        ("dq_report", 0),
        ("dq_silver", 1),  # the check reuses the dedup's partitioning
        ("dq_duplicate_rate", 1),
        ("dash_trend", 1),
        ("registry_denormalize", 0),
        ("registry_refresh", 0),
        ("erp_extract", 0),
    ],
)
def test_shuffles_by_key(spark, sf_dir, name, shuffles):
    assert len(re.findall("Exchange hashpartitioning", plan_of(spark, sf_dir, name))) == shuffles


@pytest.mark.parametrize(
    "name, columns",
    [
        ("dq_duplicate_rate", {"event_id"}),
        ("unknown_factory", {"event_id", "user_id"}),
        ("dash_trend", {"o_orderkey", "o_totalprice", "o_orderdate"}),
        ("registry_sensor_total", {"c_custkey"}),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(spark, sf_dir, name)).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == columns


def test_day_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "erp_extract")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name, partial in (
        ("alerts_batch", "partial_avg"),
        ("gold_hourly", "partial_stddev_samp"),
        ("maintenance_latest", "partial_max"),
        ("dq_duplicate_rate", "partial_count"),
    ):
        assert partial in plan_of(spark, sf_dir, name)
