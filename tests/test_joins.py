"""The lookup join gives the same rows by broadcast and by salted shuffle."""

import pytest
from helpers import assert_same
from pyspark.sql import functions as F

from plantlake.operators.joins import _marked, hot_keys, lookup_join


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one key; some keys are unknown or null."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    )
    return spark.range(900).select(key.alias("k"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("hot", 1), (None, 2)] + [(f"k{i}", 10 + i) for i in range(0, 40, 2)], "k string, v int"
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_ways_agree_with_a_plain_join(spark, rows, table, how):
    plain = rows.join(table, "k", how)
    assert_same(plain, lookup_join(rows, table, ["k"], how))
    assert_same(plain, lookup_join(rows, table, ["k"], how, max_broadcast_bytes=0))
    for hot in (15, 200):
        salted = lookup_join(rows, table, ["k"], how, max_broadcast_bytes=0, hot_rows=hot, salts=8)
        assert_same(plain, salted.select(*plain.columns))


def test_small_tables_are_broadcast_and_big_ones_are_not(spark, rows, table):
    def plan(**options):
        return lookup_join(rows, table, ["k"], **options)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    # default settings: Spark itself would broadcast so small a table
    plain = plan(max_broadcast_bytes=0)
    assert "Broadcast" not in plain and "SortMergeJoin" in plain and "explode" not in plain
    salted = plan(max_broadcast_bytes=0, hot_rows=200)
    assert "SortMergeJoin [k" in salted and "_salt" in salted


def test_only_hot_keys_are_copied(spark, rows, table):
    found = hot_keys(rows, ["k"], 200).collect()
    assert [r.k for r in found] == ["hot"]
    salted = lookup_join(rows, table, ["k"], max_broadcast_bytes=0, hot_rows=200, salts=8)
    salted.collect()
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Generate explode") == 1
    marked = _marked(table, hot_keys(rows, ["k"], 200), ["k"])
    assert {r.k for r in marked.where("_hot").collect()} == {"hot"}


def test_copies_of_one_row_are_spread_over_the_salts(spark, table):
    """Equal rows leave the join from as many tasks as there are salts."""
    copies = spark.range(0, 4000, 1, numPartitions=16).select(F.lit("hot").alias("k"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(copies, table, ["k"], max_broadcast_bytes=0, hot_rows=1000, salts=8)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(t["count"] for t in tasks) == 4000
    assert len(tasks) >= 6 and max(t["count"] for t in tasks) <= 1500


def test_right_and_full_joins_are_refused(spark, rows, table):
    with pytest.raises(ValueError):
        lookup_join(rows, table, ["k"], "full")
