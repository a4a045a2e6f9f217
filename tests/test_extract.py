"""Extraction by high-water mark: late rows, reruns, clocks that run ahead, ranges of skewed ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantlake.plans import ingest
from plantlake.sinks import files as sinks
from plantlake.sources import files, jdbc

TABLE = (
    "id long, equipment_id string, factory_id string, event_type string, description string, "
    "technician string, cost decimal(10,2), event_date date, created_at timestamp"
)


def rows_of(spark, *rows):
    """Rows of (id, event day of January, hour of creation as 'day hour', or None)."""
    full = []
    for id_, day, created in rows:
        at = created and dt.datetime(2024, 1, *map(int, created.split()))
        full.append((id_, "EQ-1", "F", "inspection", "d", None, None, day and dt.date(2024, 1, day), at))
    return spark.createDataFrame(full, TABLE)


def ids(spark, path):
    return sorted((r.id for r in files.erp(spark, path).collect()), key=lambda i: (i is None, i))


def run(table, folder, **options):
    return ingest.ingest_erp_since(table, f"{folder}/erp", f"{folder}/marks", "2024-02-01", **options)


def test_late_rows_arrive_once_and_the_overlap_is_not_landed_again(spark, folder):
    first = [(1, 5, "5 10"), (2, 6, "6 10")]
    assert run(rows_of(spark, *first), folder) == 2
    late = [(3, 5, "4 9"), (4, 7, "7 1")]
    assert run(rows_of(spark, *first, *late), folder) == 2
    assert run(rows_of(spark, *first, *late), folder) == 0
    assert ids(spark, f"{folder}/erp") == [1, 2, 3, 4]


def test_rows_later_than_the_overlap_are_not_met(spark, folder):
    run(rows_of(spark, (1, 9, "9 0")), folder)
    assert run(rows_of(spark, (1, 9, "9 0"), (2, 1, "5 23"), (3, 1, "6 0")), folder) == 1
    assert ids(spark, f"{folder}/erp") == [1, 3]


def test_copies_nulls_and_empty_tables(spark, folder):
    table = rows_of(spark, (1, 5, "5 1"), (1, 5, "5 1"), (None, None, None), (7, 5, None))
    assert run(table.where("false"), folder) == 0
    assert run(table, folder) == 4
    assert run(table, folder) == 0
    assert run(table.union(rows_of(spark, (1, 5, "5 1"))), folder) == 1
    assert ids(spark, f"{folder}/erp") == [1, 1, 1, 7, None]


def test_a_clock_that_runs_ahead_hides_nothing(spark, folder):
    table = rows_of(spark, (1, 5, "5 1"))
    ahead = table.withColumns({"id": F.lit(2).cast("long"), "created_at": F.lit("2099-01-01").cast("timestamp")})
    run(table.union(ahead), folder)
    limit = spark.range(1).select(F.unix_micros(F.lit("2024-02-01").cast("timestamp"))).first()[0]
    assert ingest.ExtractMarks(spark, f"{folder}/marks").last() == (1, limit)
    assert run(table.union(ahead).union(rows_of(spark, (3, 6, "30 1"))), folder) == 1


@pytest.mark.parametrize("step", ["land_by_run_date", "note"])
def test_a_run_that_stopped_is_repeated(spark, folder, monkeypatch, step):
    first, both = rows_of(spark, (1, 5, "5 1")), rows_of(spark, (1, 5, "5 1"), (2, 6, "6 1"))
    run(first, folder)

    def stop(*args):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(*((sinks, step) if step != "note" else (ingest.ExtractMarks, step)), stop)
        with pytest.raises(InterruptedError):
            run(both, folder)
    run(both, folder)
    assert ids(spark, f"{folder}/erp") == [1, 2]


def test_ranges_of_skewed_ids_are_even_and_cover_every_row(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") < 8_000, F.col("id")).otherwise(F.col("id") * 100_000).alias("id"))
    rows = rows.union(spark.range(1_000).select(F.lit(None).cast("long")))
    sizes = [rows.where(p).count() for p in jdbc.even_ranges(rows, "id", 5)]
    assert sum(sizes) == 10_000 and len(sizes) == 5
    assert max(sizes) <= 1.1 * 1_800 + 1_000


def test_ranges_of_few_values(spark):
    same = spark.range(100).select(F.lit(7).cast("long").alias("id"))
    assert sum(same.where(p).count() for p in jdbc.even_ranges(same, "id", 4)) == 100
    assert jdbc.even_ranges(same.where("false"), "id", 4) == ["1 = 1"]
    assert jdbc.even_ranges(same, "id", 1) == ["1 = 1"]
