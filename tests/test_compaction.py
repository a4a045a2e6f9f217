"""Closed days in few files, the same lines, whatever step fails."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from helpers import assert_same, line, messages
from plantlake.plans import compaction
from plantlake.sinks.folders import Folders
from plantlake.streaming import landing_job


def land(spark, folder, texts, day, files=1):
    """One landing trigger that leaves ``files`` small files or fewer in each folder of the day."""
    source = f"{folder}/topic/{day}-{len(glob.glob(folder + '/topic/*'))}"
    messages(spark, texts).repartition(files).write.text(source)
    stream = spark.readStream.text(f"{folder}/topic/*")
    landing_job.start_landing(
        stream, f"{folder}/landed", f"{folder}/check", interval=None, arrival=F.lit(day).cast("timestamp")
    ).awaitTermination()


def lines(spark, folder):
    return compaction.bronze_lines(spark, f"{folder}/landed", f"{folder}/packed").select("value", "factory_id", "day")


def packed_files(folder):
    return sorted(glob.glob(f"{folder}/packed/*/*/*/*/*.txt"))


@pytest.fixture
def landed(spark, folder):
    """Two days of some twenty files per factory each, and a day that is still open."""
    for day, start in (("2024-05-01", 0), ("2024-05-02", 500), ("2024-05-03", 900)):
        texts = [line(start + i, factory_id=f"FAB {i % 2}/ü") for i in range(200)] + ["not json", "not json"]
        land(spark, folder, texts, day, 10)
    return folder


def test_same_lines_in_few_files_each_near_the_target(spark, landed):
    before = lines(spark, landed).collect()
    small = compaction.landed_files(spark, f"{landed}/landed")
    biggest = small.agg(F.max("bytes")).first()[0]
    target = 3 * biggest
    count = compaction.compact(spark, f"{landed}/landed", f"{landed}/packed", "2024-05-03", target)
    files = packed_files(landed)
    assert count == len(files) < small.where("day <> '03'").count() / 2
    assert all(os.path.getsize(f) <= target + biggest for f in files)
    sizes = {tuple(r[:4]): r.b for r in small.where("day <> '03'").groupBy(*landing_job.PARTITIONS).agg(F.sum("bytes").alias("b")).collect()}
    assert len(files) <= sum(b // target + 1 for b in sizes.values())
    assert sorted(before) == sorted(lines(spark, landed).collect())
    assert not [f for f in files if "day=03" in f]


def test_later_runs_take_only_later_days(spark, landed):
    everything = lines(spark, landed).collect()
    paths = f"{landed}/landed", f"{landed}/packed"
    assert compaction.compact(spark, *paths, "2024-05-02") > 0
    first = packed_files(landed)
    times = [os.path.getmtime(f) for f in first]
    assert compaction.compact(spark, *paths, "2024-05-02") == 0
    assert compaction.compact(spark, *paths, "2024-05-04") > 0
    assert [os.path.getmtime(f) for f in first] == times
    land(spark, landed, [line(5000)], "2024-05-04")
    now = sorted(lines(spark, landed).collect())
    assert len(now) == len(everything) + 1 and now != sorted(everything)
    assert compaction._mark(spark, paths[1])[1] == datetime.date(2024, 5, 4)


@pytest.mark.parametrize("when", [1, 3])
def test_a_run_that_failed_is_repeated(spark, landed, monkeypatch, when):
    before = sorted(lines(spark, landed).collect())
    paths = f"{landed}/landed", f"{landed}/packed"
    real, calls = Folders.swap, []

    def failing(self, *args):
        calls.append(args)
        if len(calls) == when:
            raise OSError("stopped")
        return real(self, *args)

    monkeypatch.setattr(Folders, "swap", failing)
    with pytest.raises(OSError):
        compaction.compact(spark, *paths, "2024-05-03")
    assert sorted(lines(spark, landed).collect()) == before
    compaction.compact(spark, *paths, "2024-05-03")
    assert sorted(lines(spark, landed).collect()) == before


def test_closed_days_are_not_read_from_the_landing(spark, landed):
    compaction.compact(spark, f"{landed}/landed", f"{landed}/packed", "2024-05-03")
    plan = lines(spark, landed)._jdf.queryExecution().executedPlan().toString()
    pruned = [part for part in plan.split("PartitionFilters: [")[1:] if "make_date" in part.split("]")[0]]
    assert len(pruned) == 2  # one scan per tier


def test_nothing_landed(spark, folder):
    land(spark, folder, [line(1)], "2024-05-01")
    assert compaction.compact(spark, f"{folder}/landed", f"{folder}/packed", "2024-04-01") == 0
    assert_same(lines(spark, folder), lines(spark, folder))
    assert lines(spark, folder).count() == 1
