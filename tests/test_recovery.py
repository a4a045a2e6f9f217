"""Runs that stop anywhere: the next one ends what they began; expiry removes folders."""

import pytest
from pyspark.sql import functions as F

from helpers import assert_same, events, reading
from plantlake.plans import daily
from plantlake.plans.ledger import RunLedger
from plantlake.sinks import files as sinks
from plantlake.sinks.folders import Folders
from plantlake.sources import files


class Stopped(Exception):
    pass


def chain(spark, arrived, root):
    return daily.run_daily(spark, arrived, f"{root}/silver", f"{root}/gold", silver_format="parquet", incremental=True)


def arrivals(spark):
    """The second arrival moves event 2 from May to April, empties June and fills March."""
    first = events(
        spark,
        reading(1, timestamp="2024-04-01T00:00:00+00:00"),
        reading(2, timestamp="2024-05-02T00:00:00+00:00"),
        reading(3, timestamp="2024-05-03T00:00:00+00:00"),
        reading(4, timestamp="2024-06-03T00:00:00+00:00"),
    )
    second = events(
        spark,
        reading(2, timestamp="2024-04-02T00:00:00+00:00"),
        reading(4, timestamp="2024-03-03T00:00:00+00:00"),
    )
    return first, second


def stop_at(monkeypatch, step):
    """The named step of the second run fails once."""
    calls = {"n": 0}

    def failing(real, when):
        def run(*args, **kwargs):
            calls["n"] += 1
            if calls["n"] == when:
                raise Stopped
            return real(*args, **kwargs)

        return run

    name, when = step
    owner = {"note": RunLedger, "move": Folders, "drop": Folders}.get(name, daily)
    monkeypatch.setattr(owner, name, failing(getattr(owner, name), when))


#: Before anything is noted, within Silver's and Gold's swaps, between the notes.
STEPS = [
    ("note", 1), ("move", 1), ("move", 2), ("move", 5), ("drop", 2), ("note", 2), ("silver_to_gold", 1),
    ("move", 8), ("note", 3),
]


@pytest.fixture(scope="module")
def clean_run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    for arrived in arrivals(spark):
        assert chain(spark, arrived, root)
    return files.silver(spark, f"{root}/silver", "parquet"), files.gold(spark, f"{root}/gold")


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    """A chain after its first arrival, to be copied for each step."""
    root = str(tmp_path_factory.mktemp("first"))
    chain(spark, arrivals(spark)[0], root)
    return root


@pytest.mark.parametrize("step", STEPS, ids=lambda s: f"{s[0]}-{s[1]}")
def test_a_run_that_stops_is_ended_by_the_next(spark, folder, first_run, clean_run, monkeypatch, step):
    import shutil

    root = shutil.copytree(first_run, f"{folder}/copy")
    second = arrivals(spark)[1]
    with monkeypatch.context() as patch:
        stop_at(patch, step)
        try:
            chain(spark, second, root)
        except Stopped:
            pass
    assert chain(spark, second, root) in (True, False)
    silver, gold = clean_run
    assert_same(files.silver(spark, f"{root}/silver", "parquet"), silver)
    assert_same(files.gold(spark, f"{root}/gold"), gold)
    assert RunLedger(spark, f"{root}/silver_runs").pending() == []


def test_the_next_arrival_ends_it_as_well(spark, folder, clean_run, monkeypatch):
    """May's Gold forgets an event that moved, though the next run brings nothing of May."""
    first, second = arrivals(spark)
    chain(spark, first, folder)
    with monkeypatch.context() as patch:
        stop_at(patch, ("silver_to_gold", 1))
        with pytest.raises(Stopped):
            chain(spark, second, folder)
    other = events(spark, reading(9, timestamp="2024-07-01T00:00:00+00:00"))
    assert chain(spark, other, folder)
    gold = files.gold(spark, f"{folder}/gold")
    assert {(r.month, r.event_count) for r in gold.collect()} == {(3, 1), (4, 1), (5, 1), (7, 1)}
    assert gold.count() == 5


def test_ledger_is_empty_before_the_first_run(spark, folder):
    ledger = RunLedger(spark, f"{folder}/runs")
    assert ledger.pending() == []
    ledger.note("silver", set())
    assert ledger.pending() == []


def test_last_note_of_a_month_counts(spark, folder):
    ledger = RunLedger(spark, f"{folder}/runs")
    ledger.note("staged", {(2024, 5): True, (2024, 6): False}, "somewhere")
    ledger.note("silver", {(2024, 5)})
    ledger.note("done", {(2024, 5)})
    assert [(p["month"], p["state"], p["filled"]) for p in ledger.pending()] == [(6, "staged", False)]


# --- expiry --------------------------------------------------------------------


def landed(spark, path, *days, grain="month"):
    rows = spark.createDataFrame([(k, d) for k, d in enumerate(days)], "id long, day string")
    rows = rows.select("id", F.col("day").cast("date").alias("event_date"))
    sinks.land_erp(rows, path, grain)
    return files.erp(spark, path)


def test_expiry_drops_rewrites_and_keeps(spark, folder):
    path = f"{folder}/erp"
    rows = landed(spark, path, "2023-01-05", "2023-02-14", "2023-02-15", "2023-02-28", "2023-03-01", None)
    kept_file = {f for f in rows.where("id = 4").inputFiles() if "2023-03" in f}
    plan = sinks.expire(rows, path, "2025-02-15", "event_date", "month")
    assert plan == [
        ("run_date=2023-01-01", "dropped"), ("run_date=2023-02-01", "rewritten"), ("run_date=2023-03-01", "kept"),
        ("run_date=__HIVE_DEFAULT_PARTITION__", "kept"),
    ]
    after = files.erp(spark, path)
    assert sorted(r.id for r in after.collect()) == [2, 3, 4, 5]
    assert kept_file <= set(after.inputFiles())  # not written again
    assert [a for _, a in sinks.expire(after, path, "2025-02-15", "event_date", "month")] == ["rewritten", "kept", "kept"]
    assert sorted(r.id for r in files.erp(spark, path).collect()) == [2, 3, 4, 5]


@pytest.mark.parametrize("grain, folders", [("day", 1), ("week", 1), ("quarter", 1), ("year", 1)])
def test_expiry_by_other_grains(spark, folder, grain, folders):
    path = f"{folder}/erp"
    rows = landed(spark, path, "2021-12-31", "2022-12-28", "2023-01-05", "2023-06-05", grain=grain)
    sinks.expire(rows, path, "2025-01-05", "event_date", grain)
    assert sorted(r.id for r in files.erp(spark, path).collect()) == [2, 3]


def test_a_folder_on_the_border_that_ends_empty_goes(spark, folder):
    path = f"{folder}/erp"
    rows = landed(spark, path, "2023-02-01", "2023-04-01")
    assert sinks.expire(rows, path, "2025-02-15", "event_date", "month")[0] == ("run_date=2023-02-01", "rewritten")
    assert Folders(spark, path).names(path) == ["run_date=2023-04-01"]


@pytest.mark.parametrize("when", range(1, 5))
def test_expiry_that_stops_loses_nothing(spark, folder, monkeypatch, when):
    path = f"{folder}/erp"
    rows = landed(spark, path, "2023-01-05", "2023-02-14", "2023-02-15", "2023-03-01")
    with monkeypatch.context() as patch:
        stop_at(patch, ("move", when))
        try:
            sinks.expire(rows, path, "2025-02-15", "event_date", "month")
        except Stopped:
            pass
    Folders(spark, path).restore(path)
    sinks.expire(files.erp(spark, path), path, "2025-02-15", "event_date", "month")
    assert sorted(r.id for r in files.erp(spark, path).collect()) == [2, 3]


def test_what_a_swap_sets_aside_is_not_read(spark, folder):
    rows = landed(spark, f"{folder}/erp", "2023-03-01", "2023-04-01")
    Folders(spark, folder).move(f"{folder}/erp/run_date=2023-03-01", f"{folder}/erp/.old-run_date=2023-03-01")
    assert [r.id for r in files.erp(spark, f"{folder}/erp").collect()] == [1] and rows.columns
    Folders(spark, folder).restore(f"{folder}/erp")
    assert files.erp(spark, f"{folder}/erp").count() == 2


def test_expiry_of_nothing(spark, folder):
    rows = landed(spark, f"{folder}/erp", "2023-03-01")
    assert sinks.expire(rows, f"{folder}/none", "2025-02-15", "event_date", "month") == []
    with pytest.raises(ValueError, match="grains"):
        sinks.expire(rows, f"{folder}/erp", "2025-02-15", "event_date", "hour")
