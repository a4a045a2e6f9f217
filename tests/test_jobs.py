"""Whole jobs, serving, session settings, and rules the library keeps."""

import ast
import os

import pytest
from helpers import assert_same, events, line, messages, reading
from pyspark.sql import functions as F

from plantlake import session
from plantlake.functions.scalars import clamp, display_name, padded, round_robin
from plantlake.operators import gold, silver
from plantlake.plans import feeds
from plantlake.plans.daily import _in_months, run_daily, silver_to_gold, update_silver
from plantlake.sinks.files import BY_MONTH, write_silver
from plantlake.sinks.serving import counted, serving_options
from plantlake.sources import files
from plantlake.streaming import landing_job

PACKAGE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "plantlake")


def test_daily_chain_equals_the_direct_plan_and_reruns_safely(spark, sf_dir, folder):
    bronze = feeds.sensor_events(feeds.table(spark, sf_dir, "events"))
    direct = gold.hourly(silver.clean(bronze))
    for fmt in ("json", "parquet"):
        paths = (f"{folder}/{fmt}/silver", f"{folder}/{fmt}/gold")
        for _ in range(2):
            assert run_daily(spark, bronze, *paths, silver_format=fmt)
        rounded = [F.round(c, 6).alias(c) if t == "double" else c for c, t in direct.dtypes]
        assert_same(direct.select(*rounded), files.gold(spark, paths[1]).select(*rounded))


def test_recomputing_recent_months_is_exact_and_leaves_the_rest(spark, folder):
    silver_path, gold_path = folder + "/silver", folder + "/gold"
    months = [reading(m, timestamp=f"2024-{m:02d}-03T00:00:00+00:00") for m in (3, 4, 5)]
    late = reading(9, timestamp="2024-04-03T00:10:00+00:00", value=90.0)

    def write(*rows):
        clean = silver.clean(events(spark, *rows))
        write_silver(clean, silver_path, partition_by=BY_MONTH)
        return files.silver(spark, silver_path)

    silver_to_gold(write(*months), gold_path)
    march = gold_path + "/year=2024/month=3/factory_id=FAB-SP-01"
    untouched = sorted(os.listdir(march))
    rows = write(*months, late)
    silver_to_gold(rows, gold_path, since="2024-04")
    assert sorted(os.listdir(march)) == untouched
    assert_same(gold.hourly(rows), files.gold(spark, gold_path))
    recent = rows.filter(F.col("year") * 100 + F.col("month") >= 202404)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_a_factory_that_vanished_is_gone_after_an_incremental_run(spark, folder):
    def clean(*rows):
        return silver.clean(events(spark, *rows))

    both = clean(reading(1), reading(2, factory_id="FAB-RJ-01"))
    silver_to_gold(both, folder + "/gold")
    one = clean(reading(1))
    silver_to_gold(one, folder + "/gold", since="2024-05")
    assert_same(gold.hourly(one), files.gold(spark, folder + "/gold"))
    silver_to_gold(one.limit(0), folder + "/gold", since="2024-05")
    assert files.gold(spark, folder + "/gold").count() == 0


def test_arrivals_day_by_day_equal_one_full_run(spark, folder):
    """Late readings of older months, copies that move an event to another month, reruns."""
    def on(day, number, **more):
        return reading(number, timestamp=f"2024-{day}T00:00:00+00:00", **more)

    days = [
        [on("03-05", 1), on("04-05", 2), on("05-05", 3), on("05-06", 4, factory_id="FAB-RJ-01")],
        [on("04-06", 5), on("03-05", 1), on("02-01", 4, factory_id="FAB-RJ-01")],  # 4 moves to February
        [on("05-05", 3, value=-1.0), on("06-01", 6), on("06-09", 2)],  # a smaller copy of 3, a later one of 2
    ]
    arrived, paths = [], (folder + "/silver", folder + "/gold")
    for k, rows in enumerate(days):
        batch = events(spark, *rows)
        arrived += rows
        for _ in range(2):
            assert run_daily(spark, batch, *paths, silver_format="parquet", incremental=True)
        full = silver.clean(events(spark, *arrived))
        assert_same(full, files.silver(spark, paths[0], "parquet"))
        assert_same(gold.hourly(full), files.gold(spark, paths[1]))
    empty = events(spark, reading(1, sensor_id=None))
    assert run_daily(spark, empty, *paths, silver_format="parquet", incremental=True) is False


def test_only_touched_months_are_read_and_written(spark, folder):
    path = folder + "/silver"
    first = events(spark, *[reading(m, timestamp=f"2024-{m:02d}-03T00:00:00+00:00") for m in (3, 4, 5)])
    update_silver(first, path)
    march = path + "/year=2024/month=3/factory_id=FAB-SP-01"
    untouched = sorted(os.listdir(march))
    assert update_silver(events(spark, reading(8, timestamp="2024-04-09T00:00:00+00:00")), path) == {(2024, 4)}
    assert sorted(os.listdir(march)) == untouched
    plan = files.silver(spark, path, "parquet").where(_in_months({(2024, 4)}))
    filters = plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "month" in filters.split("], PushedFilters")[0]


def test_bronze_arrivals_are_pruned_by_factory_and_day(spark, folder):
    landed = spark.createDataFrame([("{}", "F", "2024", "05", d) for d in ("01", "02")], "value string, factory_id string, year string, month string, day string")
    landed.write.partitionBy("factory_id", "year", "month", "day").text(folder + "/b")
    rows = files.bronze_sensors(spark, folder + "/b", "F", "2024-05-02")
    filters = rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("], DataFilters")[0]
    assert "factory_id" in filters and "make_date" in filters and rows.count() == 1


def test_daily_chain_stops_without_sensor_rows(spark, folder):
    empty = events(spark, reading(1, sensor_id=None))
    assert run_daily(spark, empty, folder + "/s", folder + "/g") is False
    assert not os.path.exists(folder + "/s") and not os.path.exists(folder + "/g")


def test_rows_are_counted_in_the_pass_that_writes_them(spark, folder):
    rows, seen = counted(spark.range(123))
    rows.write.parquet(folder + "/out")
    assert seen.get["rows"] == 123


def test_serving_options_keep_the_table_and_bound_connections():
    options = serving_options("jdbc:x:y", {"user": "u"}, 8)
    assert options["dbtable"] == "gold_equipment_metrics"
    assert options["truncate"] == "true" and options["numPartitions"] == "8"


def test_working_folder_comes_from_the_session(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.fresh_path(spark, "x").startswith(configured)
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


class Cluster:
    """A session that is not local and has no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://somewhere:7077"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        session.shared_folder(Cluster)


def test_scalars(spark):
    row = spark.range(1).select(
        padded(F.lit(7), 4).alias("short"),
        padded(F.lit(123456), 4).alias("long"),
        display_name(F.lit("compressor"), F.lit(1)).alias("name"),
        F.array(*[round_robin(F.lit(i), ["a", "b", "c"]) for i in (1, 2, 3, 4)]).alias("turns"),
        clamp(F.lit(71.239), F.lit(30.0), F.lit(70.0)).alias("high"),
        clamp(F.lit(33.3333), F.lit(30.0), F.lit(70.0)).alias("inside"),
    ).first()
    assert (row.short, row.long, row.name) == ("0007", "123456", "Compressor 1")
    assert row.turns == ["a", "b", "c", "a"]
    assert (row.high, row.inside) == (70.0, 33.33)


def sources():
    for at, folders, names in os.walk(PACKAGE):
        folders[:] = [f for f in folders if f != "llm"]
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(at, name)) as f:
                    yield os.path.join(at, name), f.read()


def test_library_collects_nothing_and_has_no_udf():
    """The command line may: it prints reports."""
    banned = {"collect", "toPandas", "toLocalIterator", "localCheckpoint", "crossJoin", "coalesce_files", "udf", "pandas_udf"}
    for path, text in sources():
        calls = {
            node.func.attr
            for node in ast.walk(ast.parse(text))
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute)
        }
        assert path.endswith("__main__.py") or not calls & banned, path


def test_decoded_feed_equals_the_lines(spark, sf_dir):
    from plantlake.functions.records import decode_events

    table = feeds.table(spark, sf_dir, "events")
    assert_same(feeds.sensor_events(table), decode_events(feeds.sensor_lines(table)))


def test_jobs_run_from_the_command_line(spark, sf_dir, folder, capsys):
    from plantlake.__main__ import main

    feeds.sensor_lines(feeds.table(spark, sf_dir, "events")).write.text(folder + "/bronze")
    main(["silver", "--bronze", folder + "/bronze", "--silver", folder + "/silver", "--mixed"])
    main(["gold", "--silver", folder + "/silver", "--gold", folder + "/gold"])
    main(["chain", "--bronze", folder + "/bronze", "--silver", folder + "/s2",
          "--gold", folder + "/g2", "--mixed", "--format", "parquet"])
    assert files.gold(spark, folder + "/gold").count() == files.gold(spark, folder + "/g2").count()
    with pytest.raises(SystemExit) as failed:
        main(["check", "--bronze", folder + "/bronze"])
    assert failed.value.code == 1 and "FAIL event_id_uuid" in capsys.readouterr().out


def test_the_quality_gate_passes_clean_lines_and_stops_repeats(spark, folder, capsys):
    from plantlake.__main__ import main

    def bronze(name, numbers):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/a.json", "w") as f:
            f.write("".join(line(k) + "\n" for k in numbers))
        return ["check", "--bronze", f"{folder}/{name}"]

    main(bronze("clean", range(300)))
    assert "FAIL" not in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(bronze("repeats", [*range(100), 1, 2]))
    assert "FAIL duplicate_rate: 2 of 102" in capsys.readouterr().out
    main(bronze("none", []))


def test_a_contract_document_is_checked(spark, folder, capsys):
    from plantlake.__main__ import main

    os.makedirs(f"{folder}/bronze")
    with open(f"{folder}/bronze/a.json", "w") as f:
        f.write(line(1) + "\n" + line(2, value="high") + "\n")
    with open(f"{folder}/contract.json", "w") as f:
        f.write('{"required": ["unit"], "properties": {"value": {"type": "number"}}}')
    with pytest.raises(SystemExit):
        main(["check", "--bronze", f"{folder}/bronze", "--contract", f"{folder}/contract.json"])
    out = capsys.readouterr().out
    assert "FAIL valid:value: 1 of 2" in out and "ok   required:unit: 0 of 2" in out


def test_closed_days_are_packed(spark, folder, capsys):
    from plantlake.__main__ import main

    day = F.lit("2024-05-01").cast("timestamp")
    rows = landing_job.landing_rows(messages(spark, [line(k) for k in range(40)]).repartition(8), day)
    rows.write.partitionBy(*landing_job.PARTITIONS).text(f"{folder}/landed")
    main(["compact", "--landed", f"{folder}/landed", "--packed", f"{folder}/packed", "--day", "2024-05-02"])
    assert "files: 1\n" in capsys.readouterr().out
    assert spark.read.text(f"{folder}/packed").count() == 40


def test_secrets_come_from_a_file(folder):
    from plantlake.__main__ import options_of

    with open(folder + "/secrets", "w") as f:
        f.write("# database\npassword=a=b\nuser=x\n\n")
    assert options_of(["user=y"], folder + "/secrets") == {"password": "a=b", "user": "y"}


def test_ingest_steps(spark, sf_dir, folder):
    from plantlake.plans import ingest

    erp = feeds.erp_table(feeds.table(spark, sf_dir, "orders"))
    day = erp.first().event_date.isoformat()
    assert ingest.ingest_erp(erp, day, folder + "/erp")
    assert not ingest.ingest_erp(erp, "1900-01-01", folder + "/none")
    landed = files.erp(spark, folder + "/erp")
    assert landed.count() == erp.filter(F.col("event_date") == day).count()

    records = feeds.maintenance_records(feeds.table(spark, sf_dir, "lineitem")).drop("landed_at")
    day = records.first().scheduled_date.isoformat()
    for _ in range(2):
        assert ingest.ingest_maintenance(records, day, folder + "/maintenance")
    snapshots = files.maintenance(spark, folder + "/maintenance")
    assert snapshots.select("landed_at").distinct().count() == 2


def test_every_job_has_a_command_line():
    from plantlake.__main__ import options_of, parser

    args = parser().parse_args(
        ["serve", "--gold", "g", "--url", "jdbc:x:y", "--property", "user=u", "--property", "a=b=c"]
    )
    assert options_of(args.property) == {"user": "u", "a": "b=c"}
    for job in (
        ["alerts", "--servers", "s", "--path", "p", "--checkpoint", "c", "--console"],
        ["land", "--servers", "s", "--path", "p", "--checkpoint", "c", "--writers", "4"],
        ["erp", "--url", "u", "--day", "2024-01-01", "--path", "p"],
        ["maintenance", "--snapshot", "s", "--day", "2024-01-01", "--path", "p"],
        ["registry", "--base", "b", "--incoming", "i", "--factories", "f", "--path", "p"],
        ["gold", "--silver", "s", "--gold", "g", "--since", "2024-04"],
        ["chain", "--bronze", "b", "--silver", "s", "--gold", "g", "--since", "2024-04-01", "--factory", "F"],
        ["land", "--servers", "s", "--path", "p", "--checkpoint", "c", "--max-offsets", "9", "--min-partitions", "2"],
        ["erp", "--url", "u", "--day", "2024-01-01", "--path", "p", "--parts", "8", "--properties", "f"],
    ):
        assert callable(parser().parse_args(job).run)


def test_registry_job_builds_and_updates_snapshots(spark, sf_dir, folder):
    from plantlake.__main__ import main
    from plantlake.sinks.files import write_documents

    write_documents(feeds.equipment(feeds.table(spark, sf_dir, "customer")), folder + "/in")
    write_documents(feeds.factories(feeds.table(spark, sf_dir, "supplier")), folder + "/factories")
    shared = ["registry", "--incoming", folder + "/in", "--factories", folder + "/factories"]
    main([*shared, "--path", folder + "/first"])
    main([*shared, "--base", folder + "/first", "--path", folder + "/second"])
    first, second = files.equipment(spark, folder + "/first"), files.equipment(spark, folder + "/second")
    assert first.count() > 0
    assert_same(first, second)


def test_raw_lines_skip_blank_ones(spark, folder):
    os.makedirs(folder + "/factory_id=A")
    with open(folder + "/factory_id=A/a.json", "w") as f:
        f.write('{"event_id": 1}\n\n   \n{broken\n')
    assert sorted(r.value for r in files.raw_lines(spark, folder).collect()) == ['{"event_id": 1}', "{broken"]


def test_an_unset_folder_reads_as_none(spark):
    assert spark.conf.get("spark.sql.streaming.checkpointLocation", None) is None
