"""Jobs for ``spark-submit``/``python -m plantlake``; see ``--help`` of each."""

from __future__ import annotations

import argparse

from plantlake import schemas
from plantlake.operators import contracts, quality
from plantlake.plans import compaction, daily, ingest
from plantlake.session import build_session
from plantlake.sinks.files import BY_MONTH
from plantlake.sinks.serving import serve_gold
from plantlake.sources import files, jdbc, kafka
from plantlake.streaming import alerts_job, landing_job


def options_of(pairs: list[str], file: str | None = None) -> dict[str, str]:
    """KEY=VALUE pairs, those of a file included: secrets stay off the command line."""
    if file:
        with open(file, encoding="utf-8") as lines:
            pairs = [*(x.strip() for x in lines if "=" in x and not x.startswith("#")), *pairs]
    return dict(pair.split("=", 1) for pair in pairs)


def silver(spark, a):
    bronze = files.mixed_bronze(spark, a.bronze) if a.mixed else files.bronze_sensors(spark, a.bronze)
    by = BY_MONTH if a.by_month else None
    if not daily.bronze_to_silver(
        bronze, a.silver, fmt=a.format, max_files=a.max_files, partition_by=by
    ):
        print("no sensor rows in Bronze")


def gold(spark, a):
    daily.silver_to_gold(files.silver(spark, a.silver, a.format), a.gold, a.since)


def chain(spark, a):
    if a.since or a.factory:
        bronze = files.bronze_sensors(spark, a.bronze, a.factory, a.since)
    else:
        bronze = files.mixed_bronze(spark, a.bronze) if a.mixed else files.bronze_sensors(spark, a.bronze)
    incremental = a.incremental or bool(a.since or a.factory)
    daily.run_daily(spark, bronze, a.silver, a.gold, silver_format=a.format, incremental=incremental)


def serve(spark, a):
    rows = serve_gold(files.gold(spark, a.gold), a.url, options_of(a.property, a.properties), a.connections)
    print(f"{schemas.SERVING_TABLE}: {rows} rows")


def topic_of(a) -> dict:
    return {
        "max_offsets": a.max_offsets, "min_partitions": a.min_partitions,
        "extra": options_of(a.property, a.properties),
    }


def alerts(spark, a):
    messages = kafka.sensor_topic(spark, a.servers, start="latest", **topic_of(a))
    alerts_job.run_alerts(messages, a.path, a.checkpoint, a.console)


def land(spark, a):
    messages = kafka.sensor_topic(spark, a.servers, start="earliest", **topic_of(a))
    landing_job.start_landing(
        messages, a.path, a.checkpoint, writers_per_factory=a.writers
    ).awaitTermination()


def compact(spark, a):
    """Packs the days before ``--day``; prints the number of files written."""
    print("files:", compaction.compact(spark, a.landed, a.packed, a.day, a.megabytes << 20))


def erp(spark, a):
    options, split, ranges = options_of(a.property, a.properties), None, None
    if a.parts and a.even:
        ranges = jdbc.even_ranges(jdbc.equipment_events(spark, a.url, options), a.split_column, a.parts)
    elif a.parts:
        split = jdbc.split_options(a.split_column, a.low, a.high, a.parts)
    table = jdbc.equipment_events(spark, a.url, options, split=split, ranges=ranges)
    if a.marks:
        print("landed:", ingest.ingest_erp_since(table, a.path, a.marks, a.day, f"INTERVAL {a.overlap} DAYS"))
    else:
        ingest.ingest_erp(table, a.day, a.path)


def maintenance(spark, a):
    records = files.maintenance_snapshot(spark, a.snapshot)
    ingest.ingest_maintenance(records, a.day, a.path)


def registry(spark, a):
    first = spark.createDataFrame([], schemas.EQUIPMENT)
    ingest.build_registry(
        files.equipment(spark, a.base) if a.base else first,
        files.equipment_delivery(spark, a.incoming),
        files.factories(spark, a.factories),
        a.path,
        a.rejects,
        version=files.DELIVERED,
    ).show()


def check(spark, a):
    """Prints the report of all rules, or of a contract's; exits with 1 if one failed."""
    lines = files.raw_lines(spark, a.bronze)
    if a.contract:
        rules = contracts.compiled(contracts.load(spark, a.contract))
        found = quality.report(contracts.documents(lines), rules).collect()
    else:
        found = quality.gate(lines).collect()
    for rule in found:
        print(f"{'ok  ' if rule.passed else 'FAIL'} {rule.rule}: {rule.failed} of {rule.checked}")
    if not all(rule.passed for rule in found):
        raise SystemExit(1)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="plantlake")
    jobs = root.add_subparsers(required=True)

    def job(run, *paths, **extra):
        sub = jobs.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        for name, settings in extra.items():
            sub.add_argument(f"--{name.replace('_', '-')}", **settings)

    mixed, fmt = {"action": "store_true"}, {"choices": ["json", "parquet"], "default": "json"}
    props = {"action": "append", "default": [], "metavar": "KEY=VALUE"}
    secrets = {"metavar": "FILE", "help": "file of KEY=VALUE lines, for secrets"}
    flag, number = {"action": "store_true"}, {"type": int}
    topic = {"max_offsets": number, "min_partitions": number, "property": props, "properties": secrets}
    job(silver, "bronze", "silver", mixed=mixed, format=fmt, max_files={"type": int},
        by_month={"action": "store_true"})
    job(gold, "silver", "gold", format=fmt, since={"metavar": "YYYY-MM"})
    job(chain, "bronze", "silver", "gold", mixed=mixed, format=fmt, since={"metavar": "YYYY-MM-DD"},
        factory={}, incremental=flag)
    job(serve, "gold", "url", property=props, properties=secrets, connections={"type": int, "default": 16})
    job(alerts, "servers", "path", "checkpoint", console=flag, **topic)
    job(land, "servers", "path", "checkpoint", writers=number, **topic)
    job(compact, "landed", "packed", "day", megabytes={"type": int, "default": 256})
    job(erp, "url", "day", "path", property=props, properties=secrets, parts=number,
        split_column={"default": "id"}, low={"default": "0"}, high={"default": "1000000000"},
        even={**flag, "help": "ranges of equal size instead of equal width"},
        marks={"help": "land what was created since the last run, which is noted here"},
        overlap={"type": int, "default": 3, "help": "days read again for rows that became visible late"})
    job(maintenance, "snapshot", "day", "path")
    job(registry, "incoming", "factories", "path", base={"help": "current snapshot, if any"},
        rejects={"help": "where refused documents go, with their reasons"})
    job(check, "bronze", contract={"metavar": "FILE", "help": "a JSON Schema whose rules are checked instead"})
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"plantlake-{args.run.__name__}")
    args.run(spark, args)


if __name__ == "__main__":
    main()
