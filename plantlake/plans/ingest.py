"""Feeds → Bronze, and the registry build, as whole steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.operators import bronze, quality, registry
from plantlake.session import fresh_path
from plantlake.sinks import files as sinks
from plantlake.sinks.folders import Folders
from plantlake.sources.files import equipment, equipment_snapshots, erp


def ingest_erp(table: DataFrame, day: str, path: str) -> bool:
    """One day of the ERP table; False, and nothing written, when it had no events."""
    return sinks.land_erp(bronze.erp_records(bronze.on_date(table, "event_date", day)), path)


class ExtractMarks:
    """How far a source has been read: JSON lines of turn and mark (microseconds since 1970); the last turn counts."""

    SCHEMA = "turn long, mark long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def last(self) -> tuple[int, int | None]:
        """The last turn (0 before the first note) and its mark."""
        if not Folders(self.spark, self.path).exists(self.path):
            return 0, None
        noted = self.spark.read.schema(self.SCHEMA).json(self.path)
        row = noted.agg(F.max("turn").alias("turn"), F.max_by("mark", "turn").alias("mark")).first()
        return row["turn"] or 0, row["mark"]

    def note(self, turn: int, mark: int | None) -> None:
        row = self.spark.createDataFrame([(turn, mark)], self.SCHEMA)
        row.coalesce(1).write.mode("append").json(self.path)


def ingest_erp_since(
    table: DataFrame, path: str, marks: str, as_of: str, overlap: str = "INTERVAL 3 DAYS", grain: str = "day"
) -> int:
    """Land what the ERP table holds beyond the last mark; the number of rows landed.

    Read are the rows created since the mark less ``overlap``, so that those
    which became visible late are met, and those without a creation time; the
    predicate reaches the source. Rows that lie in Bronze already are left out,
    copies by their number. The mark then moves to the newest creation time, but never
    back and never past ``as_of``: a clock that runs ahead hides nothing. Rows that
    become visible later than ``overlap`` after newer ones are not met.

    A run that fails is simply repeated: the mark moves only after landing, and
    what had been landed is recognised. One writer at a time.
    """
    spark = table.sparkSession
    noted = ExtractMarks(spark, marks)
    turn, mark = noted.last()
    created = F.col("created_at")
    if mark is not None:
        start = F.timestamp_micros(F.lit(mark)) - F.expr(overlap)
        table = table.where(created.isNull() | (created >= start))
    read = bronze.erp_records(table).withColumn("run_date", sinks.run_date("event_date", grain))
    read = _stored(read.withColumn("created", F.to_timestamp("created_at")), "extract")
    new = read.drop("created")
    if Folders(spark, path).exists(path):
        # days of the calendar, however many rows: only their folders are read
        days = F.broadcast(new.select(F.col("run_date").alias("day")).distinct())
        landed = erp(spark, path).withColumn("run_date", F.col("run_date").cast("date"))
        landed = landed.join(days, F.col("run_date").eqNullSafe(F.col("day")), "left_semi")
        new = new.exceptAll(landed.select(*new.columns))
    new = _stored(new, "extract-new")
    sinks.land_by_run_date(new, path, "append")
    limit = F.lit(as_of).cast("timestamp")
    # row by row, as ``least`` passes over nulls
    newest = F.max(F.when(F.col("created").isNotNull(), F.least("created", limit)))
    newest = read.agg(F.unix_micros(newest)).first()[0]
    noted.note(turn + 1, max((m for m in (newest, mark) if m is not None), default=None))
    return new.count()


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """Written once and read back: the source is asked once, and later steps see the same rows."""
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ingest_maintenance(
    records: DataFrame, day: str, path: str, landed_at: Column | None = None
) -> bool:
    """One day's maintenance snapshot, stamped with its landing time."""
    stamp = F.current_timestamp() if landed_at is None else landed_at
    snapshot = bronze.on_date(records, "scheduled_date", day).withColumn("landed_at", stamp)
    return sinks.land_maintenance(snapshot, path)


def build_registry(
    base: DataFrame,
    incoming: DataFrame,
    factories: DataFrame,
    path: str,
    rejects: str | None = None,
    version: str | None = None,
) -> DataFrame:
    """Embed factories in the delivered documents, check them, upsert, write a new snapshot.

    Refused documents are written to ``rejects`` with their reasons. Of a key
    delivered more than once the last by ``version`` counts. Returns (measure,
    n): the snapshot's equipment and sensors, and what became of the delivery;
    accepted, superseded and refused documents add up to those delivered.
    """
    assessed = registry.assessed(incoming, factories, quality.equipment_rules())
    if rejects:
        sinks.write_documents(assessed.where(F.size("reasons") > 0), rejects)
    accepted = assessed.where(F.size("reasons") == 0).drop("reasons")
    sinks.write_documents(registry.upsert(base, accepted, version=version), path)
    total = registry.sensor_total(equipment(base.sparkSession, path))
    return _measures(total).unionByName(_measures(delivery_totals(assessed)))


class RangeVersions:
    """The dated ranges of a folder of registry snapshots, worked out anew only when its files have changed.

    The files are listed before they are read: what changes meanwhile is met by
    the next call.
    """

    def __init__(self, root: str):
        self.root, self._seen, self._kept = root, None, None

    def read(self, spark: SparkSession) -> DataFrame:
        """As :func:`registry.dated_ranges` over the snapshots as they lie there now."""
        seen = Folders(spark, self.root).files(self.root)
        if self._kept is None or seen != self._seen:
            ranges, path = registry.dated_ranges(equipment_snapshots(spark, self.root)), fresh_path(spark, "ranges")
            ranges.write.parquet(path)
            self._seen, self._kept = seen, (ranges.schema, path)
        layout, path = self._kept
        return spark.read.schema(layout).parquet(path)


def delivery_totals(assessed: DataFrame) -> DataFrame:
    """delivered = accepted + superseded + refused, for :func:`registry.assessed` documents."""
    fine = F.size("reasons") == 0
    return assessed.agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_distinct(F.when(fine, F.col("_id"))).alias("accepted"),
        F.count_if(~fine).alias("refused"),
    ).withColumn("superseded", F.expr("delivered - accepted - refused"))


def _measures(row: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("n")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))
