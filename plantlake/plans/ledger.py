"""What a run has begun and not ended, so that the next one ends it.

The ledger is an append-only folder of JSON lines. A month is pending from the
moment its new Silver content is complete beside the old one until its Gold has
been written; whatever step fails in between, the next run finds the month here.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "turn long, run string, state string, year int, month int, staged string, filled boolean"
Month = tuple[int, int]


class RunLedger:
    """One writer at a time, as for the chain itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).json(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def staging(self) -> str:
        """A new folder for content that is not in its place yet."""
        return f"{self.path}/staged/{uuid.uuid4().hex}"

    def pending(self) -> list[dict]:
        """The last entry of every month that is not done, in the order they were begun."""
        last = self.entries().groupBy("year", "month").agg(F.max_by(F.struct("*"), "turn").alias("last"))
        begun = last.select("last.*").where("state <> 'done'")
        # months, however many readings
        rows = begun.agg(F.array_sort(F.collect_list(F.struct("turn", "year", "month", "state", "staged", "filled")))).first()[0]
        return [r.asDict() for r in rows]

    def note(self, state: str, months: dict[Month, bool] | set[Month], staged: str | None = None) -> None:
        """One entry per month; ``months`` may tell which of them are filled."""
        if not months:
            return
        turn = (self.entries().agg(F.max("turn")).first()[0] or 0) + 1
        run = uuid.uuid4().hex
        rows = [
            (turn, run, state, y, m, staged, months[y, m] if isinstance(months, dict) else None)
            for y, m in sorted(months)
        ]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").json(f"{self.path}/log")
