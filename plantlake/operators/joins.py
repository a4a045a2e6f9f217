"""Equi-join against a lookup table, safe for hot keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.session import fresh_path

#: Lookup tables up to this size are shipped to every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Beyond that size, keys with so many rows are spread over so many tasks.
HOT_ROWS = 1_000_000
SALTS = 64


def measured_bytes(table: DataFrame) -> int:
    """Size of a table's rows as text: a distributed count, not an estimate."""
    row = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    return table.agg(F.sum(F.octet_length(row))).first()[0] or 0


def hot_keys(rows: DataFrame, on: list[str], at_least: int) -> DataFrame:
    """Keys with so many rows; counted before the shuffle. At most rows / ``at_least`` of them."""
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") >= at_least).drop("_rows")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` with a ``table`` of one row per key.

    The table is measured first. Within the limit it is broadcast, so ``rows``
    are not shuffled at all. Beyond it the join is a sort-merge join, whose
    skewed partitions AQE splits; it is never broadcast. If keys have
    ``hot_rows`` rows or more, they alone are salted: their rows are spread
    over ``salts`` tasks and only their table rows are repeated. A stream is
    not counted, so its keys are not salted. ``counted`` has every key at least
    as often as ``rows``: it is counted instead, where ``rows`` are dear to work
    out twice. A limit of zero needs no measuring.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup keeps or drops its left rows, not {how!r}")
    if max_broadcast_bytes > 0 and measured_bytes(table) <= max_broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    if rows.isStreaming:
        return rows.join(table.hint("merge"), on, how)
    path = fresh_path(rows.sparkSession, "hot-keys")
    hot = hot_keys(rows if counted is None else counted, on, hot_rows)
    hot.write.parquet(path)
    hot = rows.sparkSession.read.schema(hot.schema).parquet(path)
    if hot.isEmpty():
        return rows.join(table.hint("merge"), on, how)

    # by input partition: equal copies are spread too, and a retried task salts
    # its rows the same way whatever order they arrive in
    spread = F.pmod(F.spark_partition_id(), F.lit(salts))
    each = F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), salts - 1).otherwise(0)))
    spread_rows = _marked(rows.withColumn("_part", spread), hot, on)
    salt = F.when(F.col("_hot"), F.col("_part")).otherwise(0)
    left = spread_rows.withColumn("_salt", salt).drop("_hot", "_part")
    right = _marked(table, hot, on).withColumn("_salt", each).drop("_hot")
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _marked(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """``df`` with whether its key is hot; null keys can be hot as well."""
    names = {c: f"_hot_{c}" for c in on}
    keys = hot.withColumnsRenamed(names).withColumn("_hot", F.lit(True))
    same = reduce(and_, (df[c].eqNullSafe(keys[n]) for c, n in names.items()))
    met = df.join(F.broadcast(keys), same, "left").drop(*names.values())
    return met.withColumn("_hot", F.coalesce("_hot", F.lit(False)))
