"""Relational source of the ERP feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_options(column: str, low: str, high: str, parts: int) -> dict[str, str]:
    """Read the table in ``parts`` ranges of ``column`` instead of one connection."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def even_ranges(rows: DataFrame, column: str, parts: int) -> list[str]:
    """Predicates that cut ``rows`` into at most ``parts`` ranges of about equal size.

    The bounds are quantiles of the column, however unevenly its values lie,
    from one pass over it. Every row, nulls included, meets exactly one
    predicate; equal values stay together.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return ["1 = 1"]
    found = rows.agg(F.percentile_approx(column, shares, 10_000).alias("bounds")).first()["bounds"]
    bounds = sorted(set(found or []))
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *inner, f"{column} >= {bounds[-1]}"]


def equipment_events(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    table: str = "equipment_events",
    split: dict[str, str] | None = None,
    ranges: list[str] | None = None,
) -> DataFrame:
    """The ERP table; date filters and column choices are pushed to the database.

    With ``ranges`` (:func:`even_ranges`) one task reads the rows of each.
    """
    if ranges:
        return spark.read.jdbc(url, table, predicates=ranges, properties=properties)
    options = {"url": url, "dbtable": table, **properties, **(split or {})}
    return spark.read.format("jdbc").options(**options).load()
