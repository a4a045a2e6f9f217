"""Row-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantlake import schemas


def tidy(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def tidy_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).alias(name)


def event_time(name: str = "timestamp") -> Column:
    """ISO-8601 text → timestamp; text that is no time → null, not an error.

    The text must start with a full date: a bare time of day would be taken as
    today's, and a year as its first day. Other text becomes empty, which the
    parser refuses. The column is named once: a filter that is pushed below it
    repeats what the name stands for as often as it occurs.
    """
    dated = F.regexp_extract(F.trim(F.col(name)), f"^{schemas.ISO_DATE}([T ].*)?$", 0)
    return F.try_to_timestamp(dated)


def iso_text(ts: Column) -> Column:
    """A UTC timestamp as ISO-8601 text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def narrow_int(column: Column) -> Column:
    """long → int; a value that does not fit becomes null."""
    return column.try_cast("int")


def clamp(column: Column, low: Column, high: Column, digits: int = 2) -> Column:
    """The value moved into [low, high] and rounded."""
    return F.round(F.least(F.greatest(column, low), high), digits)


def padded(number: Column, width: int) -> Column:
    """Zero-padded digits; longer numbers keep all of theirs."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def equipment_code(number: Column) -> Column:
    return F.concat(F.lit("EQ-"), padded(number, 4))


def sensor_code(number: Column) -> Column:
    return F.concat(F.lit("SENS-"), padded(number, 5))


def display_name(kind: Column, number: Column) -> Column:
    return F.concat(F.initcap(kind), F.lit(" "), number.cast("string"))


def round_robin(number: Column, choices: list[str]) -> Column:
    """1-based number → the choices in turn."""
    turn = F.pmod(number - 1, F.lit(len(choices))).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in choices]), turn + 1)


def lookup(column: Column, table: dict) -> Column:
    """A small fixed dictionary as an expression; unknown keys give null."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), column)


def next_due(last: Column, schedule: Column) -> Column:
    """Date of the next maintenance after ``last`` under the schedule."""
    return F.date_add(last, lookup(schedule, schemas.SCHEDULE_DAYS))
