"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.session import fresh_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: White space as all operators see it: a blank, tab, line ends, vertical tab, form feed.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII takes the faster ``lower``, which is the same there."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs the running tasks, not the work
    before, and every reader sees the same rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized_broadcast(df: DataFrame, row_bytes: int, limit: int = 32 * 1024 * 1024) -> DataFrame:
    """Hints a broadcast if the counted rows fit ``limit``; else the join shuffles.

    ``row_bytes`` is the most that a row of ``df`` takes.
    """
    if df.count() * row_bytes <= limit:
        return F.broadcast(df)
    return df.hint("merge")


def small_batches(spark, rows: int = 1000, size: int = 4 * 1024 * 1024) -> None:
    """Texts are long: fewer rows and bytes at once between Spark and its Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def hands_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches; at its end the Python worker returns the memory that it has freed.

    Spark keeps the workers for later tasks. Otherwise what the largest task
    took stays with each of them, beside the JVM, through all later stages.
    """

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run
