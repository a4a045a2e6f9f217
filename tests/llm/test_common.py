"""Helpers of the training-data operators."""

import ctypes
import re
from pathlib import Path

import pyarrow as pa
import pytest

from plantlake.llm import bpe
from plantlake.llm.common import hands_back


def own_mb() -> float:
    found = re.findall(r"\n(?:Anonymous|AnonHugePages):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found[0]) / 1024


def pinned(batches):
    """Takes 120 MB in blocks of 1 kB, of which a few stay, spread over all of them."""
    for batch in batches:
        blocks = [bytes(1000) for _ in range(120_000)]
        kept.append(blocks[::1000])
        yield batch


kept = []


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library has no malloc_trim")
def test_a_worker_keeps_little_after_its_task():
    before = own_mb()
    assert list(hands_back(pinned)(iter([1, 2]))) == [1, 2]
    assert own_mb() - before < 60


def test_batches_and_type_hints_stay(spark):
    """An arrow_udf is told by its hints; a failure inside reaches the task's caller."""

    @hands_back
    def failing(batches):
        yield next(batches)
        raise ValueError("inside")

    batch = pa.RecordBatch.from_pydict({"x": [1]})
    run = failing(iter([batch]))
    assert next(run) is batch
    with pytest.raises(ValueError, match="inside"):
        next(run)
    decoded = bpe.decoded(bpe.F.col("ids"), spark, '{"model": {"type": "WordLevel", "vocab": {"a": 0, "b": 1}, "unk_token": "a"}}')
    rows = spark.createDataFrame([(bytes([1, 0, 0, 0, 0, 0, 0, 0]),), (None,)], "ids binary").select(decoded.alias("t")).collect()
    assert [r.t for r in rows] == ["b a", ""]
