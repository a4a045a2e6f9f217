"""Line dedup: the filter, the index, reversal, edge rows."""

import numpy as np
import pytest

from plantlake.llm.cuckoo import CuckooFilter
from plantlake.llm.linededup import LineIndex
from plantlake.sinks.folders import Folders

LONG = "a line that is long enough to count"


def test_cuckoo_filter_has_no_false_negatives_and_forgets():
    rng = np.random.default_rng(1)
    high, low = (rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(2))
    held = CuckooFilter.build(high, low)
    assert held.contains(high, low).all()
    other = rng.integers(0, 2**64, (2, 50_000), dtype=np.uint64)
    assert held.contains(*other).mean() < 0.001
    back = CuckooFilter.load(held.dump())
    back.delete(high[:2500], low[:2500])
    assert back.contains(high[2500:], low[2500:]).all()
    assert back.contains(high[:2500], low[:2500]).mean() < 0.01


def test_a_full_filter_says_so():
    keys = np.arange(64, dtype=np.uint64) << np.uint64(40)
    held = CuckooFilter(np.zeros((2, 4), dtype=np.uint16))
    assert not held.insert(keys, keys)


def kept(index, docs):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in index.apply(docs).collect()}


def test_lines_in_three_documents_stay_in_the_last(spark, documents, folder):
    docs = documents(
        (1, f"{LONG}\nmine"), (2, f"  {LONG.upper()}\t\n{LONG}\nyours"), (3, f"x\n{LONG}\ny"),
        (4, "short\nshort"), (5, "short"), (6, "short"), (7, None), (8, ""),
    )
    index = LineIndex(spark, folder + "/i")
    index.insert(docs)
    got = kept(index, docs)
    assert got[1] == (2, 1, "mine") and got[2] == (3, 2, "yours") and got[3] == (3, 0, f"x\n{LONG}\ny")
    assert got[4] == (2, 0, "short\nshort") and got[7] == got[8] == (1, 0, "")


def test_twenty_code_points_count_not_bytes(spark, documents, folder):
    docs = documents(*[(k, "é" * 19) for k in range(3)], *[(10 + k, "é" * 20) for k in range(3)])
    index = LineIndex(spark, folder + "/i")
    index.insert(docs)
    got = kept(index, docs)
    assert [got[k][1] for k in (0, 1, 2, 10, 11, 12)] == [0, 0, 0, 1, 1, 0]


def test_repeated_and_null_ids(spark, documents, folder):
    docs = documents((1, LONG), (1, LONG), (1, LONG + " "), (2, LONG))
    index = LineIndex(spark, folder + "/i")
    index.insert(docs)
    assert all(r.n_dropped == 0 for r in index.apply(docs).collect())  # two documents only
    docs = documents((None, LONG), (1, LONG), (2, LONG))
    index = LineIndex(spark, folder + "/j")
    index.insert(docs)
    got = kept(index, docs)
    assert [got[k][1] for k in (None, 1, 2)] == [1, 1, 0]


def test_deleting_documents_gives_lines_back(spark, documents, folder):
    docs = documents(*[(k, f"{LONG}\n{LONG} {k % 2}") for k in range(1, 7)])
    index = LineIndex(spark, folder + "/i")
    index.insert(docs)
    before = kept(index, docs)
    assert [before[k][1] for k in range(1, 7)] == [2, 2, 2, 2, 1, 0]
    index.delete(spark.createDataFrame([(6,), (5,)], "doc_id long"))
    rest = docs.where("doc_id < 5")
    got = kept(index, rest)
    # LONG is still in four documents, the others are down to two
    assert [got[k][1] for k in range(1, 5)] == [1, 1, 1, 0]
    index.delete(spark.createDataFrame([(3,), (4,)], "doc_id long"))
    assert [kept(index, docs.where("doc_id < 3"))[k][1] for k in (1, 2)] == [0, 0]
    assert not any(n > 0 for r in index.filters.collect() for n in [sum(bytes(r["filter"]))])
    index.insert(docs.where("doc_id > 2"))
    assert kept(index, docs) == before


def test_increments_equal_one_insert(spark, sf_dir, folder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole = LineIndex(spark, folder + "/whole")
    whole.insert(docs)
    LineIndex(spark, folder + "/parts").insert(docs.where("doc_id % 3 = 0"))
    parts = LineIndex(spark, folder + "/parts", shard_lines=10)  # opened anew
    parts.insert(docs.where("doc_id % 3 > 0"))
    parts.delete(docs.where("doc_id % 3 = 1").select("doc_id"))
    parts.insert(docs.where("doc_id % 3 = 1"))
    assert kept(parts, docs) == kept(whole, docs)


def test_without_shipped_filters(spark, documents, folder, monkeypatch):
    docs = documents(*[(k, LONG) for k in range(4)])
    index = LineIndex(spark, folder + "/i")
    index.insert(docs)
    monkeypatch.setattr(LineIndex, "_probe", lambda self: None)
    assert sum(n for _, n, _ in kept(index, docs).values()) == 3


def test_empty_table(spark, documents, folder):
    empty = documents((1, "a")).where("false")
    index = LineIndex(spark, folder + "/i")
    index.insert(empty)
    assert kept(index, empty) == {}
    assert kept(index, documents((1, "a"))) == {1: (1, 0, "a")}


@pytest.mark.parametrize("step", ["before its postings", "before its filters", "within its filters"])
def test_an_index_whose_last_change_stopped_opens_and_goes_on(spark, documents, folder, monkeypatch, step):
    line = "a line that is long enough"
    first = documents(*((i, f"{line}\nown line of document {i}") for i in range(2)))
    second = documents((5, line), (6, line.upper()))
    LineIndex(spark, folder + "/i").insert(first)
    index = LineIndex(spark, folder + "/i")
    if step == "before its postings":
        spark.range(3).write.parquet(folder + "/i/postings/batch=1")  # without the mark of a whole table
        Folders(spark, folder).drop(folder + "/i/postings/batch=1/_SUCCESS")
    else:
        with monkeypatch.context() as patch:
            patch.setattr(LineIndex, "_refilter", lambda self, changes: None)
            index.insert(second)
        if step == "within its filters":
            Folders(spark, folder).move(folder + "/i/filters-1", folder + "/i/filters-2")
            Folders(spark, folder).drop(folder + "/i/filters-2/_SUCCESS")
    index = LineIndex(spark, folder + "/i")
    index.insert(second)  # the caller's rerun
    rows = {r.doc_id: r.kept for r in index.apply(first.unionByName(second)).collect()}
    assert rows == {0: "own line of document 0", 1: "own line of document 1", 5: "", 6: line.upper()}
    index.delete(second)
    assert {r.n_dropped for r in index.apply(first).collect()} == {0}
