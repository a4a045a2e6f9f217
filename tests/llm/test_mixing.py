"""Mixing: targets, shares, passes, reruns, edge rows."""

from collections import defaultdict

import pytest

from plantlake.llm.mixing import mix, mixed_documents, queued, weighted_targets

from .conftest import prose


def filled(sizes, passes=3):
    """Water filling by hand: fill up sources until all others share what is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(passes * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: passes * sizes[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > passes * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 1, "c": 2, "d": 3, None: 4},
        {"a": 0, "b": 5, "é": 7, "z": 90, "Z": 30},
        {"a": 10},
        {"a": 6, "b": 12, "c": 18},
        {"a": 0, "b": 0},
    ],
)
def test_targets(spark, sizes):
    table = spark.createDataFrame(
        [(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long"
    )
    got = {r.source: r.target for r in weighted_targets(table).collect()}
    assert got == pytest.approx({s: float(t) for s, t in filled(sizes).items()})


def taken(docs, **how):
    queue = queued(docs.select("doc_id", "text", "source"), **how)
    got = defaultdict(int)
    for r in mix(queue).collect():
        got[r.doc_id] += r.taken
    return queue.collect(), got


def test_sources_come_to_their_targets(spark, documents):
    docs = documents(*[(k, prose(k, 1 + k % 50), "abc"[min(2, k % 9)]) for k in range(500)])
    queue, got = taken(docs)
    for target, size in {(r.target, r.source_size) for r in queue}:
        mine = [r for r in queue if r.target == target]
        assert sum(got[r.doc_id] for r in mine) == int(target)
        assert all(got[r.doc_id] <= 3 * r.size for r in mine)
        # the queue is served in one order: ahead + size chains without gaps
        ends = sorted((r.ahead, r.size) for r in mine if r.size)
        assert [a + s for a, s in ends[:-1]] == [a for a, _ in ends[1:]]


def test_copies_come_in_order_of_finish_time(spark, documents):
    docs = documents(*[(k, prose(k, 10), "ab"[k % 5 == 0]) for k in range(100)])
    finish = [r.finish for r in mix(queued(docs)).collect()]
    assert finish == sorted(finish) and finish


def test_reruns_agree_however_the_rows_are_dealt(spark, documents):
    docs = documents(*[(k, prose(k, 1 + k % 30), "abcd"[k % 4]) for k in range(200)])
    first = taken(docs)[1]
    assert first == taken(docs.repartition(3, "text"))[1] == taken(docs, bucket_rows=7)[1]
    assert first != taken(docs, seed=1)[1]


def test_rows_of_one_id_are_dealt_out(spark, documents):
    docs = documents(*[(1, prose(k, 4), "a") for k in range(300)], *[(k, prose(k, 9), "b") for k in range(300)])
    queue, got = taken(docs, bucket_rows=10)
    ends = sorted((r.ahead, r.size) for r in queue if r.source_size == 1200)
    assert [a for a, _ in ends] == list(range(0, 1200, 4))


def test_null_empty_and_blank_texts_have_no_words(spark, documents):
    queue, got = taken(documents((1, None), (2, ""), (3, " \t\n"), (None, "a b", None)))
    assert sorted((r.doc_id or 0, r.size) for r in queue) == [(0, 2), (1, 0), (2, 0), (3, 0)]
    assert dict(got) == {None: 2}
    assert taken(documents((1, "a")).where("false")) == ([], {})


def test_mixed_documents_are_whole_copies(spark, documents):
    docs = documents(
        *[(k, prose(k, 10), "a") for k in range(30)], (50, prose(50, 10), "b"), (50, prose(51, 10), "c"),
        (50, prose(51, 10), "c"),
    )
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        assert r.row == "own row"
        got[r.source] += len(r.text.split())
    sizes = {"a": 300, "b": 10, "c": 20}
    for source, target in filled(sizes).items():
        assert target <= got[source] < target + 10
