"""Exact dedup: survivors, the index across batches, edge rows."""

from plantlake.llm.exactdedup import DigestIndex, deduplicate


def decisions(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()),
        key=lambda r: (r[0] is None, r[0] or 0, not r[3]),
    )


def test_the_largest_id_of_equal_texts_stays(spark, documents, folder):
    docs = documents((1, "Same"), (5, "sAME"), (3, "same"), (2, "Ünlike"), (4, "ünlike"))
    got = decisions(DigestIndex(spark, folder + "/i", 4).add(docs))
    # only A-Z are lower-cased
    assert got == [(1, 5, 3, False), (2, 2, 1, True), (3, 5, 3, False), (4, 4, 1, True), (5, 5, 3, True)]


def test_null_and_empty_texts_are_equal_and_null_ids_are_smallest(spark, documents, folder):
    docs = documents((1, None), (2, ""), (None, ""), (None, "alone"))
    got = decisions(DigestIndex(spark, folder + "/i", 4).add(docs))
    assert got == [(1, 2, 3, False), (2, 2, 3, True), (None, None, 1, True), (None, 2, 3, False)]


def test_of_rows_that_repeat_an_id_one_stays(spark, documents, folder):
    docs = documents((7, "x"), (7, "x"), (7, "x"), (7, "y"))
    index = DigestIndex(spark, folder + "/i", 4)
    got = decisions(index.add(docs))
    assert [r[3] for r in got].count(True) == 2
    left = deduplicate(docs, DigestIndex(spark, folder + "/j", 4))
    assert left.columns == docs.columns
    assert sorted(r.text for r in left.collect()) == ["x", "y"]
    assert {r.row for r in left.collect()} == {"own row"}


def test_a_later_batch_meets_the_index(spark, documents, folder):
    path = folder + "/i"
    DigestIndex(spark, path, 4).add(documents((9, "a"), (2, "b"))).collect()
    again = DigestIndex(spark, path, 4)  # opened anew
    got = decisions(again.add(documents((10, "A"), (3, "c"), (11, "c"))))
    assert got == [(3, 11, 2, False), (10, 9, 2, False), (11, 11, 2, True)]
    assert sorted((r.keep_id, r.n) for r in again.entries().collect()) == [(2, 1), (9, 2), (11, 2)]


def test_index_side_of_the_join_is_not_shuffled(spark, documents, folder):
    index = DigestIndex(spark, folder + "/i", 4)
    index.add(documents((1, "a"), (2, "b")))
    groups = index.entries().hint("merge")
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_empty_table(spark, documents, folder):
    empty = documents((1, "a")).where("false")
    assert DigestIndex(spark, folder + "/i", 4).add(empty).collect() == []
    assert deduplicate(empty, DigestIndex(spark, folder + "/j", 4)).collect() == []


def test_a_batch_that_is_added_again_decides_and_counts_the_same(spark, documents, folder):
    path, first, second = folder + "/i", documents((9, "a"), (2, "b")), documents((10, "A"), (3, "c"), (11, "c"))
    DigestIndex(spark, path, 4).add(first, batch="one")
    got = decisions(DigestIndex(spark, path).add(second, batch="two"))
    DigestIndex(spark, path).close()
    index = DigestIndex(spark, path)  # as in a new session, without naming the buckets
    assert index.buckets == 4
    assert decisions(index.add(second, batch="two")) == got == [(3, 11, 2, False), (10, 9, 2, False), (11, 11, 2, True)]
    # the first one as well, though a later one has been added since
    assert decisions(index.add(first, batch="one")) == [(2, 2, 1, True), (9, 9, 2, True)]
    assert sorted((r.keep_id, r.n) for r in index.entries().collect()) == [(2, 1), (9, 2), (11, 2)]


def test_a_batch_that_stopped_half_written_is_completed(spark, documents, folder):
    docs = documents(*((i, f"text {i % 30}") for i in range(60)))
    index = DigestIndex(spark, folder + "/i", 4)
    whole = decisions(index.add(docs, batch="x"))
    broken = DigestIndex(spark, folder + "/j", 4)
    # some of the batch's files only
    spark.table(index.name).where("hash(digest) % 2 = 0").repartition(4, "digest").write.insertInto(broken.name)
    spark.catalog.refreshTable(broken.name)
    assert decisions(broken.add(docs, batch="x")) == whole
    assert broken.entries().agg({"n": "sum"}).first()[0] == 60


def test_one_catalog_entry_per_path(spark, documents, folder):
    for _ in range(3):
        index = DigestIndex(spark, folder + "/i", 4)
        index.add(documents((1, "a")))
    assert sum(t.name == index.name for t in spark.catalog.listTables()) == 1
    index.close()
    assert not spark.catalog.tableExists(index.name)
