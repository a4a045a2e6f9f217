"""Sharding: limits, splits, rows that no bit can part."""

import os
from collections import defaultdict

from pyspark.sql import functions as F

from plantlake.llm.sharding import shard_rows, write_shards

from .conftest import prose


def shards(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r.shard].append(r)
    return found


def test_every_shard_fits_and_only_full_buckets_split(spark, documents):
    docs = documents(*[(k, prose(k, 5 + k % 40)) for k in range(400)])
    got = shards(shard_rows(docs, 3000))
    assert sum(map(len, got.values())) == 400
    for name, rows in got.items():
        assert sum(r.bytes for r in rows) == rows[0].shard_bytes <= 3000
        assert {r.depth for r in rows} == {len(name)} and {r.shard_rows for r in rows} == {len(rows)}
        # the parent held more than the limit, or it would not have split
        parent = [r for n, rs in got.items() if n.startswith(name[:-1]) for r in rs]
        assert not name or sum(r.bytes for r in parent) > 3000
    assert len({len(n) for n in got}) > 1


def test_a_document_over_the_limit_is_alone(spark, documents):
    docs = documents(*[(k, prose(k, 20)) for k in range(50)], (99, prose(1, 5000)))
    got = shards(shard_rows(docs, 1000))
    assert [len(rows) for rows in got.values() if rows[0].shard_bytes > 1000] == [1]


def test_one_id_over_the_limit_overflows_into_pages(spark, documents):
    docs = documents(*[(7, prose(k, 30)) for k in range(60)], *[(None, "x" * 10) for _ in range(5)])
    got = shards(shard_rows(docs, 1000))
    assert sum(map(len, got.values())) == 65
    assert all(sum(r.bytes for r in rows) <= 1000 for rows in got.values())


def test_one_shard_null_texts_and_empty_table(spark, documents):
    got = shard_rows(documents((1, None), (2, ""), (None, "abc")), 100).collect()
    assert {(r.shard, r.depth, r.shard_bytes, r.shard_rows) for r in got} == {("", 0, 3, 3)}
    assert shard_rows(documents((1, "a")).where("false"), 100).collect() == []


def test_write_shards(spark, documents, folder):
    docs = documents(*[(k, prose(k, 30)) for k in range(40)])
    write_shards(docs, folder + "/out", 1500)
    back = spark.read.parquet(folder + "/out")
    assert back.count() == 40 and back.select(docs.columns).exceptAll(docs).isEmpty()
    assert len([d for d in os.listdir(folder + "/out") if d.startswith("shard=")]) > 3


def test_write_shards_keeps_null_and_repeated_ids_on_their_pages(spark, documents, folder):
    docs = documents(
        *[(7, prose(k, 30)) for k in range(60)], *[(None, prose(100 + k, 30)) for k in range(20)],
        *[(k, prose(200 + k, 30)) for k in range(20)], (None, None), (7, prose(0, 30)),
    )
    write_shards(docs, folder + "/out", 1000)
    back = spark.read.parquet(folder + "/out")
    assert back.count() == 102 and back.select(docs.columns).exceptAll(docs).isEmpty()
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("bytes"))
    assert sizes.where("bytes > 1000").isEmpty()
    assert sizes.count() == shard_rows(docs, 1000).select("shard").distinct().count()
