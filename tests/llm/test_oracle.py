"""The queries with SQL equal it on the given tables."""

from collections import Counter

import pytest

from plantlake.llm.queries import ORACLE, QUERIES, sharding_sql
from plantlake.llm.sharding import shard_rows


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows
    )


def same(df, con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    same(QUERIES[name](spark, sf_dir), duck, ORACLE[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("limit", [20_000, 100_000])
def test_small_shards_equal_sql(spark, duck, sf_dir, limit):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    same(shard_rows(docs, limit), duck, sharding_sql(limit))


NATIVE = ["op2_sharding", "op6_mixing", "op10_exact_dedup"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if x in plan]
