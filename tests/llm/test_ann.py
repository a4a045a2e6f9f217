"""Nearest neighbours: exact at factor one, recall beyond, copies, edge rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plantlake.llm import ann
from plantlake.llm.ann import nearest
from plantlake.llm.queries import QUERIES
from plantlake.llm.vptree import VPTree

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_force(ids, points, asks, k=10):
    found = {}
    for i in np.flatnonzero(asks):
        gap = points - points[i]
        score = np.sqrt((gap * gap).sum(axis=1))
        order = [j for j in np.lexsort((ids, score)) if j != i][:k]
        found[int(ids[i])] = [(r + 1, int(ids[j]), score[j]) for r, j in enumerate(order)]
    return found


def got(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return found


def frame(spark, ids, points):
    rows = [(int(i), [float(x) for x in p], 0) for i, p in zip(ids, points, strict=True)]
    return spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("spread", [0.0, 5.0])
def test_factor_one_is_exact(spark, monkeypatch, spread):
    monkeypatch.setattr(ann, "SMALL_SHARD", 200)
    monkeypatch.setattr(ann, "QUERY_ROWS", 30)
    rng = np.random.default_rng(2)
    points = (rng.normal(size=(900, 8)) + spread * rng.integers(0, 4, (900, 1))).astype(np.float32)
    ids = rng.permutation(5000)[:900]
    want = brute_force(ids, points.astype(float), ids % 10 == 0)
    assert got(nearest(frame(spark, ids, points), F.col("vec_id") % 10 == 0, factor=1.0)) == want


def test_pruning_skips_points_in_clusters():
    """At a larger factor a tree compares fewer points and still finds nearly all."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(4000, 3))
    tree = VPTree.build(points)
    seen = {}
    for factor in (1.0, 3.0):
        met = []
        leaf = tree._leaf
        tree._leaf = lambda rows, asked, *rest, met=met, leaf=leaf: (met.append(len(rows) * len(asked)), leaf(rows, asked, *rest))
        names, _ = tree.search(points[:100], np.arange(4000), 10, factor)
        tree._leaf = leaf
        seen[factor] = (sum(met), names)
    assert seen[3.0][0] < seen[1.0][0] < 4000 * 100 / 4
    same = [len(set(a) & set(b)) / 10 for a, b in zip(seen[1.0][1], seen[3.0][1], strict=True)]
    assert np.mean(same) > 0.6


def test_copies_and_ties_go_to_smaller_ids(spark):
    points = [[1, 0], [0, 1], [-1, 0], [0, -1]]
    rows = [(k, points[k % 4]) for k in range(200)]
    ids, pts = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    want = brute_force(ids, pts, ids % 40 == 0)
    assert got(nearest(frame(spark, ids, pts), F.col("vec_id") % 40 == 0)) == want


def test_unusable_rows_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1),
        (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (7, [1.0], 1), (8, [], 1), (None, [1.0, 0.0], 1),
        (100, [3.0, 0.0], 1), (100, [3.0, 0.0], 1), (200, [0.0, 0.0], 1),
    ]
    table = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("own")).withColumn("name", F.lit("own"))
    assert got(nearest(table, F.col("vec_id") % 100 == 0)) == {
        0: [(1, 1, np.sqrt(2)), (2, 100, 2.0)], 100: [(1, 0, 2.0), (2, 1, np.sqrt(10))]
    }


def test_lonely_query_and_empty_table(spark):
    table = spark.createDataFrame([(0, [1.0], 1)], VECTORS)
    assert nearest(table, F.lit(True)).collect() == []
    assert nearest(table.where("false"), F.lit(True)).collect() == []


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    table = pd.read_parquet(f"{folder}/embeddings.parquet")
    ids, points = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), dtype=float)
    want = brute_force(ids, points, ids % 100 == 0)
    found = got(QUERIES["op1_nearest"](spark, folder))
    assert set(found) == set(want)
    hits = [len({v for _, v, _ in found[q]} & {v for _, v, _ in w}) / len(w) for q, w in want.items()]
    assert np.mean(hits) >= 0.97
