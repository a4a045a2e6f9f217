"""Approximate nearest neighbours with a vantage-point tree per shard.

Equal vectors are searched as one, so a group of copies costs no more than one
row. The distinct vectors are dealt to shards by a hash; each shard builds a
tree. Queries go to every shard in blocks, and each block's nearest per shard
are merged. Pruning by the triangle inequality is relaxed by a factor: at one
the search is exact, above it a tree skips what is unlikely to hold a neighbour.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.common import stored
from plantlake.llm.vptree import VPTree

#: Neighbours, and the relaxation that still found nearly all of them when measured.
NEIGHBOURS = 10
FACTOR = 3.0
#: Rows of a shard: small ones spread a small table, large ones spare the queries of a large one.
SMALL_SHARD, LARGE_SHARD = 1_024, 65_536
SPREAD = 128
#: Queries that meet a shard at once.
QUERY_ROWS = 2_048


def usable(vector: Column) -> Column:
    """Not null, not zero, no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def shard_count(rows: int) -> int:
    return max(1, min(SPREAD, math.ceil(rows / SMALL_SHARD)), math.ceil(rows / LARGE_SHARD))


def nearest(
    vectors: DataFrame, queries: Column, k: int = NEIGHBOURS, factor: float = FACTOR
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every query row.

    ``vectors`` has vec_id and embedding; ``queries`` says which rows ask. All
    other rows are candidates. Unusable vectors and null ids take no part, nor
    do vectors that are not of the commonest length. Of rows that repeat an id
    the smallest vector counts. Ties go to the smaller id. Queries without any
    candidate, and empty tables, give no rows.
    """
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).where(usable(F.col("embedding")))
    rows = stored(
        rows.groupBy("vec_id").agg(
            F.min("embedding").alias("embedding"), F.max("asks").alias("asks")
        ),
        "ann-rows",
    )
    sizes = rows.groupBy(F.size("embedding").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("embedding") == (common["size"] if common else 0))

    distinct = stored(
        rows.groupBy("embedding").agg(F.min("vec_id").alias("name"), F.count("*").alias("n")),
        "ann-vectors",
    )
    shards = shard_count(distinct.count())
    trees = _trees(distinct, shards)
    asked = rows.where("asks").select("vec_id", "embedding")
    found = _searched(trees, asked, shards, k + 1, factor)  # one more: the query may find itself

    # copies: of equal vectors, no query needs more than the k + 1 smallest ids
    several = distinct.where("n > 1").select("embedding", "name")
    mates = rows.join(several, "embedding").select("name", "vec_id")
    by_id = Window.partitionBy("name").orderBy("vec_id")
    mates = mates.withColumn("turn", F.row_number().over(by_id)).where(F.col("turn") <= k + 1)
    met = found.join(mates.select("name", F.col("vec_id").alias("mate")), "name", "left")
    met = met.select("query_id", F.coalesce("mate", "name").alias("vec_id"), "score")
    met = met.where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _trees(distinct: DataFrame, shards: int) -> DataFrame:
    """shard, names, dim, points, order, nodes, reach: the tree of each shard, packed."""

    def plant(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("name")
        points = _matrix(rows["embedding"])
        tree = VPTree.build(points)
        packed = {
            "names": rows["name"].to_numpy(dtype=np.int64), "points": tree.points,
            "tree_order": tree.order, "nodes": tree.nodes, "reach": tree.reach,
        }
        blobs = {c: [x.tobytes()] for c, x in packed.items()}
        return pd.DataFrame({"shard": rows["shard"].iloc[:1].tolist(), "dim": [points.shape[1]], **blobs})

    dealt = distinct.select("embedding", "name", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int").alias("shard"))
    schema = "shard int, dim int, names binary, points binary, tree_order binary, nodes binary, reach binary"
    return stored(dealt.groupBy("shard").applyInPandas(plant, schema), "ann-trees")


def _searched(trees: DataFrame, asked: DataFrame, shards: int, k: int, factor: float) -> DataFrame:
    """query_id, name, score: the k nearest distinct vectors of each query over all shards."""
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.select("vec_id", "embedding", block, each(shards).alias("shard"))
    trees = trees.withColumn("block", each(blocks))

    def search(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "name": [], "score": []})
        if not len(trees) or not len(asked):
            return empty
        t = trees.iloc[0]
        tree = VPTree(
            np.frombuffer(t["points"]).reshape(-1, t["dim"]), np.frombuffer(t["tree_order"], dtype=np.int64),
            np.frombuffer(t["nodes"], dtype=np.int64).reshape(-1, 5), np.frombuffer(t["reach"]).reshape(-1, 4),
        )
        names, gaps = tree.search(
            _matrix(asked["embedding"]), np.frombuffer(t["names"], dtype=np.int64), k, factor
        )
        real = np.isfinite(gaps)
        ids = np.broadcast_to(asked["vec_id"].to_numpy()[:, None], gaps.shape)
        return pd.DataFrame({"query_id": ids[real], "name": names[real], "score": gaps[real]})

    met = trees.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        search, "query_id long, name long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "name")
    best = met.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k)
    return stored(best.drop("turn"), "ann-found")
