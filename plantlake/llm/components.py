"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first())


def components(links: DataFrame) -> DataFrame:
    """id, component: for every id in ``links`` (a, b), the smallest id it reaches.

    Each round points the neighbours of every id at the smallest one, first the
    larger neighbours, then the smaller; the number of rounds grows with the
    logarithm of the longest chain. Minima are taken before the shuffle, so an
    id with very many links is no bottleneck. Links of an id with itself keep
    it as its own component. No links give no rows.
    """
    alone = links.where("a = b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(edges.distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(
            F.col("u").alias("of"), F.least("u", "low").alias("low")
        )
        large = both.join(low, both["u"] == low["of"]).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        large = stored(large, "links")
        low = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("low"))
        small = large.join(low, large["u"] == low["of"]).where("v <> low")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stored(
            small.unionByName(low.select(F.col("of").alias("u"), F.col("low").alias("v"))).distinct(),
            "links",
        )
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("u"), "v").unionByName(alone)
    return edges.unionByName(roots).groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
