"""Sharding by extendible hashing.

A document's hash decides its shard. The directory is indexed by hash-prefix
bits; a bucket over the byte limit splits on another bit, all others keep their
depth. Depths are settled on a table of bytes per prefix, so the documents are
read once for the sizes and once for the assignment, and never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.common import sized_broadcast, stored, whole_text

#: Bits of the hash, and bits that one round of splitting may use beyond the last.
HASH_BITS = 60
ROUND_BITS = 12

#: A shard file of a training run.
SHARD_BYTES = 256 * 1024 * 1024


def key_hash(key: Column) -> Column:
    """60 hash bits of the key: the first 15 hex digits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def prefix(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, HASH_BITS - bits)


def _levels(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """The buckets with depth in (low, high]: the shallowest prefixes within the limit.

    ``cells`` holds bytes and rows per prefix of ``high`` bits, below prefixes
    of ``low`` bits that are over the limit. Buckets at ``high`` may still be
    over it.
    """
    depth = F.explode(F.sequence(F.lit(low), F.lit(high)))
    sums = (
        cells.select("cell", "bytes", "n", depth.alias("depth"))
        .withColumn("slot", F.expr(f"shiftrightunsigned(cell, {high} - depth)"))
        .groupBy("depth", "slot")
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    )
    parents = sums.where(F.col("bytes") > limit).select(
        (F.col("depth") + 1).alias("depth"), F.col("slot").alias("parent")
    )
    below = sums.where(f"depth > {low}").withColumn("parent", F.expr("shiftrightunsigned(slot, 1)"))
    split = below.join(parents, ["depth", "parent"], "left_semi").drop("parent")
    return split.where((F.col("bytes") <= limit) | (F.col("depth") == high))


def _directory(hashes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """(bits, buckets) of each round of splitting; later rounds split what is left over."""
    total, rows = hashes.agg(F.sum("bytes"), F.sum("n")).first()
    total = total or 0
    high = max(0, math.ceil(math.log2(max(total, 1) / limit))) + 4 if total > limit else 0
    if high == 0:
        root = hashes.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).where("n > 0")
        root = root.select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("slot"), "bytes", "n")
        return [(0, stored(root, "shard-directory"))]
    rounds, low, left = [], 0, hashes
    while True:
        high = min(high, HASH_BITS)
        cells = left.groupBy(prefix(F.col("h"), high).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n")
        )
        level = stored(_levels(cells, low, high, limit), "shard-directory")
        over = (F.col("bytes") > limit) & (F.col("n") > 1)
        if high == HASH_BITS or level.where(over).isEmpty():
            return [*rounds, (high, level)]
        rounds.append((high, level.where(~over)))
        slots = sized_broadcast(level.where(over).select("slot"), 24)
        slot = prefix(F.col("h"), high)
        left = stored(left.withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot"), "shard-left")
        low, high = high, high + ROUND_BITS


def shard_rows(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """doc_id, bytes, depth, shard, shard_bytes, shard_rows for each row of ``docs``.

    ``docs`` has doc_id and text. A shard is named by its prefix bits. Equal
    ids (and all null ids) share a hash. Rows of one id beyond the limit, which
    no bit can part, go to numbered pages of their bucket; pages are cut within
    each scan partition. A document that alone is over the limit ends in a
    shard or page of its own. Only sizes and hashes are shuffled. An empty
    table gives no rows.
    """
    columns = ["doc_id", "bytes", "depth", "shard", "shard_bytes", "shard_rows"]
    return _placed(stored(docs.select(*_sized()), "shard-rows"), limit).select(*columns)


def _sized() -> list[Column]:
    """What a row's place depends on."""
    return [
        F.col("doc_id"),
        F.octet_length(whole_text(F.col("text"))).cast("long").alias("bytes"),
        key_hash(F.col("doc_id")).alias("h"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
    ]


def _placed(sized: DataFrame, limit: int) -> DataFrame:
    """doc_id, bytes, row, depth, shard, shard_bytes, shard_rows for each row of ``sized``, a stored table."""
    # a third of the rows may share an id: sums per id and task come first
    hashes = stored(
        sized.groupBy("h").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")),
        "shard-sizes",
    )
    placed, found = sized, []
    for k, (bits, level) in enumerate(_directory(hashes, limit)):
        entries = level.select(
            F.expr(
                f"explode(sequence(shiftleft(slot, {bits} - depth), shiftleft(slot + 1, {bits} - depth) - 1))"
            ).alias(f"cell{k}"),
            F.struct("depth", "slot", "bytes", "n").alias(f"bucket{k}"),
        )
        placed = placed.withColumn(f"cell{k}", prefix(F.col("h"), bits)).join(
            sized_broadcast(entries, 64), f"cell{k}", "left"
        )
        found.append(f"bucket{k}")
    placed = placed.withColumn("b", F.coalesce(*found)).select(
        "doc_id", "bytes", "h", "part", "row",
        F.col("b.depth").alias("depth"),
        F.col("b.bytes").alias("shard_bytes"),
        F.col("b.n").alias("shard_rows"),
        F.expr("substring(lpad(bin(b.slot), 60, '0'), 61 - b.depth, 60)").alias("shard"),
    )
    paged = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    columns = ["doc_id", "bytes", "row", "depth", "shard", "shard_bytes", "shard_rows"]
    if hashes.where((F.col("bytes") > limit) & (F.col("n") > 1)).isEmpty():
        return placed.select(*columns)
    return placed.where(~paged).select(*columns).unionByName(
        _pages(placed.where(paged), limit).select(*columns)
    )


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of indivisible buckets in pages within the limit, cut per scan partition."""
    here = Window.partitionBy("shard", "part").orderBy("row")
    big = F.col("bytes") > limit // 2
    before = F.sum(F.when(big, 0).otherwise(F.col("bytes"))).over(here) - F.col("bytes")
    page = F.when(big, F.concat(F.lit("-"), F.col("row"))).otherwise(
        F.concat_ws("-", F.lit(""), "part", F.floor(before / max(1, limit // 2)))
    )
    rows = rows.withColumn("shard", F.concat("shard", page))
    sums = rows.groupBy("shard").agg(
        F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")
    )
    return rows.drop("shard_bytes", "shard_rows").join(sums, "shard")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Whole documents as Parquet, one folder per shard: every row where :func:`shard_rows` puts it.

    Rows are stored with their text and row number first, and the number ties
    text to shard, so null and repeated ids keep all their rows and pages.
    """
    kept = stored(docs.select(F.struct("*").alias("doc"), *_sized()), "shard-documents")
    where = _placed(kept.drop("doc"), limit).select("row", "shard")
    placed = kept.select("row", "doc").join(sized_broadcast(where, 128), "row").select("doc.*", "shard")
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
