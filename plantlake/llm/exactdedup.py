"""Exact dedup through a persistent digest index.

The index is a table of text digests, bucketed and sorted by digest. A batch of
documents is reduced to one row per digest, compared with the index by a
sort-merge anti-join (the index side is not shuffled) and what is new is
appended. Only digests are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.common import ascii_lower, shuffle_width, stored, whole_text
from plantlake.sinks.folders import Folders


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(whole_text(text)), 256))


class DigestIndex:
    """A bucketed log of (digest, named, keep_id, n, batch): the document that stays and rows seen.

    A digest's first row names the document that stays; later batches append
    their counts with a null ``keep_id``. The files outlive the session:
    opening the same path again goes on with the same index and its number of
    buckets, which is kept beside it; the catalog has one entry per path.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.name = "digest_index_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()
        layout = f"{path.rstrip('/')}.layout"
        if not Folders(spark, layout).exists(f"{layout}/_SUCCESS"):
            made = spark.range(1).select(F.lit(buckets or shuffle_width(spark)).alias("buckets"))
            made.write.mode("overwrite").parquet(layout)
        self.buckets = spark.read.parquet(layout).first()["buckets"]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            "(digest BINARY, named BOOLEAN, keep_id BIGINT, n BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def close(self) -> None:
        """Take the index out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def entries(self, of: DataFrame | None = None) -> DataFrame:
        """digest, keep_id, n: one row per digest (of those in ``of``); buckets are already in place."""
        log = self.spark.table(self.name)
        if of is not None:
            log = log.join(of.select("digest").hint("merge"), "digest", "left_semi")
        first = F.max(F.when(F.col("named"), F.struct("named", "keep_id")))
        return (
            log.groupBy("digest")
            .agg(first.alias("first"), F.sum("n").alias("n"))
            .select("digest", "first.keep_id", "n")
        )

    def add(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch: str | None = None
    ) -> DataFrame:
        """Index a batch; return its rows with what became of each.

        doc_id, digest, keep_id, group_size (equal rows indexed so far),
        kept. A text that an earlier batch brought is dropped. Of new equal
        texts the row with the largest doc_id stays (a null id is the smallest;
        of rows that repeat an id, one stays). An empty batch gives no rows.

        ``batch`` names it for a rerun: adding the same documents under the
        same name again, whether the first attempt ended or not, decides the
        same and counts nothing twice. Without a name every call is a batch of
        its own. What is written and shuffled grows with the batch; of the
        index, digests are scanned in their buckets.
        """
        name = F.lit(batch or uuid.uuid4().hex)
        rows = stored(
            docs.select(
                F.monotonically_increasing_id().alias("row"),
                F.col(doc_id).cast("long").alias("doc_id"),
                text_digest(F.col(text)).alias("digest"),
            ),
            "digests",
        )
        # per digest and id first: a group of copies shrinks before every shuffle
        groups = stored(
            rows.groupBy("digest", "doc_id")
            .agg(F.min("row").alias("row"), F.count("*").alias("n"))
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.sum("n").alias("n")),
            "digest-groups",
        )
        log = self.spark.table(self.name)
        # digests that this batch named itself, in an attempt before, are still its own
        known = log.where(F.col("named") & (F.col("batch") != name)).select("digest")
        fresh = stored(
            groups.join(known.hint("merge"), "digest", "left_anti"), "digest-fresh"
        )
        again = groups.join(fresh.select("digest").hint("merge"), "digest", "left_anti")
        more = fresh.select(
            "digest", F.lit(True).alias("named"), F.col("last.doc_id").alias("keep_id"), "n"
        ).unionByName(
            again.select(
                "digest",
                F.lit(False).alias("named"),
                F.lit(None).cast("long").alias("keep_id"),
                "n",
            )
        )
        if batch is not None:
            written = log.where(F.col("batch") == name).select("digest")
            more = stored(more.join(written.hint("merge"), "digest", "left_anti"), "digest-more")
        more = more.withColumn("batch", name)
        more.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        chosen = fresh.select("digest", F.col("last.row").alias("keep_row"))
        # written first: a join of two plain tables can be split where a digest is hot
        decided = stored(
            self.entries(groups).hint("merge").join(chosen.hint("merge"), "digest", "left"), "digest-keepers"
        )
        return rows.join(decided.hint("merge"), "digest").select(
            "doc_id",
            "digest",
            "keep_id",
            F.col("n").alias("group_size"),
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        )


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The documents that stay, with all their columns; ``batch`` as in ``DigestIndex.add``."""
    decided = stored(index.add(docs, batch=batch), "digest-decisions")
    keep = decided.where("kept").select("doc_id", "digest")
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest(F.col("text")).alias("digest"),
        F.struct("*").alias("doc"),
    )
    repeated = decided.groupBy("digest", "doc_id").count().where("count > 1")
    if not repeated.isEmpty():  # rows that repeat an id and a text: one of them stays
        packed = packed.dropDuplicates(["doc_id", "digest"])
    match = (packed["digest"] == keep["digest"]) & packed["doc_id"].eqNullSafe(keep["doc_id"])
    return packed.join(keep, match, "left_semi").select("doc.*")
