"""Reversible line dedup: cuckoo filters over exact reference counts.

The exact side is a log of postings (line, document, +1 or -1): inserting a
batch appends its lines, deleting documents appends their negation, and a
line's reference count is the number of documents with a positive sum. Cuckoo
filters, one per shard of the line hashes, hold the lines with enough
references to be dropped. Most lines of a text miss them and need no lookup;
hits are settled by the exact counts. Crossing the threshold upwards inserts a
line into its filter, crossing it downwards deletes it, so a deleted document
gives the others their lines back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.common import small_batches, stored
from plantlake.llm.cuckoo import CuckooFilter
from plantlake.sinks.folders import Folders

MIN_CHARS = 20
MIN_DOCS = 3
#: Lines of one filter, about. Filters up to this size in all go to every task.
SHARD_LINES = 50_000
MAX_SHIPPED_BYTES = 32 * 1024 * 1024

POSTING = "high long, low long, doc_id long, sign int"


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Per line the key that decides, None for lines too short to be dropped."""
    keys: list[bytes | None] = []
    for raw in (text or "").encode().split(b"\n"):
        key = raw.strip().lower()
        long = len(key) >= min_chars and len(key.decode()) >= min_chars
        keys.append(key if long else None)
    return keys


def key_hash(key: bytes) -> bytes:
    """128 bits that stand for a line."""
    return xxhash.xxh3_128_digest(key)


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _line_rows(batch: pa.RecordBatch, min_chars: int, passes=None) -> pa.RecordBatch:
    """high, low, doc_id: the distinct lines of each text, of those that ``passes``."""
    owner, hashes = [], []
    for k, text in enumerate(batch.column(1)):
        own = {key_hash(key) for key in line_keys(text.as_py(), min_chars) if key is not None}
        hashes += own
        owner += [k] * len(own)
    high, low = _halves(hashes)
    owners = np.array(owner, dtype=np.int64)
    if passes is not None:
        hit = passes(high, low)
        high, low, owners = high[hit], low[hit], owners[hit]
    return pa.RecordBatch.from_arrays(
        [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), batch.column(0).take(pa.array(owners))],
        ["high", "low", "doc_id"],
    )


class LineIndex:
    """Postings and filters below ``path``; opening an existing path goes on with it.

    A change counts once its postings are complete. If it stopped before, it is as if it had not
    begun; if it stopped later, opening builds the filters from the counts. Repeating an insertion
    changes no count, since documents are counted, not postings.
    """

    def __init__(
        self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
        shard_lines: int = SHARD_LINES,
    ):
        self.spark, self.path = spark, path
        self.min_docs, self.min_chars, self.shard_lines = min_docs, min_chars, shard_lines
        folders = Folders(spark, path)
        done = [
            int(name.split("=")[1]) for name in folders.names(f"{path}/postings")
            if name.startswith("batch=") and folders.exists(f"{path}/postings/{name}/_SUCCESS")
        ]
        self.batch, self.filters = max(done, default=-1) + 1, None
        if not self.batch:
            return
        made = f"{path}/filters-{self.batch}"
        if folders.exists(f"{made}/_SUCCESS"):
            self.filters = spark.read.parquet(made)
        else:  # the last change ended before its filters were written
            self._rebuild()

    # --- the exact side ---

    def postings(self) -> DataFrame:
        log = self.spark.read.schema(POSTING + ", batch int").parquet(f"{self.path}/postings")
        return log.where(F.col("batch") < self.batch)

    def holders(self, postings: DataFrame | None = None) -> DataFrame:
        """high, low, doc_id: the documents that hold a line now."""
        net = (self.postings() if postings is None else postings).groupBy("high", "low", "doc_id")
        return net.agg(F.sum("sign").alias("net")).where("net > 0").drop("net")

    def references(self, postings: DataFrame | None = None) -> DataFrame:
        """high, low, n_docs, last_doc: exact counts; a null id is a document, the smallest."""
        return self.holders(postings).groupBy("high", "low").agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )

    def _lines(self, docs: DataFrame, passes=None) -> DataFrame:
        min_chars = self.min_chars

        def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probe = passes() if passes else None
            for batch in batches:
                yield _line_rows(batch, min_chars, probe)

        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return docs.mapInArrow(lines, "high long, low long, doc_id long")

    # --- changes ---

    def insert(self, docs: DataFrame) -> None:
        """Add the lines of ``docs`` (doc_id, text)."""
        small_batches(self.spark)
        self._append(self._lines(docs).withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame) -> None:
        """Take back all lines of the documents in ``ids`` (doc_id)."""
        gone = ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        net = self.postings().groupBy("high", "low", "doc_id").agg(F.sum("sign").cast("int").alias("net"))
        held = net.where("net <> 0").join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")
        self._append(held.select("high", "low", "doc_id", (-F.col("net")).alias("sign")))

    def _append(self, rows: DataFrame) -> None:
        target = f"{self.path}/postings/batch={self.batch}"
        rows.write.mode("overwrite").parquet(target)  # what an attempt cut short left goes
        self.batch += 1
        added = self.spark.read.schema(POSTING).parquet(target)
        if self.batch == 1:
            after = self.references(added.withColumn("batch", F.lit(0)))
            changes = self._repeated(after).withColumn("sign", F.lit(1))
        else:
            touched = added.select("high", "low").distinct()
            now = self.postings().join(touched, ["high", "low"], "left_semi")
            before = self._repeated(self.references(now.where(F.col("batch") < self.batch - 1)))
            after = self._repeated(self.references(now))
            changes = after.withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1)))
            changes = changes.groupBy("high", "low").agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")
        self._refilter(stored(changes, "line-changes"))

    def _repeated(self, references: DataFrame) -> DataFrame:
        return references.where(F.col("n_docs") >= self.min_docs).select("high", "low")

    def _rebuild(self) -> None:
        """All filters anew, from the counts."""
        self.filters = None
        kept = self._repeated(self.references())
        self._refilter(stored(kept.withColumn("sign", F.lit(1)), "line-changes"))

    def _refilter(self, changes: DataFrame) -> None:
        """Insert into and delete from the filters of the shards that change."""
        lines = changes.count()
        if self.filters is None:
            shards = max(1, math.ceil(lines / self.shard_lines))
            old = self.spark.createDataFrame([], "shard int, shards int, filter binary")
        else:
            old = self.filters
            shards = (old.agg(F.max("shards")).first()[0]) or 1
        changes = changes.withColumn("shard", _shard(F.col("low"), shards))

        def update(old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
            shard = int((old if len(old) else changes)["shard"].iloc[0])
            high, low = (changes[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("high", "low"))
            up = changes["sign"].to_numpy() > 0
            held = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else None
            if held is None:
                held = CuckooFilter.build(high[up], low[up])
                full = False
            else:
                held.delete(high[~up], low[~up])
                full = not held.insert(high[up], low[up])
            blob = None if full else held.dump()
            return pd.DataFrame({"shard": [shard], "shards": [shards], "filter": [blob]})

        made = old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(
            update, "shard int, shards int, filter binary"
        )
        path = f"{self.path}/filters-{self.batch}"
        made = stored(made, "line-filters")
        if not made.where("filter is null").isEmpty():  # one has no room left: build all anew
            return self._rebuild()
        made.write.mode("overwrite").parquet(path)
        self.filters = self.spark.read.schema(made.schema).parquet(path)

    # --- use ---

    def _probe(self):
        """Makes the test whether lines may be dropped; None if the filters are too large to ship."""
        size = self.filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size > MAX_SHIPPED_BYTES:
            return None
        found = self.filters.collect()
        shards = found[0]["shards"] if found else 1
        shipped = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in found})

        def make():
            filters = {k: CuckooFilter.load(v) for k, v in shipped.value.items()}

            def passes(high: np.ndarray, low: np.ndarray) -> np.ndarray:
                hit = np.zeros(high.size, dtype=bool)
                shard = (low >> np.uint64(32)) % np.uint64(shards)
                for k, held in filters.items():
                    mine = shard == k
                    hit[mine] = held.contains(high[mine], low[mine])
                return hit

            return passes

        return make

    def drops(self, docs: DataFrame) -> DataFrame:
        """drop_id, lines (hashes): the lines that each document of ``docs`` loses."""
        hits = self._lines(docs, self._probe())
        # written first: a join of two plain tables can be split where a line is hot
        counted = stored(self.references().where(F.col("n_docs") >= self.min_docs), "line-counts")
        hits = stored(hits, "line-hits").join(counted, ["high", "low"])
        lost = hits.where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        line = F.struct("high", "low")
        return lost.groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_set(line).alias("lines"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept (text) for every row of ``docs`` (doc_id, text).

        A null or empty text is one empty line. Rows of one doc_id count as
        one document. Lines that appear more than once in a document all stay
        or all go. If no line stays, the kept text is empty.
        """
        small_batches(self.spark)
        drops = stored(self.drops(docs), "line-drops")
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        met = docs.join(drops, docs["doc_id"].eqNullSafe(drops["drop_id"]), "left")
        min_chars = self.min_chars

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, dropped, kept = [], [], []
                for text, lines in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    raw = (text or "").split("\n")
                    sizes.append(len(raw))
                    if lines:
                        bad = {(x["high"], x["low"]) for x in lines}
                        keys = line_keys(text, min_chars)
                        raw = [r for r, key in zip(raw, keys, strict=True) if key is None or _pair(key) not in bad]
                    dropped.append(sizes[-1] - len(raw))
                    kept.append("\n".join(raw))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_lines", "n_dropped", "kept"],
                )

        return met.select("doc_id", "text", "lines").mapInArrow(
            keep, "doc_id long, n_lines long, n_dropped long, kept string"
        )


def _pair(key: bytes) -> tuple[int, int]:
    high, low = _halves([key_hash(key)])
    return int(high.view(np.int64)[0]), int(low.view(np.int64)[0])


def _shard(low: Column, shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned(low, 32), F.lit(shards)).cast("int")
