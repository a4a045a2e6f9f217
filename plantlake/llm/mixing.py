"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order. A document's
virtual finish time is its source's cumulative words divided by the source's
target; a source whose target is above its size goes round again. Sending
documents in order of finish time serves all sources at their weights, and the
budget is spent when virtual time reaches one: the documents being sent then
are cut. Cumulative sums are built from sums per bucket, so no source is ever
sorted by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.llm.common import WORD, sized_broadcast, stored, whole_text

#: No document is taken more often than this.
MAX_PASSES = 3
#: Rows of a source that one task orders, about.
BUCKET_ROWS = 10_000


def words(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def weighted_targets(sizes: DataFrame, cycle=(1, 2, 3), passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, n → adds place, target: water filling.

    Sources by code point (UTF-8 order), null last, get the weights of
    ``cycle`` in turn and share the sum of all sizes by weight. A target stops
    at ``passes`` times its source's size. Taken in order of size per weight,
    sources are full up to some place; from there on all share one level. One
    row per source goes through one task here, never a row per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1).cast("int")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), F.col("place") % len(cycle) + 1)
    ranked = sizes.withColumn("place", place).withColumn("weight", pick)
    room = F.col("source_size") * passes
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = F.sum(room).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(total) - F.coalesce(before, F.lit(0))
    filled = (
        ranked.withColumn("turn", F.row_number().over(order))
        .withColumn("level", left / F.sum("weight").over(ahead))
        .withColumn("full", room <= F.col("level") * F.col("weight"))
    )
    first = F.min(F.when(~F.col("full"), F.struct("turn", "level"))).over(total)
    target = F.when(F.col("full"), room.cast("double")).otherwise(first["level"] * F.col("weight"))
    return filled.withColumn("target", target).select(
        "source", "place", "source_size", "n", "target"
    )


def queued(
    docs: DataFrame, seed: int = 0, bucket_rows: int = BUCKET_ROWS, hashed_id: str = "doc_id"
) -> DataFrame:
    """Each row of ``docs`` in its source's queue.

    ``docs`` has doc_id, text, source. Returns row, doc_id, size, source_size,
    target and ahead: the words of the source before this document in the
    shuffled order (by a hash of seed and doc_id; a null id hashes like an
    empty one). Null and empty texts have size 0.
    """
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(hashed_id).cast("string"), F.lit(""))))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "source",
            words(F.col("text")).alias("size"),
            F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long").alias("h"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")
    )
    sources = stored(weighted_targets(sizes), "mix-sources")
    longest = sources.agg(F.max(F.octet_length("source"))).first()[0] or 0
    known = sized_broadcast(sources.withColumnRenamed("source", "name"), 64 + longest)
    slots = F.ceil(F.col("n") / bucket_rows)
    rows = rows.join(known, rows["source"].eqNullSafe(known["name"])).select(
        "row", "doc_id", "size", "h", "place", "source_size", "target",
        F.floor(F.col("h") / float(2**60) * slots).alias("bucket"),
    )
    cells = rows.groupBy("place", "bucket").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")
    )
    # ids repeated very often hash alike: such a bucket is dealt out by row
    parts = F.when(F.col("n") > 4 * bucket_rows, F.ceil(F.col("n") / bucket_rows)).otherwise(1)
    cells = stored(
        cells.withColumn("parts", parts).withColumn("ahead", _before("words", ["place"], "bucket")),
        "mix-buckets",
    ).select("place", "bucket", "parts", "ahead")
    rows = rows.join(sized_broadcast(cells, 48), ["place", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts"))
    )
    keys = ["place", "bucket", "part"]
    if not cells.where("parts > 1").isEmpty():
        split = rows.where("parts > 1").groupBy(*keys).agg(F.sum("size").alias("words"))
        split = stored(
            split.withColumn("more", _before("words", ["place", "bucket"], "part")), "mix-parts"
        ).select(*keys, "more")
        rows = rows.join(sized_broadcast(split, 48), keys, "left").withColumn(
            "ahead", F.col("ahead") + F.coalesce("more", F.lit(0))
        )
    inside = F.sum("size").over(Window.partitionBy(*keys).orderBy("h", "row")) - F.col("size")
    return rows.select(
        "row", "doc_id", "size", "source_size", "target", (F.col("ahead") + inside).alias("ahead")
    )


def _before(value: str, group: list[str], order: str) -> Column:
    """The sum of ``value`` over the group's earlier rows."""
    here = Window.partitionBy(*group).orderBy(order)
    return F.sum(value).over(here) - F.col(value)


def mix(queue: DataFrame, passes: int = MAX_PASSES) -> DataFrame:
    """The copies that are sent, in order of virtual finish time.

    ``queue`` is what :func:`queued` returns. row, doc_id, turn (0 for the
    first pass over the source), finish, taken: the words sent of this copy.
    A copy is sent if it starts before virtual time one, when the budget (the
    sum of all targets) is spent; the copy a source is sending then is cut.
    Empty documents are never sent.
    """
    copies = queue.where("size > 0 and target > 0").withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))
    )
    start = F.col("turn") * F.col("source_size") + F.col("ahead")
    finish = (start + F.col("size")) / F.col("target")
    left = F.floor("target") - start
    return (
        copies.where(left > 0)
        .select(
            "row", "doc_id", "turn", finish.alias("finish"), F.least("size", left).alias("taken")
        )
        .orderBy("finish", "doc_id", "row")
    )


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents of the mix, with all their columns: a row per copy sent.

    Copies are whole: the one copy per source that the budget cuts is sent to
    its end, which overruns the budget by less than a document per source.
    """
    # rows of one id are told apart by their content; equal rows are interchangeable
    plain = [f"`{f.name}`" for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    packed = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64(*plain).alias("content"), F.struct("*").alias("doc")
    )
    marked = packed.select(
        F.struct("id", "content").alias("doc_id"), "doc.text", "doc.source"
    )
    queue = stored(queued(marked, seed, hashed_id="doc_id.id"), "mix-queue")
    copies = (
        queue.join(mix(queue).groupBy("row").agg(F.count("*").alias("sent")), "row")
        .groupBy("doc_id")
        .agg(F.sum("sent").cast("int").alias("sent"), F.count("*").alias("n"))
        .select("doc_id.*", "sent", "n")
    )
    copies = stored(copies, "mix-copies").withColumnsRenamed({"id": "sent_id", "content": "sent_content"})
    if not queue.groupBy("doc_id").count().where("count > 1").isEmpty():
        packed = packed.dropDuplicates(["id", "content"])
    same = packed["id"].eqNullSafe(copies["sent_id"]) & (packed["content"] == copies["sent_content"])
    dealt = packed.join(copies, same).select("doc", F.expr("explode(array_repeat(0, sent))").alias("copy"))
    return dealt.select("doc.*")
