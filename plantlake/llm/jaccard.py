"""Near-duplicate join: word n-gram Jaccard as a blocked sparse matrix product.

The incidence matrix has a row per document class (documents with one and the
same shingle set) and a column per n-gram. A pair's overlap is an entry of the
matrix times its transpose. Columns are ordered from rare to frequent and split
into two blocks per row: a head, the first n - ceil(0.8 n) + 1 n-grams, and the
tail. A pair that reaches the threshold overlaps in the heads, so the product
over the head block yields all candidates; pairs whose sizes or positions rule
the threshold out are discarded there, and only what is left is multiplied over
all columns.

A column that very many rows share would square them. Classes already known to
be connected need no more links, so the product runs in rounds: first, over the
hot columns, against a few leaders per column and size band, which connects large
groups through stars; then, over the columns where classes of different components
still meet, against all of them. Every link between components is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import WORD, hands_back, sized_broadcast, small_batches, stored, whole_text
from plantlake.llm.components import components
from plantlake.llm.shingles import SHINGLE_WORDS, Shingler, set_key

#: Similarity as a percentage, so that the test is exact.
PERCENT = 80
#: Shingles a task gathers before it reports those it saw twice, and reports that make one frequent.
GATHERED = 4_000_000
FREQUENT = 3
#: Frequent n-grams whose rank every task knows. Only the order of columns depends on it.
RANKED = 1_000_000
#: A column is hot while more pairs of different components meet in it than so many per cell;
#: rounds against leaders go over hot columns, till a few in a row take hardly any pairs away.
MEETINGS_PER_CELL = 16
MAX_LEADER_ROUNDS = 6
FADING, FADED_ROUNDS = 0.9, 2
#: Leaders that are drawn per column, size band and round.
LEADERS = 3
#: Columns of a pair's heads that are counted before its heads are compared.
COUNTED = 3


def _frequencies(docs: DataFrame, words: int) -> DataFrame:
    """gram, n: n-grams that a task meets more than once, with how often (lossy counting)."""

    @hands_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(words), np.empty(GATHERED, dtype=np.uint64), 0
        for batch in batches:
            for text in batch.column(0):
                grams = shingler.grams(shingler.words(text.as_py()))
                while grams.size:
                    part = grams[: GATHERED - size]
                    held[size : size + part.size] = part
                    size, grams = size + part.size, grams[part.size :]
                    if size == GATHERED:
                        yield repeated(held)
                        size = 0
        if size:
            yield repeated(held[:size])

    def repeated(held: np.ndarray) -> pa.RecordBatch:
        """Sorted in place; of its runs only those longer than one are looked at."""
        held.sort()
        same = np.concatenate([[False], held[1:] == held[:-1], [False]])
        starts = np.flatnonzero(~same[:-1] & same[1:])
        ends = np.flatnonzero(same[:-1] & ~same[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(held[starts].view(np.int64)), pa.array((ends - starts + 1).astype(np.int64))], ["gram", "n"]
        )

    seen = docs.select("text").mapInArrow(count, "gram long, n long")
    return seen.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)


def _ranks(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and the power of two of each one's count."""
    top = _frequencies(docs, words).orderBy(F.desc("n"), "gram").limit(RANKED)
    rows = top.select("gram", F.floor(F.log2("n")).cast("byte").alias("level")).toArrow()
    grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows["level"].to_numpy().astype(np.int8)[order]


def head_size(n: int, percent: int) -> int:
    """N-grams of which a set of n shares one with every set that is similar enough."""
    return n - -(-percent * n // 100) + 1


def _sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """row, doc_id, digest, n, key, head (n-grams from rare to frequent) for every document."""
    grams, levels = _ranks(docs, words)
    ranks = docs.sparkSession.sparkContext.broadcast((grams, levels))

    @hands_back
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (grams, levels) = Shingler(words), ranks.value
        for batch in batches:
            sizes, keys, heads = [], [], []
            for text in batch.column(1):
                own = shingler.set(text.as_py())
                level = np.zeros(own.size, dtype=np.int8)
                if grams.size and own.size:
                    at = np.minimum(np.searchsorted(grams, own), grams.size - 1)
                    level = np.where(grams[at] == own, levels[at], 0)
                sizes.append(own.size)
                keys.append(set_key(own))
                head = head_size(own.size, percent) if own.size else 0
                heads.append(own[np.argsort(level, kind="stable")][:head].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(heads, pa.list_(pa.int64()))],
                ["doc_id", "digest", "n", "key", "head"],
            )

    named = docs.withColumn("digest", text_digest(F.col("text")))
    out = named.mapInArrow(
        sketch, "doc_id long, digest binary, n long, key binary, head array<long>"
    )
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "jaccard-sketches")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """key, grams: the whole set of every document given."""

    @hands_back
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            own = [shingler.set(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(set_key, own), pa.binary()),
                 pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))],
                ["key", "grams"],
            )

    return docs.select("text").mapInArrow(sets, "key binary, grams array<long>")


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(whole_text(text)))


def _linked(n1: Column, n2: Column, overlap: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (n1 + n2 - overlap)


def _may_link(n1: Column, n2: Column, percent: int) -> Column:
    """The smaller set is at least that share of the larger."""
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _head_linked(n1: Column, n2: Column, common: Column, percent: int) -> Column:
    """What two heads must share if the sets link.

    Up to the smaller of the last columns of the two heads, one head is
    complete: what it misses there, the overlap misses as well.
    """
    return common >= _needed(n1, n2, percent)


def _needed(n1: Column, n2: Column, percent: int) -> Column:
    overlap = F.ceil(percent * (n1 + n2) / (100 + percent))
    return overlap - F.ceil(percent * F.greatest(n1, n2) / 100) + 1


def _head(n: Column, percent: int) -> Column:
    """:func:`head_size` as an expression."""
    return n - F.ceil(percent * n / 100) + 1


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of (a, b), the pairs whose heads share enough: the product over the head block."""
    left = sketches.select(F.col("row").alias("a"), F.col("head").alias("ha"), F.col("n").alias("na"))
    right = sketches.select(F.col("row").alias("b"), F.col("head").alias("hb"), F.col("n").alias("nb"))
    met = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ha", "hb")).cast("long")
    may = _may_link(F.col("na"), F.col("nb"), percent)
    return met.where(may & _head_linked(F.col("na"), F.col("nb"), common, percent)).select("a", "b")


class _Verifier:
    """Multiplies pairs over all columns; reads each text's whole set once it is asked for."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, words: int, percent: int):
        self.docs, self.sketches, self.words, self.percent = docs, sketches, words, percent
        self.sets: DataFrame | None = None

    def _ask(self, nodes: DataFrame) -> None:
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        ids = self.sketches.select(F.col("row").alias("node"), "doc_id", "key")
        named = stored(nodes.join(ids, "node"), "jaccard-named")
        if named.isEmpty():
            return
        wanted = sized_broadcast(named.select(F.col("doc_id").alias("wanted")).distinct(), 16)
        texts = self.docs.join(wanted, self.docs["doc_id"].eqNullSafe(wanted["wanted"]), "left_semi")
        found = _sets(texts, self.words).join(named.select("key", "node"), "key")
        new = stored(found.dropDuplicates(["node"]).select("node", "grams"), "jaccard-sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of (a, b), the pairs that link."""
        pairs = stored(_plausible(pairs, self.sketches, self.percent), "jaccard-pairs")
        self._ask(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        if self.sets is None:
            return pairs
        left = self.sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
        right = self.sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
        met = pairs.join(left, "a").join(right, "b")
        overlap = F.size(F.array_intersect("ga", "gb")).cast("long")
        linked = _linked(F.size("ga").cast("long"), F.size("gb").cast("long"), overlap, self.percent)
        return stored(met.where(linked).select("a", "b"), "jaccard-links")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after joining the components that ``links`` connect."""
    a, b = (labels.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}")) for x in "ab")
    merged = components(
        links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    )
    merged = merged.select(F.col("id").alias("comp"), "component")
    out = labels.join(merged, "comp", "left")
    return stored(
        out.select("node", F.coalesce("component", "comp").alias("comp")), "jaccard-labels"
    )


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """row, doc_id, digest, n, comp, component_id; comp is null for rows without shingles."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = _sketches(docs, words, percent)
    classes = stored(
        sketches.where("n > 0").groupBy("key").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("first"), F.count("*").alias("rows")
        ),
        "jaccard-classes",
    )
    labels = _component_labels(docs, sketches, classes, words, percent)
    placed = classes.join(labels, "node", "left").select(
        "key", "first", F.coalesce("comp", "node").alias("comp")
    )
    least = placed.groupBy("comp").agg(F.min("first").alias("least"))
    placed = placed.join(least, "comp").select("key", "comp", "least")
    found = sketches.select("row", "doc_id", "digest", "n", "key").join(placed, "key", "left")
    has = F.col("n") > 0
    return found.select(
        "row", "doc_id", "digest", "n", F.when(has, F.col("comp")).alias("comp"),
        F.when(has, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two texts link when 100 * intersection >= percent * union of their shingle
    sets. component_id is the smallest doc_id reachable by links, the row's own
    included. A null, empty or blank text has no shingles and no links; its
    component is its own doc_id. Equal texts link. Null ids take part; they are
    never the smallest unless all are null. An empty table gives no rows.
    ``docs`` is read more than once and must give the same rows each time.
    """
    judged = _judged(docs, words, percent)
    return judged.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def deduplicate(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One document of each component stays, with all its columns: the smallest doc_id.

    Documents without shingles have no duplicates and stay. Of rows that repeat
    an id within a component one stays; null ids stay only where all are null.
    """
    judged = stored(_judged(docs, words, percent), "jaccard-judged")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "digest"))
    full = judged.where("comp is not null").groupBy("comp").agg(first.alias("first"))
    keep = full.select(F.col("first.doc_id").alias("keep_id"), F.col("first.digest").alias("keep_digest"))
    packed = docs.select(
        F.col("doc_id").cast("long").alias("id"), text_digest(F.col("text")).alias("digest"),
        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("full"), F.struct("*").alias("doc"),
    )
    repeats = judged.where("comp is not null").groupBy("doc_id", "digest").count().where("count > 1")
    if not repeats.isEmpty():
        packed = packed.where("not full").unionByName(
            packed.where("full").dropDuplicates(["id", "digest"])
        )
    same = packed["id"].eqNullSafe(keep["keep_id"]) & (packed["digest"] == keep["keep_digest"])
    met = packed.join(keep.withColumn("stays", F.lit(True)), same, "left")
    return met.where("not full or stays").select("doc.*")


def _component_labels(docs, sketches, classes, words: int, percent: int) -> DataFrame:
    """node, comp for the classes that meet another one in a head column."""
    others = sketches.where("n > 0").select("key", "row").join(
        classes.where("rows > 1").select("key", "node"), "key"
    ).where("row <> node").select("row")
    single = sketches.where("n > 0").join(sized_broadcast(others, 16), "row", "left_anti")
    heads = single.select(F.col("row").alias("node"), F.posexplode("head").alias("pos", "gram"))
    shared = heads.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    sizes = sketches.select(F.col("row").alias("node"), "n")
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    cells = stored(heads.join(shared, "gram").join(sizes, "node").withColumn("band", band), "jaccard-cells")
    own = F.col("node").alias("comp")
    labels = stored(cells.select("node").distinct().select("node", own), "jaccard-labels")
    verifier = _Verifier(docs, sketches, words, percent)
    hot, meetings = _hot_cells(cells.withColumn("comp", own))
    faded = turn = 0
    while meetings and faded < FADED_ROUNDS and turn < MAX_LEADER_ROUNDS:
        links = verifier.links(stored(_leader_pairs(hot, turn, percent), "jaccard-pairs"))
        before, turn = meetings, turn + 1
        if not links.isEmpty():
            labels = _relabelled(labels, links)
            hot, meetings = _hot_cells(_labelled(hot, labels))
        faded = faded + 1 if meetings > FADING * before else 0
    links = verifier.links(_all_pairs(_open_cells(cells, labels) if turn else cells.withColumn("comp", own), percent))
    return labels if links.isEmpty() else _relabelled(labels, links)


def _labelled(cells: DataFrame, labels: DataFrame) -> DataFrame:
    return cells.drop("comp").join(labels, "node")


def _open_cells(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """The cells, with their component, of columns where different components meet."""
    known = _labelled(cells, labels)
    ends = known.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return stored(known.join(ends.where("lo < hi").select("gram"), "gram"), "jaccard-cells")


def _hot_cells(cells: DataFrame) -> tuple[DataFrame, float]:
    """The cells of hot columns, and the pairs of different components that meet there, over all of them."""
    sizes = cells.groupBy("gram", "comp").agg(F.count("*").cast("double").alias("n"))
    columns = sizes.groupBy("gram").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    columns = columns.withColumn("pairs", (F.col("all") * F.col("all") - F.col("same")) / 2)
    hot = stored(columns.where(F.col("pairs") > MEETINGS_PER_CELL * F.col("all")).select("gram", "pairs"), "jaccard-hot")
    meetings = hot.agg(F.sum("pairs")).first()[0] or 0.0
    return (stored(cells.join(hot.select("gram"), "gram"), "jaccard-cells") if meetings else cells), meetings


def _leader_pairs(cells: DataFrame, turn: int, percent: int) -> DataFrame:
    """a, b: each class with the leaders, of other components, that it overlaps most, one for each draw.

    A column has leaders in each size band: the class with the largest share of
    hot columns, which is at the centre of its group, and others drawn by a hash,
    so that large groups mostly share them and each turn draws others. Classes
    meet those of their own band and of the bands beside it.
    """
    share = cells.groupBy("node").agg((F.count("*") / F.max("n")).alias("share"))

    def order(draw: int) -> Column:
        drawn = F.xxhash64(F.lit(turn), F.lit(draw), F.col("node"))
        return F.struct((F.lit(0.0) if draw else -F.col("share")).alias("share"), drawn.alias("drawn"))

    lead = cells.join(share, "node").groupBy("gram", "band").agg(*[
        F.min(F.struct(order(draw).alias("order"), "node", "comp", "n")).alias(f"lead{draw}") for draw in range(LEADERS)
    ])
    lead = lead.select(
        "gram", "band", F.posexplode(F.array(*[F.col(f"lead{draw}") for draw in range(LEADERS)])).alias("draw", "lead")
    )
    lead = lead.select(
        "gram", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"), "draw",
        *[F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("node", "comp", "n")],
    )
    met = cells.join(lead, ["gram", "band"]).where(
        (F.col("comp") != F.col("lead_comp")) & _may_link(F.col("n"), F.col("lead_n"), percent)
    )
    overlaps = met.groupBy("node", "draw", "lead_node").agg(F.count("*").alias("overlap"))
    best = F.max_by("lead_node", F.struct("overlap", "lead_node"))
    pairs = overlaps.groupBy("node", "draw").agg(best.alias("b"))
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _all_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """a, b: classes of different components that meet in a head column and may still link."""
    x = cells.select("gram", *[F.col(c).alias(f"{c}x") for c in ("node", "comp", "n", "pos")])
    y = cells.select("gram", *[F.col(c).alias(f"{c}y") for c in ("node", "comp", "n", "pos")])
    longer = (F.col("nx") > F.col("ny")) | (F.col("nx") == F.col("ny")) & (F.col("nodex") > F.col("nodey"))
    # the heads share ``needed`` columns or more; of those, the first ``some`` lie so far in front
    # in both heads that the others have room behind them
    needed = _needed(F.col("nx"), F.col("ny"), percent)
    some = F.least(needed, F.lit(COUNTED))
    room = needed - some
    ahead = (F.col("posx") < _head(F.col("nx"), percent) - room) & (
        F.col("posy") < _head(F.col("ny"), percent) - room
    )
    met = x.join(y, "gram").where(
        (F.col("compx") != F.col("compy")) & longer & _may_link(F.col("nx"), F.col("ny"), percent) & ahead
    )
    overlaps = met.groupBy(F.col("nodex").alias("a"), F.col("nodey").alias("b")).agg(
        F.count("*").alias("overlap"), F.first(some).alias("some")
    )
    return overlaps.where(F.col("overlap") >= F.col("some")).select("a", "b")
