"""Substring dedup: fuzzy passages that documents share, by collinear chaining.

Seeds are minimizers of the word k-mers, so texts that share a run of words
share a seed in it. Each seed's occurrences are matched with the first row that
holds it, which is linear in the occurrences however many documents share a
passage. The matches of a document with one other are chained under gap costs
and the chains are aligned, extended and cut into passages.

A seed's first holder need not hold the whole passage. Stretches of MIN_WORDS
words that no passage covers are therefore matched as a whole with the first
row that holds all of their words, found by runs of seeds; that is linear too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.chaining import chains, passages
from plantlake.llm.common import sized_broadcast, small_batches, stored, whole_text
from plantlake.llm.shingles import Shingler, mixed

#: Words of a k-mer; k-mers of which one is kept. Any run of SEED + WINDOW - 1 words has a seed.
SEED, WINDOW = 8, 10
#: Passages: words at least, and the share of words that match.
MIN_WORDS, MIN_IDENTITY = 50, 0.8
#: Chains that are aligned first: words from the first seed to the end of the last, at least.
MIN_SPAN = 2 * SEED
#: Words that no passage covers yet and a further one must bring; fewer may match by chance at its ends.
NEW_WORDS = 8

#: An odd number and its inverse modulo 2^64, for hashes of runs of seeds.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

PASSAGE = "start int, end int, source_start int, source_end int, matches int"


#: Words whose seeds are worked out at once.
AT_ONCE = 32_768


def minimizers(grams: np.ndarray) -> np.ndarray:
    """Positions of the smallest k-mer of every window, the leftmost of equals; of all if there are few."""
    return minimizers_of(grams, np.zeros(1, dtype=np.int64), np.array([grams.size]))[0]


def minimizers_of(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of many texts, whose k-mers are ``sizes`` from ``starts`` on: positions in ``grams``, the text of each."""
    counts = np.where(sizes > WINDOW, sizes - WINDOW + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(sizes.size), counts)
    before = np.cumsum(counts) - counts
    heads = np.arange(owner.size) + (starts - before)[owner]
    large = sizes[owner] > WINDOW
    if large.any():
        heads[large] = leftmost_minima(grams, WINDOW)[heads[large]]
    for text in np.flatnonzero((sizes > 0) & (sizes <= WINDOW)):
        heads[before[text]] += grams[starts[text] : starts[text] + sizes[text]].argmin()
    # they never go back from one window to the next, and no two texts share one
    new = np.ones(heads.size, dtype=bool)
    new[1:] = heads[1:] != heads[:-1]
    return heads[new], owner[new]


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost minimum of every window, by windows of twice the width each time."""
    least, place, size = values, np.arange(values.size), 1
    while size < width:
        step = min(size, width - size)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    return place


def stretch_hashes(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on, the same wherever they stand."""
    # a polynomial in BASE, modulo 2^64; differences of its prefix sums, shifted back to power 0
    power, back = np.full((2, words.size), 1, dtype=np.uint64)
    power[1:], back[1:] = BASE, BASE_INVERSE
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(words) * power)])
    return mixed((sums[at + width] - sums[at]) * back[at])


def runs_of(grams: np.ndarray, at: np.ndarray, min_words: int, owner: np.ndarray | None = None) -> np.ndarray:
    """A hash of the seeds from each one on, as far as any ``min_words`` equal words have them; 0 at the end.

    The first and the last seed of such words are at most WINDOW - 1 places from their ends.
    ``owner`` tells the texts of seeds apart, if they are of several ones.
    """
    reach = max(0, min_words - SEED - 2 * (WINDOW - 1))
    last = np.searchsorted(at, at + reach)
    own, out = grams[at], np.zeros(at.size, dtype=np.uint64)
    inside = last < at.size
    if owner is not None:
        inside[inside] = owner[last[inside]] == owner[inside]
    whole = np.flatnonzero(inside)
    # a polynomial in BASE over the seeds, modulo 2^64; differences of its prefix sums, shifted back to power 0
    power, back = np.full((2, at.size + 1), 1, dtype=np.uint64)
    power[1:], back[1:] = BASE, BASE_INVERSE
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(own) * power[:-1])])
    run = (sums[last[whole] + 1] - sums[whole]) * back[whole]
    out[whole] = mixed(run + (last[whole] - whole).astype(np.uint64)) | np.uint64(1)
    return out


def seeds_of(shingler: Shingler, texts: list[np.ndarray], min_words: int) -> tuple[np.ndarray, ...]:
    """The text, place, seed and run of each seed of texts, given as words.

    Where a text repeats a few words on and on, a seed that overlaps its own
    previous occurrence and starts the same run is left out: extension covers it.
    """
    sizes = np.array([text.size for text in texts])
    starts = np.cumsum(sizes) - sizes
    words = np.concatenate(texts)
    grams = shingler.grams(words) if words.size >= SEED else words[:0]
    at, owner = minimizers_of(grams, starts, np.maximum(0, sizes - SEED + 1))
    own, run = grams[at], runs_of(grams, at, min_words, owner)
    again = (own[1:] == own[:-1]) & (np.diff(at) <= SEED) & (run[1:] == run[:-1]) & (owner[1:] == owner[:-1])
    new = np.concatenate([np.ones(min(1, at.size), dtype=bool), ~again])
    owner = owner[new]
    return owner, at[new] - starts[owner], own[new], run[new]


class Tokenised:
    """Word hashes of texts by row; those of a few million words are remembered, the oldest go first."""

    def __init__(self, room: int = 4_000_000):
        self.shingler, self.known, self.room, self.held = Shingler(), {}, room, 0

    def words(self, row: int, text: pa.Scalar) -> np.ndarray:
        if row not in self.known:
            found = self.shingler.words(text.as_py())
            self.held += found.size
            while self.known and self.held > self.room:
                self.held -= self.known.pop(next(iter(self.known))).size
            self.known[row] = found
        return self.known[row]


def _seeds(texts: DataFrame, min_words: int) -> DataFrame:
    """row, pos, seed, run: the occurrences of each seed in each text, as ``seeds_of`` has them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(SEED)
        for batch in batches:
            rows, texts, first, held = batch.column(0).to_numpy(), [], 0, 0
            for i, text in enumerate(batch.column(1), 1):
                texts.append(shingler.words(text.as_py()))
                held += texts[-1].size
                if held < AT_ONCE and i < rows.size:
                    continue
                owner, places, seeds, runs = seeds_of(shingler, texts, min_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[first:i][owner]), pa.array(places.astype(np.int32)),
                     pa.array(seeds.view(np.int64)), pa.array(runs.view(np.int64))],
                    ["row", "pos", "seed", "run"],
                )
                texts, first, held = [], i, 0

    return texts.mapInArrow(find, "row long, pos int, seed long, run long")


def _windows(held: DataFrame, min_words: int) -> DataFrame:
    """row, at, window, run: stretches of ``min_words`` words that start with one of the row's ``runs``, by their hash.

    ``held`` has row, text, runs and spans; stretches that bring few words outside of the spans are left out.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(SEED)
        for batch in batches:
            out = [[np.zeros(0, dtype=np.int64)] for _ in range(4)]
            for row, text, wanted, spans in zip(*(batch.column(c) for c in range(4)), strict=True):
                words = shingler.words(text.as_py())
                if words.size < max(min_words, SEED):
                    continue
                grams = shingler.grams(words)
                at = minimizers(grams)
                runs = runs_of(grams, at, min_words).view(np.int64)
                starts = np.arange(words.size - min_words + 1)
                # the first seed of a stretch is the smallest of its first k-mers
                size = min(WINDOW, min_words - SEED + 1, grams.size)
                heads = leftmost_minima(grams, size)[: starts.size]
                place = np.minimum(np.searchsorted(at, heads), at.size - 1)
                run = runs[place]
                ok = (at[place] == heads) & np.isin(run, np.array(wanted.as_py(), dtype=np.int64))
                new = np.ones(words.size + 1, dtype=np.int64)
                for span in spans.as_py() or []:
                    new[span["start"] : span["end"]] = 0
                new = np.cumsum(new) - new
                kept = np.flatnonzero(ok & (new[min_words:] - new[:-min_words] >= NEW_WORDS))
                if kept.size:
                    found = stretch_hashes(words, kept, min_words).view(np.int64)
                    for column, values in zip(out, (np.full(kept.size, row.as_py()), kept, found, run[kept]), strict=True):
                        column.append(values)
            row, at, window, run = (np.concatenate(column) for column in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(at.astype(np.int32)), pa.array(window), pa.array(run)],
                ["row", "at", "window", "run"],
            )

    columns = held.select("row", "text", "runs", "spans")
    return columns.mapInArrow(find, "row long, at int, window long, run long")


def _new(spans: DataFrame, found: DataFrame) -> DataFrame:
    """The ``spans`` that bring NEW_WORDS words or more that no passage of ``found`` covers."""
    covered = found.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("covered"))
    new = (
        "size(filter(sequence(start, end - 1), w -> not exists(coalesce(covered, array()),"
        " s -> w >= s.start and w < s.end)))"
    )
    met = spans.join(covered, "row", "left")
    return met.where(F.expr(new) >= NEW_WORDS).select(*spans.columns)


def _left_over(runs: DataFrame, held: DataFrame, spans: DataFrame, min_words: int) -> DataFrame:
    """row, source, xs, ys, sizes: stretches outside of ``spans``, with the first row that holds all their words.

    ``runs`` has row, run and source, the run's first row; ``held`` the texts.
    """
    covered = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    late = runs.where("row > source").groupBy("row").agg(F.collect_set("run").alias("runs"))
    late = held.join(late, "row").join(covered, "row", "left")
    open_ = stored(_windows(late, min_words), "passage-open")
    wanted = sized_broadcast(open_.select(F.col("run").alias("open")).distinct(), 16)
    holders = runs.join(wanted, runs["run"] == wanted["open"], "left_semi")
    holders = holders.groupBy("row").agg(F.collect_set("run").alias("runs"))
    holders = held.join(holders, "row").withColumn("spans", F.lit(None).cast("array<struct<start int, end int>>"))
    first = _windows(holders, min_words).groupBy("window").agg(F.min(F.struct("row", "at")).alias("first"))
    met = open_.join(first, "window").where("first.row < row").select(
        "row", "at", F.col("first.row").alias("source"), (F.col("at") - F.col("first.at")).alias("shift")
    )
    met = met.groupBy("row", "source", "shift").agg(F.sort_array(F.collect_list("at")).alias("xs"))
    met = met.groupBy("row", "source").agg(F.collect_list(F.struct("xs", "shift")).alias("chains"))
    return met.select(
        "row", "source", F.expr("flatten(chains.xs)").alias("xs"),
        F.expr("flatten(transform(chains, c -> transform(c.xs, x -> x - c.shift)))").alias("ys"),
        F.expr("transform(chains, c -> size(c.xs))").alias("sizes"),
    )


def _chained(matches: DataFrame) -> DataFrame:
    """row, source, long, xs, ys, sizes: the chains of two rows, one after the other, with the seeds of each.

    Those that span MIN_SPAN words or more are ``long`` and apart from the rest;
    one of a single seed may be a passage as well.
    """

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            ends = batch.column(2).offsets.to_numpy()
            xs, ys = (places.to_numpy() for places in batch.column(2).values.flatten())
            pairs = zip(*(batch.column(c).to_pylist() for c in range(2)), ends[:-1], ends[1:], strict=True)
            for row, source, first, end in pairs:
                x, y = xs[first:end], ys[first:end]
                kinds = {True: [], False: []}
                for found in chains(x, y, SEED):
                    kinds[bool(x[found[-1]] + SEED - x[found[0]] >= MIN_SPAN)].append(found)
                for long, own in kinds.items():
                    if own:
                        seeds = np.concatenate(own)
                        sizes = np.array([found.size for found in own], dtype=np.int32)
                        for column, value in zip(out, (row, source, long, x[seeds], y[seeds], sizes), strict=True):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.list_(pa.int32())] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)],
                ["row", "source", "long", "xs", "ys", "sizes"],
            )

    grouped = matches.groupBy("row", "source").agg(
        F.collect_list(F.struct("pos", "source_pos")).alias("met")
    )
    return grouped.select("row", "source", "met").mapInArrow(
        chain, "row long, source long, long boolean, xs array<int>, ys array<int>, sizes array<int>"
    )


def _aligned(met: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """row, source and the passages of each chain, given both texts, which a pair's chains share."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Tokenised()
        for batch in batches:
            keys, rows = [], []
            for row, source, text, other, xs, ys, sizes in zip(
                *(batch.column(c) for c in range(7)), strict=True
            ):
                key = row.as_py(), source.as_py()
                a, b = texts.words(key[0], text), texts.words(key[1], other)
                x, y, sizes = (v.values.to_numpy() for v in (xs, ys, sizes))
                end = 0
                for size in sizes.tolist():
                    end += size
                    for found in passages(a, b, x[end - size : end], y[end - size : end], SEED, min_words, min_identity):
                        keys.append(key)
                        rows.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[c] for k in keys], pa.int64()) for c in range(2)]
                + [pa.array([r[c] for r in rows], pa.int32()) for c in range(5)],
                ["row", "source", "start", "end", "source_start", "source_end", "matches"],
            )

    columns = ["row", "source", "text", "other", "xs", "ys", "sizes"]
    return met.select(*columns).mapInArrow(align, f"row long, source long, {PASSAGE}")


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY
) -> DataFrame:
    """doc_id, start, end, source_id, source_start, source_end, matches, a row per passage.

    ``docs`` has doc_id and text. A passage is a stretch of words (positions
    from zero, end exclusive) of a document that an earlier row, the source,
    holds as well, but for a share of its words; A-Z count as a-z. Documents
    whose whole text an earlier row has are one passage. Null, empty and short
    texts have none; equal ids are told apart by row. Overlapping passages
    with different sources are all reported, but a source that would add fewer
    than NEW_WORDS words to those found need not be. Equal stretches of
    ``min_words`` words are always covered, but for such ends; fuzzy ones need a
    seed, SEED equal words in a row that were kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    digest = F.unhex(F.md5(whole_text(F.col("text"))))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
            digest.alias("digest"),
        ),
        "passage-rows",
    )
    classes = stored(
        rows.groupBy("digest").agg(F.min("row").alias("row"), F.count("*").alias("n")), "passage-classes"
    )
    # one text of each class: equal texts give equal seeds
    first = classes.where("n > 1").select(F.col("row").alias("first"), F.col("digest").alias("several"))
    texts = docs.select(F.monotonically_increasing_id().alias("at"), "text")
    copies = rows.join(first, rows["digest"] == first["several"]).where("row <> first")
    seeds = _seeds(texts, min_words).withColumnRenamed("row", "at")
    seeds = seeds.join(
        sized_broadcast(copies.select(F.col("row").alias("at")), 16), "at", "left_anti"
    ).withColumnRenamed("at", "row")
    seeds = stored(seeds, "passage-seeds")
    shared = seeds.groupBy("seed").agg(
        F.min("row").alias("source"), F.max("row").alias("last")
    ).where("source < last").select("seed", "source")
    met = stored(seeds.select("row", "pos", "seed", "run").join(shared, "seed"), "passage-shared")
    heads = met.where("row = source").groupBy("seed").agg(F.min("pos").alias("source_pos"))
    matches = met.where("row <> source").join(heads, "seed").select("row", "source", "pos", "source_pos")
    found = stored(_chained(matches), "passage-chains")

    # a run that two rows have starts with a seed that both have
    whole = met.where("run <> 0").select("row", "run")
    several = whole.groupBy("run").agg(F.min("row").alias("source"), F.max("row").alias("last"))
    runs = stored(whole.join(several.where("source < last").drop("last"), "run"), "passage-runs")

    ids = found.select("row").union(found.select(F.col("source").alias("row"))).union(runs.select("row")).distinct()
    wanted = sized_broadcast(stored(ids, "passage-named"), 16)
    held = stored(texts.withColumnRenamed("at", "row").join(wanted, "row", "left_semi"), "passage-texts")
    others = held.select(F.col("row").alias("source"), F.col("text").alias("other"))

    def spans_of(found: DataFrame, label: str) -> DataFrame:
        both = found.join(held, "row").join(others, "source")
        return stored(_aligned(both, min_words, min_identity), label)

    spans = spans_of(found.where("long"), "passage-spans")
    short = spans_of(found.where("not long"), "passage-short")
    spans = spans.union(stored(_new(short, spans), "passage-new"))
    left = stored(_left_over(runs, held, spans, min_words), "passage-left")
    spans = spans.union(spans_of(left, "passage-more").distinct())
    named = rows.select("row", "doc_id")
    sources = rows.select(F.col("row").alias("source"), F.col("doc_id").alias("source_id"))
    fuzzy = spans.join(named, "row").join(sources, "source").select(
        "doc_id", "start", "end", "source_id", "source_start", "source_end", "matches"
    )
    return fuzzy.unionByName(_copies(copies, sources, texts, min_words))


def _word_counts(texts: DataFrame) -> DataFrame:
    """row, words. Not an expression, as a filter on that would go before the join and count words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len((text.as_py() or "").encode().split()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], ["row", "words"])

    return texts.mapInArrow(count, "row long, words int")


def _copies(copies: DataFrame, sources: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """Rows whose whole text an earlier row has: one passage each."""
    wanted = sized_broadcast(copies.select(F.col("first").alias("at")).distinct(), 16)
    sizes = _word_counts(texts.join(wanted, "at", "left_semi")).withColumnRenamed("row", "first")
    whole = copies.join(sizes, "first").where(F.col("words") >= min_words)
    zero = F.lit(0)
    return whole.join(sources.withColumnRenamed("source", "first"), "first").select(
        "doc_id", zero.alias("start"), F.col("words").alias("end"), "source_id",
        zero.alias("source_start"), F.col("words").alias("source_end"), F.col("words").alias("matches"),
    )
