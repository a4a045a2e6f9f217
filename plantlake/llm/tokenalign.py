"""Cross-tokenizer alignment of exact-text duplicates: every distinct text is tokenised once.

Documents are shuffled by their full text and counted; each distinct text is
encoded by both tokenizers and cut into groups at the byte offsets where tokens
of both end. The token pairs that share a group are counted over the corpus, a
text's pairs weighing as much as the documents that hold it. What the counts
say of each text is joined back to the documents by the text's digest.

Counts meet texts in two ways: the most frequent pairs, a table of bounded
size, go to every task; the others meet through a shuffle. A pair left for the
shuffle is rarer than every one of the table, so no key of it is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import small_batches, stored

#: Pairs that go to every task, at most.
FREQUENT_PAIRS = 500_000
#: Token pairs of a group above which equal ids are counted instead of listed.
WIDE_GROUP = 1_024
#: Characters in a row, all or none of them white space, from which a text counts as having a long run.
LONG_RUN = 1_000
_SPACES = re.compile(rf"\s{{{LONG_RUN}}}")
#: U+2581, which stands for a space in the pieces of the second tokenizer.
SPACE_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself, the other bytes for U+0100 onwards.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """A byte-level BPE of the tokenizers library; special tokens in a text are plain text.

    Encodes with tiktoken, which finds the same ids several times faster. Texts
    with very long unbroken runs are left to the library itself.
    """

    def __init__(self, definition: str):
        import public_tokenizers
        import tiktoken

        self.definition, letters = definition, byte_letters()
        made = json.loads(definition)
        special = {t["content"] for t in made["added_tokens"]}
        ranks = {bytes(letters[x] for x in word): i for word, i in made["model"]["vocab"].items() if word not in special}
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.fast = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = None

    def ids(self, text: str) -> list[int]:
        if not has_long_run(text):
            return self.fast.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.library = Tokenizer.from_str(self.definition)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids


def has_long_run(text: str) -> bool:
    """A stretch with or without white space on which the faster encoder's time would grow with its square."""
    if len(text) < LONG_RUN:
        return False
    return max(map(len, text.split()), default=LONG_RUN) >= LONG_RUN or _SPACES.search(text) is not None


class PieceTokenizer:
    """A sentencepiece model with byte pieces; it adds a space in front by itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [self._bytes(i) for i in range(self.model.vocab_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Alignment:
    """A text's ids of both sides and the groups they fall in."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        common = np.intersect1d(ends_a, ends_b)
        self.a, self.b, self.groups = a, b, len(common)
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.n_a = np.bincount(self.group_a, minlength=len(common))
        self.n_b = np.bincount(self.group_b, minlength=len(common))

    @property
    def links(self) -> int:
        return int((self.n_a * self.n_b).sum())

    def pairs(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs as a * base + b, in order, and how often each is linked."""
        wide = self.n_a * self.n_b > WIDE_GROUP
        first_b = np.cumsum(self.n_b) - self.n_b
        listed = ~wide[self.group_a]
        a, group = self.a[listed], self.group_a[listed]
        times = self.n_b[group]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        keys = [np.repeat(a, times) * base + self.b[within + np.repeat(first_b[group], times)]]
        weights = [np.ones(len(keys[0]), dtype=np.int64)]
        for g in np.flatnonzero(wide):
            left, n_left = np.unique(self.a[self.group_a == g], return_counts=True)
            right, n_right = np.unique(self.b[self.group_b == g], return_counts=True)
            keys.append((left[:, None] * base + right).ravel())
            weights.append((n_left[:, None] * n_right).ravel())
        if len(keys) == 1:
            return np.unique(keys[0], return_counts=True)
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), dtype=np.int64)
        np.add.at(total, place, np.concatenate(weights))
        return found, total


class Aligner:
    """Both tokenizers, and how their ids are written."""

    def __init__(self, left: ByteTokenizer, right: PieceTokenizer):
        self.left, self.right = left, right
        self.base = len(right.pieces)
        self.sizes = [np.array([len(p) for p in t.pieces], dtype=np.int64) for t in (left, right)]
        # how an id is written: followed by a comma, or by what ends its side of the group
        self.names = [
            [np.array([f"{i}{end}" for i in range(len(t.pieces))], dtype=object) for end in (",", last)]
            for t, last in ((left, "|"), (right, ";"))
        ]

    @classmethod
    def of(cls, files: dict) -> Aligner:
        """From the files' contents, which keep what was made for the worker's next task."""
        if "made" not in files:
            files["made"] = cls(ByteTokenizer(files["definition"]), PieceTokenizer(files["model"]))
        return files["made"]

    def align(self, text: str) -> Alignment | None:
        """None if the pieces of either side do not make up a space and the text."""
        if not text:
            return None
        wanted = b" " + text.encode()
        sides = []
        for tokens, given, size in ((self.left, " " + text, self.sizes[0]), (self.right, text, self.sizes[1])):
            ids = tokens.ids(given)
            if b"".join(map(tokens.pieces.__getitem__, ids)) != wanted:
                return None
            ids = np.array(ids, dtype=np.int64)
            sides.append((ids, np.cumsum(size[ids])))
        (a, ends_a), (b, ends_b) = sides
        return Alignment(a, b, ends_a, ends_b)

    def written(self, found: Alignment) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        out = np.empty(len(found.a) + len(found.b), dtype=object)
        ends_a, ends_b = np.cumsum(found.n_a), np.cumsum(found.n_b)
        place_a = np.arange(len(found.a))
        place_b = np.arange(len(found.b))
        for names, ids, place, moved, ends, group in (
            (self.names[0], found.a, place_a, place_a + (ends_b - found.n_b)[found.group_a], ends_a, found.group_a),
            (self.names[1], found.b, place_b, place_b + ends_a[found.group_b], ends_b, found.group_b),
        ):
            last = place == ends[group] - 1
            out[moved] = np.where(last, names[1][ids], names[0][ids])
        return "".join(out.tolist())[:-1]


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """text, docs: each text that is neither null nor empty, and how many documents hold it."""
    held = docs.select(F.col(f"`{text}`").alias("text")).where(F.length("text") > 0)
    return held.groupBy("text").agg(F.count(F.lit(1)).alias("docs"))


def contents(definition: str, model: str) -> dict:
    """What travels to the workers: the vocabulary files themselves."""
    with open(definition, encoding="utf-8") as file, open(model, "rb") as other:
        return {"definition": file.read(), "model": other.read()}


def align_texts(texts: DataFrame, files: dict, with_groups: bool = False) -> DataFrame:
    """A row per text of :func:`distinct_texts`.

    digest (SHA-256 of the text), docs, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs and times (see :meth:`Alignment.pairs`);
    ``with_groups`` adds ``groups`` as text. A text whose tokens do not make it
    up has zeros and an empty ``groups_sha256``.
    """
    small_batches(texts.sparkSession)
    shipped = texts.sparkSession.sparkContext.broadcast(files)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    text_columns = ["groups_sha256", "groups"] if with_groups else ["groups_sha256"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(shipped.value)
        for batch in batches:
            counts, told, keys, times = [], [], [], []
            for value in batch.column("text"):
                found = aligner.align(value.as_py())
                if found is None:
                    counts.append((0, 0, 0, 0))
                    told.append(("", ""))
                    keys.append(np.zeros(0, dtype=np.int64))
                    times.append(keys[-1])
                    continue
                written = aligner.written(found)
                counts.append((len(found.a), len(found.b), found.groups, found.links))
                told.append((hashlib.sha256(written.encode()).hexdigest(), written if with_groups else ""))
                k, n = found.pairs(aligner.base)
                keys.append(k)
                times.append(n)
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate([*x, np.zeros(0, dtype=np.int64)])) for x in (keys, times)]
            columns = [batch.column("digest"), batch.column("docs")]
            columns += [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(numbers))]
            columns += [pa.array([t[i] for t in told], pa.string()) for i in range(len(text_columns))]
            yield pa.RecordBatch.from_arrays([*columns, *lists], ["digest", "docs", *numbers, *text_columns, "pairs", "times"])

    schema = "digest binary, docs long, " + "".join(f"{n} long, " for n in numbers)
    schema += "".join(f"{n} string, " for n in text_columns) + "pairs array<long>, times array<long>"
    return texts.select(text_digest("text").alias("digest"), "docs", "text").mapInArrow(align, schema)


def text_digest(text: str):
    return F.unhex(F.sha2(F.col(f"`{text}`"), 256))


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """pair, n, best: documents that hold a pair linked, and whether no pair of its left id has more."""
    counted = aligned.select("docs", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("docs").alias("n"))
    counted = stored(counted, "align-pairs")
    left = F.expr(f"pair div {base}")
    # a row per id of the left vocabulary
    top = counted.groupBy(left.alias("id")).agg(F.max("n").alias("most"))
    met = counted.withColumn("id", left).join(F.broadcast(top), "id")
    return stored(met.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-counts")


def frequent(counts: DataFrame, limit: int) -> int:
    """The least n, a power of two, above which at most ``limit`` pairs lie."""
    band = F.floor(F.log2("n")).cast("int").alias("band")
    lowest = 62
    for row in counts.groupBy(band).count().orderBy(F.desc("band")).collect():  # one row per power of two
        limit -= row["count"]
        if limit < 0:
            break
        lowest = row["band"]
    return 2**lowest


def link_measures(aligned: DataFrame, counts: DataFrame, limit: int = FREQUENT_PAIRS) -> DataFrame:
    """digest, n_best, count_sum of every text that has links."""
    links = aligned.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("digest", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    least = frequent(counts, limit)
    often = F.broadcast(counts.where(F.col("n") >= least))  # at most ``limit`` rows
    rest = counts.where(F.col("n") < least)
    told = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    ]
    parts = links.join(often, "pair").groupBy("digest").agg(*told)
    if not rest.isEmpty():
        seldom = links.join(often, "pair", "left_anti").hint("merge").join(rest.hint("merge"), "pair")
        parts = parts.unionByName(seldom.groupBy("digest").agg(*told))
    return parts.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, definition: str, model: str, limit: int = FREQUENT_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``definition`` is a byte-level tokenizers file (side a, which encodes a
    space and the text), ``model`` a sentencepiece file (side b). Null and
    empty texts, and texts that either side does not give back byte by byte,
    have zeros and ''. Rows that repeat an id, or have none, are documents of
    their own. An empty table gives no rows. Other columns are ignored.
    """
    files = contents(definition, model)
    aligned = stored(align_texts(distinct_texts(docs), files), "aligned")
    base = len(PieceTokenizer(files["model"]).pieces)
    measures = link_measures(aligned, pair_counts(aligned, base), limit)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = aligned.drop("pairs", "times", "docs").join(measures.hint("merge"), "digest", "left")
    # written first: a join of two plain tables can be split where a text is hot
    texts = stored(texts, "align-texts")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest("text").alias("digest"))
    told = rows.hint("merge").join(texts.hint("merge"), "digest", "left")
    return told.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
