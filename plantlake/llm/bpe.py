"""BPE encoding and decoding with a distinct-word table.

Texts are split into words at white space, which the encoding drops anyway, so
the ids of a text are the ids of its words in order. Words are counted over the
whole corpus; each word of the table is encoded once, and ids are joined back
to the texts by position. The table holds every word that occurs at least
twice, up to a size bound, the most frequent first; a word outside it is
encoded where it stands, which for a word that occurs once is also once.
Decoding looks every id up in the table of pieces, which the vocabulary bounds.

The vocabulary is the driver's file; its contents travel with the job, so
executors need no file of their own.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plantlake.llm.common import hands_back, small_batches, stored

#: Size of the word table that every task gets, about.
TABLE_BYTES = 64 * 1024 * 1024
#: Distinct words a task holds before it hands its counts on, and looked-up words it remembers.
COUNTED_WORDS = 100_000
CACHED_WORDS = 100_000
#: Words encoded by one call, and words of the texts that are put together at a time.
ENCODED_AT_ONCE = 2_000
GROUPED_WORDS = 50_000


def split_words(text: str) -> list[bytes]:
    """At ASCII white space: blanks, tabs, line ends, vertical tabs, form feeds."""
    return text.encode("utf-8", "surrogatepass").split()


def tokenizer(definition: str) -> Tokenizer:
    """One per task; tasks share the machine, so the library starts no threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_str(definition)


def encode_words(known: Tokenizer, words: list[bytes]) -> list[np.ndarray]:
    """Ids of each word; word by word, as a word never meets its neighbours."""
    found = []
    for at in range(0, len(words), ENCODED_AT_ONCE):
        part = [w.decode("utf-8") for w in words[at : at + ENCODED_AT_ONCE]]
        encoded = known.encode_batch_fast(part, add_special_tokens=False)
        found += [np.array(e.ids, dtype="<u4") for e in encoded]
    return found


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary), n: over all texts; counted in the task first, so frequent words cost little."""

    @hands_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(split_words(value.as_py() or ""))
                if len(seen) >= COUNTED_WORDS:
                    yield _counted(seen)
                    seen = Counter()
        if seen:
            yield _counted(seen)

    def _counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"]
        )

    words = docs.select(F.col(text)).mapInArrow(count, "word binary, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


class WordTable:
    """Words and their ids, packed: hashes in order, where each word's ids lie, all ids."""

    def __init__(self, hashes, lengths, starts, ids):
        self.hashes, self.lengths, self.starts, self.ids = hashes, lengths, starts, ids

    @classmethod
    def of(cls, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> WordTable:
        """From words in any order; ``ids`` has the ids of all, end to end."""
        order = np.argsort(hashes, kind="stable")
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        return cls(hashes[order], lengths[order], starts[order], ids.astype(np.uint16 if ids.max(initial=0) < 65536 else np.uint32))

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.hashes, self.lengths, self.starts, self.ids

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, -1 if it isn't there."""
        if not self.hashes.size:
            return np.full(hashed.size, -1)
        at = np.minimum(np.searchsorted(self.hashes, hashed), self.hashes.size - 1)
        return np.where(self.hashes[at] == hashed, at, -1)

    def ids_at(self, place: int) -> np.ndarray:
        start = self.starts[place]
        return self.ids[start : start + self.lengths[place]].astype("<u4")


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def build_table(docs: DataFrame, definition: str, limit: int = TABLE_BYTES) -> WordTable:
    """Encode each repeated word of the corpus once; the most frequent first, up to ``limit``."""
    counted = stored(word_counts(docs).where("n > 1"), "bpe-words")
    band = F.floor(F.log2("n")).cast("int")
    # a word takes 24 bytes and at most 4 for each of its bytes
    cost = F.sum(24 + 4 * F.octet_length("word"))
    bands = counted.groupBy(band.alias("band")).agg(cost.alias("bytes")).orderBy(F.desc("band"))
    room, lowest = limit, 64
    for row in bands.collect():  # one row per power of two
        room -= row["bytes"]
        if room < 0:
            break
        lowest = row["band"]

    @hands_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(definition)
        for batch in batches:
            words = batch.column(0).to_pylist()
            ids = encode_words(known, words)
            rows = (
                np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words)).tobytes(),
                np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)).tobytes(),
                np.concatenate([*ids, np.zeros(0, "<u4")]).astype("<u4").tobytes(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.binary()) for r in rows], ["hashes", "lengths", "ids"]
            )

    packed = counted.where(band >= lowest).select("word").mapInArrow(
        pack, "hashes binary, lengths binary, ids binary"
    )
    parts = stored(packed, "bpe-table").collect()  # at most ``limit`` bytes
    joined = [b"".join(bytes(r[c]) for r in parts) for c in ("hashes", "lengths", "ids")]
    table = WordTable.of(*(np.frombuffer(x, dtype=t) for x, t in zip(joined, (np.uint64, np.int32, "<u4"), strict=True)))
    if np.any(table.hashes[1:] == table.hashes[:-1]):
        raise ValueError("two words of the table share a 64-bit hash")
    return table


def _grouped(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of the texts, a bounded number of words at a time, one text at least."""
    group: list[list[bytes]] = []
    size = 0
    for text in texts:
        group.append(split_words(text.as_py() or ""))
        size += len(group[-1])
        if size >= GROUPED_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _text_of(ids: bytes, known: np.ndarray) -> str:
    """Joins ids with the pieces: known[i] is the piece of id i."""
    return " ".join(known[np.frombuffer(ids, dtype="<u4")])


class Encoder:
    """Encodes texts against a word table built from the same corpus."""

    def __init__(self, spark: SparkSession, definition: str, table: WordTable):
        self.definition = definition
        self.table = spark.sparkContext.broadcast(table.arrays)
        self.pieces = spark.sparkContext.broadcast(pieces(definition))

    def coded(self, text: Column, with_text: bool) -> Column:
        """struct of ids (consecutive little-endian unsigned 32-bit integers) and decoded.

        ``decoded`` is made from the ids, or null unless ``with_text``. One
        worker does both, so that a task needs no second one.
        """
        definition, shipped, shipped_pieces = self.definition, self.table, self.pieces

        @F.arrow_udf("struct<ids: binary, decoded: string>")
        @hands_back
        def code(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            table, known = WordTable(*shipped.value), tokenizer(definition)
            names = np.array(shipped_pieces.value, dtype=object)
            cache: dict[bytes, bytes] = {}
            for part in parts:
                ids: list[bytes] = []
                for group in _grouped(part):
                    words = {w for ws in group for w in ws}
                    if len(cache) + len(words) > CACHED_WORDS:
                        cache = {}
                    new = [w for w in words if w not in cache]
                    hashed = np.fromiter(map(word_hash, new), dtype=np.uint64, count=len(new))
                    places = table.find(hashed).tolist()
                    for word, place in zip(new, places, strict=True):
                        if place >= 0:
                            cache[word] = table.ids_at(place).tobytes()
                    alone = [w for w, place in zip(new, places, strict=True) if place < 0]
                    for word, found in zip(alone, encode_words(known, alone), strict=True):
                        cache[word] = found.tobytes()
                    ids += [b"".join(map(cache.__getitem__, ws)) for ws in group]
                texts = [_text_of(x, names) if with_text else None for x in ids]
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["ids", "decoded"]
                )

        return code(text)


def pieces(definition: str) -> list[str]:
    """Id → piece; ids are consecutive. The vocabulary file bounds it."""
    known = tokenizer(definition)
    return [known.id_to_token(i) or "" for i in range(known.get_vocab_size(with_added_tokens=True))]


def decoded(ids: Column, spark: SparkSession, definition: str) -> Column:
    """Text of packed ids: the pieces of the ids with a blank between them."""
    shipped = spark.sparkContext.broadcast(pieces(definition))

    @F.arrow_udf("string")
    @hands_back
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = np.array(shipped.value, dtype=object)
        for part in parts:
            yield pa.array([_text_of(x.as_py() or b"", known) for x in part], pa.string())

    return decode(ids)


def encode(
    docs: DataFrame, vocabulary: str, limit: int = TABLE_BYTES, with_text: bool = False
) -> DataFrame:
    """``docs`` with ``ids`` (packed, see :meth:`Encoder.coded`) and ``n_tokens``.

    ``with_text`` adds ``decoded``, what :func:`decode` would make of the ids.

    ``vocabulary`` is a tokenizers file whose encoding drops white space and
    never joins across it. A null or empty text has no ids. Special tokens
    written in a text get their ids, as the library gives them. Columns of
    these names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    encoder = Encoder(spark, definition, build_table(docs, definition, limit))
    made = F.struct(F.struct("*").alias("doc"), encoder.coded(F.col("text"), with_text).alias("coded"))
    coded = docs.select(made.alias("row")).select("row.doc", "row.coded.*")
    new = {
        "ids": F.col("ids"),
        "n_tokens": (F.octet_length("ids") / 4).cast("long"),
        **({"decoded": F.col("decoded")} if with_text else {}),
    }
    old = [F.col(f"doc.`{c}`") for c in docs.columns if c not in new]
    return coded.select(*old, *[c.alias(name) for name, c in new.items()])


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (with packed ``ids``) plus ``decoded``."""
    small_batches(encoded.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    return encoded.withColumn("decoded", decoded(F.col("ids"), encoded.sparkSession, definition))


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
