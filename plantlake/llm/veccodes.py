"""Vector code compression: integer codebooks per part, exact distances from limb-split GEMM.

Vectors become integers and are cut into parts; each part has a codebook of
integer entries, improved by rounds of assign and floored mean. Distances are
|x|² - 2 x·c + |c|², with the dot products from float64 matrix products of
limbs: an integer is cut into limbs so short that no sum of their products
reaches 2^53, so every float64 result is exact; the parts are put together in
int64. So a rerun, another partitioning and another BLAS give the same codes.

A round is one pass over the stored rows. A task sends one row per used entry,
so what is shuffled and collected depends on the codebooks, not on the table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import sized_broadcast, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows whose distances are held at once.
BLOCK_ROWS = 4_096


def limbs_of(values: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """``values`` as float64 limbs, the lowest first: all but the last are unsigned ``bits`` wide."""
    low = (1 << bits) - 1
    cut = [(values >> (bits * i)) & low for i in range(count - 1)] + [values >> (bits * (count - 1))]
    return [c.astype(np.float64) for c in cut]


def limb_plan(width: int, largest: int) -> tuple[int, int]:
    """Bits of a limb and limbs of a number, for dot products of ``width`` numbers up to ``largest``.

    ``width`` products of two limbs stay below 2^53.
    """
    bits = (53 - max(1, width).bit_length()) // 2
    return bits, max(1, math.ceil((largest.bit_length() + 1) / bits))


def dot_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x · cᵀ of int64 matrices, exactly, if the results fit an int64."""
    largest = max((int(np.abs(m).max(initial=0)) for m in (x, c)), default=0)
    bits, count = limb_plan(x.shape[1], largest)
    right = limbs_of(c, bits, count)
    total = np.zeros((x.shape[0], c.shape[0]), dtype=np.int64)
    for i, left in enumerate(limbs_of(x, bits, count)):
        for j, other in enumerate(right):
            total += (left @ other.T).astype(np.int64) << (bits * (i + j))
    return total


def assigned(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (the first of equally near ones) and the squared distance."""
    near = (entries * entries).sum(axis=1)[None, :] - 2 * dot_products(x, entries)
    best = near.argmin(axis=1)
    return best, near[np.arange(len(x)), best] + (x * x).sum(axis=1)


def largest_component(dim: int) -> int:
    """The largest magnitude at which a whole vector's squared distance fits an int64."""
    return math.isqrt((2**63 - 1) // (4 * max(1, dim)))


@dataclass(frozen=True)
class Codebooks:
    """Per part an int64 matrix, an entry a row."""

    books: tuple[np.ndarray, ...]

    @property
    def cuts(self) -> list[int]:
        """Where the parts begin, and the end."""
        return [0, *np.cumsum([b.shape[1] for b in self.books]).tolist()]

    @property
    def digits(self) -> int:
        """Hex digits of an index, two at least."""
        return max(2, math.ceil((len(self.books[0]) - 1).bit_length() / 4))

    def sha256(self) -> str:
        """Of all components in decimal, comma-joined, by part, entry and position."""
        flat = ",".join(str(v) for book in self.books for v in book.ravel().tolist())
        return hashlib.sha256(flat.encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The vector, in integers, that a code stands for."""
        at = [int(code[i : i + self.digits], 16) for i in range(0, len(code), self.digits)]
        return np.concatenate([book[i] for book, i in zip(self.books, at, strict=True)])


def finite_vector(vector: Column) -> Column:
    """Not null, without null and non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integer_rows(vectors: DataFrame, vector: str, carry: list[str], scale: int = SCALE) -> DataFrame:
    """``carry`` and ``ints``, the floored scaled vector, of all usable rows; stored.

    Left out are null vectors and those with null or non-finite components,
    and vectors that are not of the commonest length (of equally common ones
    the shortest counts).
    """
    doubles = F.col(f"`{vector}`").cast("array<double>")
    ints = F.transform(doubles, lambda x: F.floor(x * scale).cast("long"))
    rows = vectors.where(finite_vector(doubles)).select(*[F.col(f"`{c}`") for c in carry], ints.alias("ints"))
    rows = stored(rows, "code-rows")
    sizes = rows.groupBy(F.size("ints").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("ints") == (common["size"] if common else 0))


def in_range(rows: DataFrame, dim: int) -> Column:
    """Whether the components are small enough for distances to be exact."""
    bound = largest_component(dim)
    return F.forall("ints", lambda x: x.between(-bound, bound))


def _blocks(column: pa.ListArray, dim: int) -> Iterator[np.ndarray]:
    """int64 matrices of at most BLOCK_ROWS rows."""
    for at in range(0, len(column), BLOCK_ROWS):
        part = column.slice(at, BLOCK_ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), dim)


def fit(rows: DataFrame, order: list[str], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``rows`` (with ``ints``), or None without rows.

    They start as the parts of the first ``entries`` rows by ``order`` (nulls
    last, ties by the components); with fewer rows they are shorter. An entry
    that no row is nearest to stays as it is. Parts differ by one component in
    width where the length cannot be divided.
    """
    by = [F.asc_nulls_last(f"`{c}`") for c in order]
    first = rows.orderBy(*by, "ints").select("ints").limit(entries).collect()
    if not first:
        return None
    start = np.array([r["ints"] for r in first], dtype=np.int64).reshape(len(first), -1)
    dim = start.shape[1]
    cuts = [dim * p // parts for p in range(parts + 1)]
    books = [start[:, a:b].copy() for a, b in zip(cuts, cuts[1:])]
    for _ in range(rounds):
        _improve(rows, books, cuts)
    return Codebooks(tuple(books))


def _improve(rows: DataFrame, books: list[np.ndarray], cuts: list[int]) -> None:
    """One round: every entry becomes the floored mean of the parts nearest to it."""
    held, dim, width = [b.copy() for b in books], cuts[-1], max(b.shape[1] for b in books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), width), dtype=np.int64) for b in held]
        counts = [np.zeros(len(b), dtype=np.int64) for b in held]
        for batch in batches:
            for block in _blocks(batch.column(0), dim):
                for p, book in enumerate(held):
                    x = block[:, cuts[p] : cuts[p + 1]]
                    best, _ = assigned(x, book)
                    np.add.at(totals[p], (best[:, None], np.arange(x.shape[1])[None, :]), x)
                    counts[p] += np.bincount(best, minlength=len(book))
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), p, dtype=np.int32)), pa.array(used.astype(np.int32)),
                    pa.array(n[used]), pa.array(totals[p][used].tolist(), pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "total"],
            )

    sent = rows.select("ints").mapInArrow(sums, "part int, entry int, n long, total array<long>")
    each = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    merged = sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)
    for row in merged.collect():  # one row per used entry
        size = books[row["part"]].shape[1]
        books[row["part"]][row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(size)]


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with ``code`` and ``error`` in place of ``ints``.

    ``code`` has the index of each part's nearest entry in hex, ``error`` the
    squared distances summed over the parts.
    """
    held, cuts, digits = books.books, books.cuts, books.digits
    keep = [c for c in rows.columns if c != "ints"]
    schema = rows.select(*[F.col(f"`{c}`") for c in keep]).schema.add("code", "string").add("error", "long")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([format(i, f"0{digits}x") for i in range(len(held[0]))], dtype=object)
        for batch in batches:
            codes, errors = [], []
            for block in _blocks(batch.column("ints"), cuts[-1]):
                text, error = np.full(len(block), "", dtype=object), np.zeros(len(block), dtype=np.int64)
                for p, book in enumerate(held):
                    best, gap = assigned(block[:, cuts[p] : cuts[p + 1]], book)
                    text, error = text + names[best], error + gap
                codes.append(pa.array(text, pa.string()))
                errors.append(pa.array(error))
            old = [batch.column(c) for c in keep]
            new = [pa.chunked_array(codes, pa.string()).combine_chunks(), pa.chunked_array(errors, pa.int64()).combine_chunks()]
            yield pa.RecordBatch.from_arrays([*old, *new], [*keep, "code", "error"])

    return rows.mapInArrow(code, schema)


def compress(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """Rows of vec_id, label, code, error for all usable vectors, and the codebooks.

    What is left out, see :func:`integer_rows`. Components too large for exact
    64-bit distances (beyond 185,000 for 64 dimensions) take no part in the
    codebooks; those rows have a null code and a null error. Null and repeated
    ids and equal vectors are rows like others; other columns are ignored. An
    empty table gives no rows and no codebooks.
    """
    named = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector")
    )
    rows = integer_rows(named, "vector", ["vec_id", "label"])
    one = rows.select(F.size("ints").alias("dim")).first()
    fits = in_range(rows, one["dim"] if one else 0)
    books = fit(rows.where(fits), ["vec_id"])
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    too_large = rows.where(~fits).select("vec_id", "label", *none)
    coded = encode(rows.where(fits), books).unionByName(too_large) if books else too_large
    return stored(coded, "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: ``error`` summed over the rows of equal ``label``, nulls together.

    Null where the sum doesn't fit a long. Summed per label before anything is
    joined; the sums are broadcast only if they are counted small.
    """
    sums = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "code-labels")
    sums = sums.withColumnRenamed("label", "of")
    return coded.join(sized_broadcast(sums, row_bytes=64), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
