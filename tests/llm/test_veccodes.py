"""Vector codes: equal to plain Python integers, exact dot products, odd rows."""

import hashlib
import math

import numpy as np
import pytest

from plantlake.llm import veccodes

ROWS = "vec_id long, embedding array<float>, label int, code string, ints string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "own", "own") for i, v, label in rows], ROWS)


def brute(rows, parts=4, entries=256, rounds=4):
    """By the book, in Python's integers; rows are (id, vector, label) in any order."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    cut = lambda v, p: v[dim * p // parts : dim * (p + 1) // parts]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        for p, book in enumerate(books):
            held = {}
            for _, v, _ in kept:
                held.setdefault(near(cut(v, p), book)[0], []).append(cut(v, p))
            for e, xs in held.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    coded = []
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for e, _ in found), sum(g for _, g in found), label))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return coded, hashlib.sha256(flat.encode()).hexdigest()


def random_rows(n, dim=16, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i) * 3, rng.normal(0, spread, dim).astype(np.float32).tolist(), int(i % 3)) for i in range(n)]


def check(spark, rows, **sizes):
    coded, books = veccodes.compress(table(spark, rows))
    want, digest = brute(rows)
    assert sorted(map(str, [(r.vec_id, r.code, r.error, r.label) for r in coded.collect()])) == sorted(map(str, want))
    assert books.sha256() == digest
    return coded, books


def test_equals_brute_force(spark):
    check(spark, random_rows(700))


def test_odd_rows(spark):
    rows = random_rows(40)
    rows += [
        (1, None, 0), (2, [0.0] * 16, None), (4, [None] + [1.0] * 15, 0), (5, [float("nan")] * 16, 1),
        (7, [float("inf")] + [0.0] * 15, 1), (8, [-0.0004] * 16, None), (None, [0.5] * 16, 2), (3, [0.25] * 16, 2),
        (0, [0.75] * 16, 2), (0, rows[0][1], 0),
    ]
    coded, _ = check(spark, rows)
    told = veccodes.with_label_error(coded).collect()
    for label in (None, 0, 1, 2):
        errors = [r.error for r in told if r.label == label]
        assert {r.label_error for r in told if r.label == label} == {sum(errors)}


def test_copies_of_one_vector_and_ties(spark):
    rows = [(i, [0.5] * 8, 1) for i in range(300)] + [(1000 + i, [0.5, 0.25] * 4, 1) for i in range(3)]
    check(spark, rows)


def test_lengths(spark):
    """Vectors of another length take no part; parts may differ by one component."""
    rows = random_rows(20, dim=6)
    coded, books = veccodes.compress(table(spark, [*rows, (900, [1.0] * 5, 0), (901, [], 0)]))
    assert sorted(r.vec_id for r in coded.collect()) == sorted(r[0] for r in rows)
    assert [b.shape[1] for b in books.books] == [1, 2, 1, 2]
    assert books.sha256() == brute(rows)[1]


def test_too_large_components(spark):
    rows = random_rows(5, dim=4)
    coded, books = veccodes.compress(table(spark, [*rows, (900, [3e38] * 4, 7)]))
    got = {r.vec_id: (r.code, r.error) for r in veccodes.with_label_error(coded).collect()}
    assert got.pop(900) == (None, None) and len(got) == 5
    assert books.sha256() == brute(rows)[1]
    alone, none = veccodes.compress(table(spark, [(900, [3e38] * 4, 7)]))
    assert none is None and [r.code for r in alone.collect()] == [None]


def test_empty_table(spark):
    coded, books = veccodes.compress(table(spark, []))
    assert books is None and veccodes.with_label_error(coded).collect() == []


def test_decode_stands_within_the_error(spark):
    rows = random_rows(300)
    coded, books = veccodes.compress(table(spark, rows))
    ints = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows}
    for r in coded.collect():
        assert int(((books.decode(r.code) - ints[r.vec_id]) ** 2).sum()) == r.error


@pytest.mark.parametrize("width, largest", [(1, 1), (16, 5000), (16, 2**27), (192, 2**25), (3, 2**29)])
def test_dot_products_are_exact(width, largest):
    rng = np.random.default_rng(width)
    x = rng.integers(-largest, largest, (50, width), endpoint=True)
    c = rng.integers(-largest, largest, (20, width), endpoint=True)
    c[0], x[0] = largest, -largest
    want = [[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in c] for u in x]
    assert veccodes.dot_products(x, c).tolist() == want
    bits, count = veccodes.limb_plan(width, largest)
    assert width * (2**bits) ** 2 <= 2**53 and bits * count > largest.bit_length()


def test_more_than_256_entries(spark):
    rows = table(spark, random_rows(400, dim=4))
    ints = veccodes.integer_rows(rows, "embedding", ["vec_id"])
    books = veccodes.fit(ints, ["vec_id"], parts=2, entries=300, rounds=1)
    assert books.digits == 3
    assert all(len(r.code) == 6 for r in veccodes.encode(ints, books).collect())
