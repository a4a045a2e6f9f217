"""Substring dedup: planted passages, fuzzy ones, hot ones, edge rows."""

import random

import numpy as np

from plantlake.llm.chaining import DROP, GAP_COST, MATCH, MISS, _extent, _matched, chains, passages
from plantlake.llm.queries import QUERIES
from plantlake.llm.shingles import Shingler
from plantlake.llm.substrings import (
    SEED, WINDOW, _chained, leftmost_minima, minimizers, repeated_passages, runs_of, seeds_of, stretch_hashes,
)

from .conftest import prose
from .test_jaccard import edited


def found(docs):
    return sorted(map(tuple, repeated_passages(docs).collect()), key=str)


def test_any_run_of_words_has_a_seed():
    rng = np.random.default_rng(1)
    run = rng.integers(0, 2**64, SEED + WINDOW - 1 - SEED + 1, dtype=np.uint64)
    for _ in range(200):
        a, b = (rng.integers(0, 2**64, rng.integers(0, 30), dtype=np.uint64) for _ in range(2))
        at = minimizers(np.concatenate([a, run, b])) - a.size
        assert ((at >= 0) & (at < run.size)).any()


def best_chain_score(x, y, weight):
    """By the plain quadratic recurrence."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    score = np.zeros(x.size)
    for i in range(x.size):
        ok = [score[j] - GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        score[i] = weight + max([0, *ok])
    return score.max()


def test_chains_equal_the_quadratic_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(100):
        n = int(rng.integers(1, 40))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        got = chains(x, y, 8)
        assert sorted(np.concatenate(got).tolist()) == list(range(n))
        first = got[0]
        assert (np.diff(x[first]) > 0).all() and (np.diff(y[first]) > 0).all()
        gaps = np.diff(x[first]).sum() + np.diff(y[first]).sum()
        assert abs(8 * first.size - GAP_COST * gaps - best_chain_score(x, y, 8)) < 1e-9


def test_planted_passages_are_found_where_they_are(spark, documents):
    passage = prose(9, 60)
    docs = documents(
        (1, f"{prose(1, 70)} {passage} {prose(2, 20)}"), (2, prose(3, 200)), (3, f"{passage} {prose(4, 90)}"),
        (4, f"{prose(5, 300)} {passage.upper()}"), (5, prose(6, 400)),
    )
    assert found(docs) == [(3, 0, 60, 1, 70, 130, 60), (4, 300, 360, 1, 70, 130, 60)]


def test_short_overlaps_are_left_alone(spark, documents):
    passage = prose(9, 45)
    assert found(documents((1, f"{prose(1, 70)} {passage}"), (2, f"{prose(2, 70)} {passage}"))) == []


def test_fuzzy_passages(spark, documents):
    text, rows = prose(7, 150), []
    for k in range(12):
        words = edited(text, 0.06, k).split()
        del words[40 + k : 42 + k]
        words[90 + k : 90 + k] = ["more", "words"]
        rows.append((k, f"{prose(100 + k, 60)} {' '.join(words)} {prose(200 + k, 60)}"))
    got = found(documents((99, f"{prose(300, 40)} {text}"), *rows))
    for k in range(12):
        mine = [r for r in got if r[0] == k]
        assert mine and max(r[2] for r in mine) - min(r[1] for r in mine) >= 90, (k, mine)
        assert all(r[6] >= 0.8 * (r[2] - r[1]) for r in mine)


def test_brute_force_over_exact_passages(spark, documents):
    """Every run of 60 shared words is covered, and nothing is reported without one of 50."""
    rng, pool = random.Random(4), [prose(1000 + k, 60) for k in range(8)]
    rows = []
    for k in range(60):
        parts = [prose(2000 + 10 * k + i, rng.randrange(5, 60)) for i in range(3)]
        parts += rng.sample(pool, rng.randrange(0, 3))
        rng.shuffle(parts)
        rows.append((k, " ".join(parts)))
    covered = {k: set() for k, _ in rows}
    for doc, start, end, *_ in found(documents(*rows)):
        covered[doc] |= set(range(start, end))
    seen, loose = set(), 8  # words at a passage's ends may match by chance
    for k, text in rows:
        words, expected = text.split(), set()
        for i in range(len(words) - 59):
            run = " ".join(words[i : i + 60])
            if run in pool:
                if run in seen:
                    expected |= set(range(i, i + 60))
                seen.add(run)
        assert expected <= covered[k]
        assert len(covered[k] - expected) <= loose * 4


def test_a_passage_in_very_many_documents_is_linear(spark, documents):
    passage = prose(9, 60)
    got = found(documents(*[(k, f"{prose(10 + k, 30)} {passage}") for k in range(300)]))
    assert len(got) == 299 and {r[3] for r in got} == {0}


def test_copies_and_odd_rows(spark, documents):
    text = prose(1, 80)
    docs = documents(
        (5, text), (6, text), (6, text), (7, text + " end"), (None, text), (8, None), (9, ""), (10, ""),
        (11, "short"), (12, "short"), (13, "a " * 5000), (14, f"{prose(2, 60)} {'a ' * 5000}"),
    )
    got = found(docs)
    whole = [r for r in got if r[0] in (6, None)]
    assert len(whole) == 3 and {r[1:] for r in whole} == {(0, 80, 5, 0, 80, 80)}
    assert (7, 0, 80, 5, 0, 80, 80) in got
    assert not [r for r in got if r[0] in (5, 8, 9, 10, 11, 12, 13)]
    assert found(docs.where("false")) == []


def test_a_chain_is_cut_where_texts_differ():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 2**64, 400, dtype=np.uint64) for _ in range(2))
    b[:100], b[250:350] = a[:100], a[250:350]
    x = np.array([0, 20, 50, 80, 92, 250, 270, 300, 342])
    assert passages(a, b, x, x, 8, 50, 0.8) == [(0, 100, 0, 100, 100), (250, 350, 250, 350, 100)]


def test_the_query_names_repeats(spark, sf_dir):
    out = QUERIES["op7_substring_dedup"](spark, sf_dir)
    assert out.where("end - start < 50 or doc_id = source_id").isEmpty() and not out.isEmpty()


def test_a_passage_whose_first_holders_hold_parts_of_it(spark, documents):
    passage = prose(9, 60).split()
    first, second, whole = " ".join(passage[:30]), " ".join(passage[30:]), " ".join(passage)
    docs = documents(
        (1, f"{prose(1, 40)} {first} {prose(2, 40)}"), (2, f"{prose(3, 40)} {second} {prose(4, 40)}"),
        (3, f"{prose(5, 70)} {whole} {prose(6, 20)}"), (4, f"{prose(7, 10)} {whole} {prose(8, 30)}"),
        (5, f"{second} {first} {prose(10, 30)} {whole}"),
    )
    assert found(docs) == [(4, 10, 70, 3, 70, 130, 60), (5, 90, 150, 3, 70, 130, 60)]


def test_a_document_that_repeats_a_passage(spark, documents):
    passage = prose(9, 60)
    docs = documents(
        (1, f"{prose(1, 70)} {passage} {prose(2, 20)}"),
        (2, f"{passage} {prose(3, 40)} {passage} {prose(4, 40)} {passage}"),
        (3, "a " * 5000), (4, f"{prose(5, 60)} {'a ' * 3000}"), (5, f"{'b c ' * 100}"), (6, f"x {'b c ' * 90} y"),
    )
    assert found(docs) == [
        (2, 0, 60, 1, 70, 130, 60), (2, 100, 160, 1, 70, 130, 60), (2, 200, 260, 1, 70, 130, 60),
        (4, 60, 3060, 3, 0, 3000, 3000), (6, 1, 181, 5, 0, 180, 180),
    ]


def test_a_single_seed_is_enough(spark, documents):
    """Every seventh word differs from the source, but for one stretch."""
    words = prose(9, 66).split()
    other = [f"x{i}" if i % 7 == 6 and not 21 <= i < 37 else w for i, w in enumerate(words)]
    got = found(documents((1, " ".join(words)), (2, f"{prose(1, 30)} {' '.join(other)} {prose(2, 30)}")))
    assert len(got) == 1 and got[0][0] == 2 and got[0][2] - got[0][1] >= 60


def test_equal_runs_of_seeds_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 2**64, 90, dtype=np.uint64)
    seen, hashes = {}, []
    for size in (0, 3, 40, 333):
        grams = np.concatenate([rng.integers(0, 2**64, size, dtype=np.uint64), shared])
        at = minimizers(grams)
        runs = runs_of(grams, at, 50)
        last = np.searchsorted(at, at + 24)
        for i in np.flatnonzero(runs).tolist():
            hashes.append((grams[at[i : last[i] + 1]].tobytes(), int(runs[i])))
    for seeds, run in hashes:
        assert seen.setdefault(seeds, run) == run
    assert len(hashes) > len(seen) and len(set(seen.values())) == len(seen)


def test_minima_of_windows_are_the_leftmost():
    rng = np.random.default_rng(6)
    for _ in range(200):
        width, values = int(rng.integers(1, 12)), rng.integers(0, 6, int(rng.integers(12, 60))).astype(np.uint64)
        view = np.lib.stride_tricks.sliding_window_view(values, width)
        assert (leftmost_minima(values, width) == view.argmin(axis=1) + np.arange(view.shape[0])).all()


def test_equal_stretches_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 3, 4000).astype(np.uint64)
    hashes = stretch_hashes(words, np.arange(words.size - 5), 6)
    seen = {}
    for i, found in enumerate(hashes.tolist()):
        assert seen.setdefault(words[i : i + 6].tobytes(), found) == found
    assert len(set(seen.values())) == len(seen) < hashes.size


def test_seeds_of_many_texts_are_those_of_each():
    rng, shingler = np.random.default_rng(8), Shingler(SEED)
    sizes = [0, 0, 7, 8, 9, 17, 18, 60, 400, 0, 1, 300, 90, 5]
    texts = [rng.integers(0, 2 if k % 3 else 2**63, size).astype(np.uint64) for k, size in enumerate(sizes)]
    expected = []
    for k, words in enumerate(texts):
        grams = shingler.grams(words) if words.size >= SEED else words[:0]
        at = minimizers(grams)
        own, run, last = grams[at].tolist(), runs_of(grams, at, 50).tolist(), None
        for i, place in enumerate(at.tolist()):
            if (own[i], run[i]) != last or place - at[i - 1] > SEED:
                expected.append((k, place, own[i], run[i]))
            last = own[i], run[i]
    got = list(zip(*(column.tolist() for column in seeds_of(shingler, texts, 50)), strict=True))
    assert got == expected and len({k for k, *_ in got}) == 8
    assert [column.size for column in seeds_of(shingler, texts[:3], 50)] == [0] * 4


def test_the_chains_of_two_rows_meet_their_texts_once(spark):
    """Two long chains and three short ones are two rows, not five."""
    places = [(0, 0), (10, 10), (500, 300), (520, 320), (1000, 100), (2000, 50), (3000, 20)]
    matches = spark.createDataFrame(
        [(2, 1, *p) for p in places] + [(3, 1, 5, 9)], "row long, source long, pos int, source_pos int"
    )
    got = sorted(map(tuple, _chained(matches).collect()))
    assert [r[:3] for r in got] == [(2, 1, False), (2, 1, True), (3, 1, False)]
    assert got[1][5] == [2, 2] and sorted(got[1][3]) == [0, 10, 500, 520] and got[0][5] == [1, 1, 1]
    assert got[2][3:] == ([5], [9], [1])


def test_alignment_equals_the_plain_recurrences():
    rng = np.random.default_rng(9)
    for k in range(400):
        a, b = (rng.integers(0, 1 + k % 9, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
        same = min(a.size, b.size) // (1 + k % 3)
        a[:same] = b[:same]
        a, b = (a[::-1], b[::-1]) if k % 2 else (a, b)
        best = np.zeros((a.size + 1, b.size + 1), dtype=int)
        for i, j in np.ndindex(a.size, b.size):
            best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert _matched(a, b) == best[-1, -1]
        a, b = np.tile(a, 9), np.tile(b, 9)
        total = peak = reached = 0
        for i in range(min(a.size, b.size)):
            total += MATCH if a[i] == b[i] else MISS
            if total > peak:
                peak, reached = total, i + 1
            elif peak - total > DROP:
                break
        assert _extent(a, b) == reached
