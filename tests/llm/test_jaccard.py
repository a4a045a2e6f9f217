"""Near duplicates: equal to brute force, hot groups, edge rows."""

import itertools
import random

import pytest

from plantlake.llm import jaccard
from plantlake.llm.components import components
from plantlake.llm.jaccard import deduplicate, near_duplicates

from .conftest import prose


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_force(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(j)] = find(i)
    found = []
    for i, (k, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if find(j) == find(i)]
        named = [x for x in ids if x is not None]
        found.append((k, len(s), min(named) if named else None))
    return sorted(found, key=str)


def got(df):
    return sorted(map(tuple, near_duplicates(df).collect()), key=str)


def edited(text, share, seed):
    rng, words = random.Random(seed), text.split()
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_random_edits_equal_brute_force(spark, documents):
    rows = []
    for base in range(12):
        text = prose(base, 40 + 30 * base)
        rows += [(len(rows) + k, edited(text, 0.005 * k, 100 * base + k)) for k in range(12)]
    random.Random(1).shuffle(rows)
    assert got(documents(*rows)) == brute_force(rows)


def test_chains_and_shared_passages(spark, documents):
    """A drifting chain links end to end; documents that share a passage don't link."""
    words = prose(1, 120).split()
    rows = []
    for k in range(30):
        words[4 * k : 4 * k + 2] = [f"x{k}", f"y{k}"]
        rows.append((k, " ".join(words)))
    passage = prose(2, 60)
    rows += [(100 + k, f"{prose(50 + k, 50)} {passage} {prose(90 + k, 50)}") for k in range(60)]
    rows += [(200 + k, f"{passage} {prose(300 + k, 3)}") for k in range(20)]
    assert got(documents(*rows)) == brute_force(rows)


@pytest.mark.parametrize("meetings", [10**9, 0])
def test_leader_rounds(spark, documents, monkeypatch, meetings):
    monkeypatch.setattr(jaccard, "MEETINGS_PER_CELL", meetings)
    text = prose(3, 100)
    rows = [(k, edited(text, 0.01 * (k % 4), k)) for k in range(25)]
    assert got(documents(*rows)) == brute_force(rows)


def test_with_ranked_columns(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    text = prose(4, 60)
    rows = [(k, f"{edited(text, 0.02, k)} {prose(k, 5 * (k % 9))}") for k in range(60)]
    assert got(documents(*rows)) == brute_force(rows)


@pytest.mark.parametrize("other", ["A b C d e", "a b\tc\nd  e", "a b c d e f", "a b c d", ""])
def test_short_texts(spark, documents, other):
    rows = [(1, "a b c d e"), (2, other), (None, "a b c d"), (4, None), (5, " \n")]
    assert got(documents(*rows)) == brute_force(rows)


def test_exactly_at_the_threshold(spark, documents):
    words = [f"w{k}" for k in range(13)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words[:-2])), (4, " ".join(words[1:-1]))]
    assert got(documents(*rows)) == brute_force(rows)


def test_repeated_rows_and_ids(spark, documents):
    rows = [(1, prose(1, 30)), (1, prose(1, 30)), (1, prose(2, 30)), (2, prose(2, 30)), (None, prose(3, 30))]
    assert got(documents(*rows)) == brute_force(rows)
    left = deduplicate(documents(*rows))
    assert sorted(r.text for r in left.collect()) == sorted({t for _, t in rows})


def test_one_of_each_component_stays(spark, documents):
    text = prose(5, 80)
    rows = [(k, edited(text, 0.01, k)) for k in range(10, 20)] + [(1, None), (2, ""), (3, prose(6, 9))]
    out = deduplicate(documents(*rows))
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 10]
    assert {r.digest for r in out.collect()} == {"own digest"} and "component_id" not in out.columns


def test_empty_table(spark, documents):
    empty = documents((1, "a")).where("false")
    assert got(empty) == [] and deduplicate(empty).collect() == []


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 90 + k) for k in range(9)] + [(7, 7), (500, 500)]
    table = spark.createDataFrame(links + [(b, a) for a, b in links[:5]], "a long, b long")
    found = {r.id: r.component for r in components(table).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 90 for k in [*range(90, 99), 100]}, 500: 500}
    assert components(table.where("false")).collect() == []


def test_hot_columns_meet_leaders_though_most_columns_are_small(spark, documents, monkeypatch):
    """A large group beside many pairs: its classes are connected by leaders and don't all meet."""
    met = []
    plain = jaccard._all_pairs
    monkeypatch.setattr(jaccard, "_all_pairs", lambda *a: met.append(plain(*a).count()) or plain(*a))
    text = prose(7, 90)
    rows = [(k, edited(text, 0.012 * (k % 2), k) + f" end{k}") for k in range(150)]
    rows += [(1000 + k, f"{prose(100 + k // 2, 40)} x{k}") for k in range(300)]
    assert got(documents(*rows)) == brute_force(rows)
    assert met[0] < 1500
