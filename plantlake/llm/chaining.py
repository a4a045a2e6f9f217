"""Collinear chains of shared seeds, and their alignment into passages."""

from __future__ import annotations

import numpy as np

#: Cost of a word skipped on either side between two seeds of a chain.
GAP_COST = 0.05
#: Alignment score of a word that matches, and of one that doesn't; a passage ends where
#: the score has fallen this far below its peak.
MATCH, MISS, DROP = 1.0, -2.0, 16.0
#: Words looked at in one step when a passage is extended.
STEP = 128
#: Gaps up to so many words on each side are aligned word by word; larger ones count as missed.
ALIGNED_GAP = 256


class PrefixMax:
    """A Fenwick tree of (value, item) with prefix maxima."""

    def __init__(self, size: int):
        self.best = [(-1.0, -1)] * (size + 1)

    def raise_to(self, at: int, value: float, item: int) -> None:
        at += 1
        while at < len(self.best):
            if self.best[at][0] < value:
                self.best[at] = (value, item)
            at += at & -at

    def up_to(self, at: int) -> tuple[float, int]:
        """The maximum over places 0..at-1."""
        found = (-1.0, -1)
        while at > 0:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def chains(x: np.ndarray, y: np.ndarray, weight: int) -> list[np.ndarray]:
    """Disjoint chains over matches (x[i], y[i]), the best first.

    A chain climbs in both coordinates. Its score is ``weight`` for every seed
    less the gap cost of what lies between; the best predecessor of a seed is a
    prefix maximum over y, as seeds are met in order of x.
    """
    if x.size == 1:
        return [np.zeros(1, dtype=np.int64)]
    order = np.lexsort((y, x))
    xs, ys = x[order].tolist(), y[order].tolist()
    ranks = np.unique(y, return_inverse=True)[1][order].tolist()
    n = len(xs)
    tree, score, before = PrefixMax(n), [0.0] * n, [-1] * n
    offset = GAP_COST * (max(xs) + max(ys) + 2)  # keeps the tree's values positive
    waiting: list[int] = []
    for i in range(n):
        # seeds with this x can't precede each other
        if waiting and xs[waiting[0]] != xs[i]:
            for j in waiting:
                tree.raise_to(ranks[j], offset + score[j] + GAP_COST * (xs[j] + ys[j]), j)
            waiting = []
        value, j = tree.up_to(ranks[i])
        gain = value - offset - GAP_COST * (xs[i] + ys[i]) if j >= 0 else 0.0
        score[i] = weight + max(0.0, gain)
        before[i] = j if gain > 0 else -1
        waiting.append(i)
    used = [False] * n
    found = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            found.append(order[chain[::-1]])
    return found


def _matched(a: np.ndarray, b: np.ndarray) -> int:
    """Words of a and b that match in order (longest common subsequence)."""
    if not a.size or not b.size:
        return 0
    if a.size == b.size and np.array_equal(a, b):
        return a.size
    if max(a.size, b.size) > ALIGNED_GAP:
        return 0
    # equal words at either end belong to some longest one
    head = _equal_words(a, b)
    a, b = a[head:], b[head:]
    tail = _equal_words(a[::-1], b[::-1])
    a, b = a[: a.size - tail], b[: b.size - tail]
    if a.size > b.size:
        a, b = b, a
    row = np.zeros(b.size + 1, dtype=np.int32)
    for word in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)))
    return head + tail + int(row[-1])


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many words a and b have alike from the start on."""
    room = min(a.size, b.size)
    differ = a[:room] != b[:room]
    first = int(differ.argmax()) if room else 0
    return first if room and differ[first] else room


def _extent(a: np.ndarray, b: np.ndarray) -> int:
    """How many words to add, going on word by word until the score falls too far."""
    room, peak, total, at = min(a.size, b.size), 0.0, 0.0, 0
    best = 0
    while at < room:
        stop = min(room, at + STEP)
        run = (a[at:stop] == b[at:stop]) * (MATCH - MISS)
        run += MISS
        run[0] += total
        run = run.cumsum()
        fallen = np.maximum(np.maximum.accumulate(run), peak) - run > DROP
        end = int(fallen.argmax())
        ended = bool(fallen[end])
        high = int((run[:end] if ended else run).argmax()) if end or not ended else 0
        if (end or not ended) and run[high] > peak:
            peak, best = float(run[high]), at + high + 1
        if ended:
            break
        total, at = float(run[-1]), at + run.size
    return best


def passages(
    a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, width: int,
    min_words: int, min_identity: float,
) -> list[tuple[int, int, int, int, int]]:
    """(start, end, other start, other end, matches) of the passages along one chain.

    Between seeds the texts are aligned, at both ends the passage is extended;
    where the score drops too far the chain is cut. What is left must be long
    enough on both sides and match enough.
    """
    found = []
    i, n = 0, x.size
    while i < n:
        # blocks are seeds joined by aligned gaps; keep the peak of the running score
        start, ostart = int(x[i]), int(y[i])
        end, oend = start + width, ostart + width
        score, matches = width * MATCH, width
        peak = (score, end, oend, matches, i)
        j = i + 1
        while j < n:
            nx, ny = int(x[j]), int(y[j])
            if nx < end or ny < oend:  # overlaps the seed before: only what is new counts
                new = min(nx + width - end, ny + width - oend)
                slip = abs((nx - end) - (ny - oend))
                if new <= 0:
                    j += 1
                    continue
                score += new * MATCH + slip * MISS
                matches += new
            else:
                same = _matched(a[end:nx], b[oend:ny])
                missed = max(nx - end, ny - oend) - same
                score += same * MATCH + missed * MISS + width * MATCH
                matches += same + width
            end, oend = nx + width, ny + width
            if score > peak[0]:
                peak = (score, end, oend, matches, j)
            elif peak[0] - score > DROP:
                break
            j += 1
        _, end, oend, matches, last = peak
        more = _extent(a[end:], b[oend:])
        matches += int((a[end : end + more] == b[oend : oend + more]).sum())
        end, oend = end + more, oend + more
        more = _extent(a[:start][::-1], b[:ostart][::-1])
        matches += int((a[start - more : start] == b[ostart - more : ostart]).sum())
        start, ostart = start - more, ostart - more
        long, short = max(end - start, oend - ostart), min(end - start, oend - ostart)
        if short >= min_words and matches >= min_identity * long:
            found.append((start, end, ostart, oend, matches))
        i = last + 1
        while i < n and x[i] < end:  # within the passage that was just taken
            i += 1
    return found
