"""Personal data: exact patterns, and a conditional random field over word shapes for what they miss.

Patterns find email addresses, IP addresses, card and phone numbers. What they
miss (numbers that run into each other, addresses with the sign written out,
phone numbers without a plus) a linear-chain CRF finds: its features are shapes
of a word and its neighbours, it is trained from a small labelled table, and
workers decode batches of word windows by Viterbi. A window holds the words
near one with a digit or an @; all other words are outside by definition.

The labelled table holds windows whose pattern matches are all beyond doubt,
and rewritten ones in which matches stand side by side or are written in other
ways; its rows are bounded, whatever the corpus. Any table of the same layout
can be used instead.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import small_batches, stored
from plantlake.llm.crf import Crf

KINDS = ("email", "ip", "card", "phone")
#: Labels: outside, then begin and inside of each kind.
LABELS = 1 + 2 * len(KINDS)
#: Labelled windows with personal data, and as many without, at most.
SAMPLE_WINDOWS = 400
#: Words of a window on each side of one that could be personal data, and hashed features.
NEAR = 2
FEATURES = 1 << 13
#: Remembered words of a task, and words of a labelled window.
KNOWN_WORDS, WINDOW_WORDS = 100_000, 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ANCHOR = re.compile(r"[0-9@]")
_RUN = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^\x00-\x7F]+")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"@|[(\[{]at[)\]}]", re.IGNORECASE)

Span = tuple[int, int, int]  # start, kind, end


# --- patterns ------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that long words without one cost nothing."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            yield start, past
        at = text.find("@", max(past, at + 1))


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """Pattern matches that pass their check, by start and kind, and those that fail it."""
    good: list[Span] = [(a, 0, b) for a, b in emails(text)]
    bad: list[Span] = []
    if not _DIGITS.search(text):
        return good, bad
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        fits = all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
        (good if fits else bad).append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if len(digits) >= 14:
            fits = len(digits) <= 19 and luhn(digits)
            (good if fits else bad).append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        size = sum(map(len, _DIGITS.findall(m[0])))
        (good if 10 <= size <= 15 else bad).append((m.start(), 3, m.end()))
    return sorted(good), sorted(bad)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- windows and features ------------------------------------------------------


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the words within NEAR of one with a digit or a sign of an address, in runs."""
    if not (_ANCHOR.search(text) or _AT.search(text)):
        return
    run: list[tuple[int, int]] = []
    before: list[tuple[int, int]] = []
    left = 0
    for m in _WORD.finditer(text):
        place = m.span()
        if _ANCHOR.search(m[0]) or _AT.search(m[0]):
            run += before
            before = []
            run.append(place)
            left = NEAR
        elif left:
            run.append(place)
            left -= 1
        else:
            if run and len(before) == NEAR:
                yield run
                run = []
            before = [*before[-NEAR + 1 :], place] if not run else [*before, place]
    if run:
        yield run


def shape(word: str) -> str:
    """Runs of letters and digits become one sign each."""
    return _RUN.sub(lambda m: "A" if m[0][0].isupper() else "9" if m[0][0].isdigit() else "a", word)[:24]


def sized_shape(word: str) -> str:
    """As :func:`shape`, with the lengths of the runs up to a limit."""
    digits = lambda m: f"9{min(20, len(m[0]))}" if m[0][0].isdigit() else f"a{min(3, len(m[0]))}"
    return _RUN.sub(digits, word)[:40]


class Shapes:
    """What a word tells of itself and its neighbours, with a bounded memory."""

    def __init__(self):
        self.known: dict[str, tuple] = {}

    def of(self, word: str) -> tuple:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            short = word[:64]
            plain = shape(short)
            size = sum(map(len, _DIGITS.findall(word)))
            name = short.lower().strip("().,:;") if not size else ""
            found = self.known[word] = (plain, sized_shape(short), f"{min(size, 20)}", short[:1] + short[-1:] if not short[:1].isalpha() else "", name[:12])
        return found

    def features(self, words: list[str]) -> np.ndarray:
        """Rows of feature indices, one row a word."""
        told = [("", "", "", "", "")] * 2 + [self.of(w) for w in words] + [("", "", "", "", "")] * 2
        rows = []
        for i in range(2, len(told) - 2):
            me, left, right = told[i], told[i - 1], told[i + 1]
            rows.append([
                _index("s", me[0]), _index("z", me[1]), _index("d", me[2]), _index("e", me[3]), _index("n", me[4]),
                _index("l", left[1]), _index("r", right[1]), _index("lz", left[0], me[1]), _index("zr", me[1], right[0]),
                _index("ll", told[i - 2][0], left[0]),
            ])
        return np.array(rows, dtype=np.int64)


def _index(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "replace")) % FEATURES


def allowed_moves() -> np.ndarray:
    """An inside follows only a begin or inside of its kind."""
    allowed = np.ones((LABELS, LABELS), dtype=bool)
    for kind in range(len(KINDS)):
        begin, inside = 1 + 2 * kind, 2 + 2 * kind
        allowed[:, inside] = False
        allowed[[begin, inside], inside] = True
    return allowed


# --- the labelled table ----------------------------------------------------------


def labels_of(places: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """A label for each word; a word that two spans touch takes the first."""
    labels = [0] * len(places)
    for start, kind, end in spans:
        met = [i for i, (a, b) in enumerate(places) if a < end and b > start and not labels[i]]
        for turn, i in enumerate(met):
            labels[i] = 1 + 2 * kind + (turn > 0)
    return labels


def rewritten(words: list[str], labels: list[int], other: tuple[list[str], list[int]]) -> list[tuple[list[str], list[int]]]:
    """A labelled window in other ways: next to another's data, with the sign written out, without a country code."""
    out = []
    first = next(i for i, x in enumerate(labels) if x)
    last = next((i for i in range(first + 1, len(labels)) if labels[i] % 2 or not labels[i]), len(labels))
    start = next(i for i, x in enumerate(other[1]) if x)
    out.append((words[:last] + other[0][start:], labels[:last] + other[1][start:]))
    word, kind = words[first], (labels[first] - 1) // 2
    rest = words[last:], labels[last:]
    if kind == 0 and word.count("@") == 1:
        name, host = word.split("@")
        for mark in ("(at)", "[at]"):
            out.append(([*words[:first], name, mark, host, *rest[0]], [*labels[:first], 1, 2, 2, *rest[1]]))
    if kind == 3 and last - first > 1 and word.startswith("+"):
        out.append((words[:first] + words[first + 1 :], [*labels[:first], 7, *labels[first + 2 :]]))
    return out


def labelled(docs: DataFrame, limit: int = SAMPLE_WINDOWS, text: str = "text") -> DataFrame:
    """words, labels: at most ``limit`` windows with pattern matches and as many without; stored.

    Windows in which a match fails its check are left out: nobody knows what
    they hold. Drawn by a hash of the window, of equal ones one; the same in
    every run.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[int, bytes], tuple] = {}
            for value in batch.column(0):
                held = value.as_py() or ""
                if not _ANCHOR.search(held):
                    continue
                good, bad = matches(held)
                for run in windows(held):
                    low, high = run[0][0], run[-1][1]
                    if len(run) > WINDOW_WORDS or any(a < high and b > low for a, _, b in bad):
                        continue
                    inside = [s for s in good if s[0] < high and s[2] > low]
                    words = [held[a:b][:64] for a, b in run]
                    labels = labels_of(run, inside)
                    key = xxhash.xxh3_128_digest("\x00".join(words).encode("utf-8", "replace"))
                    best[int(any(labels)), key] = (words, labels)
            for side in (0, 1):
                keys = sorted(k for k in best if k[0] == side)[:limit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([side] * len(keys), pa.int32()), pa.array([k[1] for k in keys], pa.binary()),
                        pa.array([best[k][0] for k in keys], pa.list_(pa.string())),
                        pa.array([best[k][1] for k in keys], pa.list_(pa.int32())),
                    ],
                    ["side", "key", "words", "labels"],
                )

    found = docs.select(F.col(f"`{text}`")).mapInArrow(cut, "side int, key binary, words array<string>, labels array<int>")
    found = found.groupBy("side", "key").agg(F.min(F.struct("words", "labels")).alias("row"))
    found = stored(found, "pii-windows")
    draw = lambda side: found.where(F.col("side") == side).orderBy("key").limit(limit)
    return stored(draw(1).unionByName(draw(0)).select("key", "row.*"), "pii-labelled")


def fit(table: DataFrame) -> Crf:
    """A CRF from a labelled table (key, words, labels), which must be small; see :func:`rewritten`."""
    rows = [(r["words"], r["labels"]) for r in table.orderBy("key").collect() if r["words"]]
    marked = [r for r in rows if any(r[1])]
    for (words, labels), other in list(zip(marked, marked[1:] + marked[:1], strict=True)):
        rows += rewritten(words, labels, other)
    shapes = Shapes()
    x = [shapes.features(words) for words, _ in rows]
    y = [np.array(labels, dtype=np.int64) for _, labels in rows]
    return Crf.fit(x if marked else [], y if marked else [], FEATURES, allowed_moves())


# --- finding ---------------------------------------------------------------------


def spans_of(text: str, places: list[tuple[int, int]], labels: np.ndarray) -> Iterator[Span]:
    """Spans of labelled words, without the marks around them, if they can be what they are called."""
    i = 0
    while i < len(labels):
        if not labels[i]:
            i += 1
            continue
        kind, j = (int(labels[i]) - 1) // 2, i + 1
        while j < len(labels) and labels[j] == 2 + 2 * kind:
            j += 1
        start, end = places[i][0], places[j - 1][1]
        while start < end and not (text[start].isalnum() or kind == 3 and text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if _can_be(kind, text[start:end]):
            yield start, kind, end
        i = j


def _can_be(kind: int, found: str) -> bool:
    digits = _DIGITS.findall(found)
    size, letters = sum(map(len, digits)), any(c.isalpha() for c in found)
    if kind == 0:
        return bool(_AT.search(found)) and letters and "." in found
    if letters:
        return False
    if kind == 1:
        return len(digits) == 4 and all(len(d) <= 3 and int(d) <= 255 for d in digits)
    return 14 <= size <= 19 and luhn("".join(digits)) if kind == 2 else 7 <= size <= 15


def find(docs: DataFrame, model: Crf) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and ``base_sha256`` are of the patterns' spans; ``spans`` has those
    and the spans of the CRF that touch none of them, as kind:start:end in code
    points, by start. Null and empty texts have none. Rows that repeat an id,
    or have none, stay rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    counts = [f"n_{k}" for k in KINDS]
    weights, moves, allowed = model.weights.astype(np.float32), model.moves, model.allowed

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, shapes = Crf(weights, moves, allowed), Shapes()
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            base = [matches(t)[0] for t in texts]
            runs = [(row, run) for row, t in enumerate(texts) for run in windows(t)]
            best = crf.decode([shapes.features([texts[row][a:b] for a, b in run]) for row, run in runs])
            found = [list(spans) for spans in base]
            for (row, run), labels in zip(runs, best, strict=True):
                held = base[row]
                for start, kind, end in spans_of(texts[row], run, labels):
                    if not any(a < end and b > start for a, _, b in held):
                        found[row].append((start, kind, end))
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            columns.append(pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string()))
            columns.append(pa.array([written(sorted(f)) for f in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *counts, "base_sha256", "spans"])

    schema = "doc_id long, " + "".join(f"{c} long, " for c in counts) + "base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, schema)
