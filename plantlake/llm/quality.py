"""Quality classifier: hierarchical empirical Bayes over document evidence and sites.

A logistic model on word and surface features gives each document a log
likelihood ratio, its evidence, free of the training prior. The evidence of all
documents is averaged per path and host. Hosts are shrunk toward the global
rate and paths toward their host, with prior strengths estimated from the
spread between sites, so a site with few documents says little and one with
many has its own rate. A document's score is its evidence on top of its path's
posterior rate, taken without the document itself. All statistics are grouped aggregates over all documents; only
the model is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import sized_broadcast, small_batches, stored

#: Labelled rows the model is fitted on, at most; drawn by a hash of their id.
SAMPLE_ROWS = 20_000
#: Words with a weight of their own; hash buckets from which they are chosen.
CHOSEN_WORDS = 256
BUCKETS = 1 << 18
#: Labelled documents that must hold a word, and how clearly it must tell the classes apart.
MIN_DOCUMENTS = 8
MIN_GAIN = 16.0
#: Rows that a Newton step takes at a time.
FIT_ROWS = 1_000
#: What is known of a path for a target: its own sums, its host's and those of all documents.
SITE = ("n", "s", "strength", "host_n", "host_s", "host_strength", "whole_n", "whole_s")
#: Bounds of a prior strength, in documents.
STRENGTH = (1.0, 1e6)

_STRIP = b".,;:!?|()[]{}\"'*#-"


@dataclass(frozen=True)
class Target:
    """A label and the side of it that is kept."""

    label: str
    keep: int


#: What the query and the pipeline ask of a document.
TARGETS = (Target("quality", 1), Target("toxic", 0))


# --- features ----------------------------------------------------------------


def word_bucket(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word.strip(_STRIP).lower()) % BUCKETS


class Words:
    """The buckets of a text's words, with a bounded memory."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def buckets(self, words: set[bytes]) -> set[int]:
        if len(self.known) > 100_000:
            self.known.clear()
        known, found = self.known, set()
        for word in words:
            bucket = known.get(word)
            if bucket is None:
                bucket = known[word] = word_bucket(word)
            found.add(bucket)
        return found


SURFACE = 9


def surface(raw: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Shares of letter cases, marks and digits, repetition, length."""
    size, n = max(1, len(raw)), max(1, len(words))
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lines = raw.split(b"\n")
    return [
        counts[65:91].sum() / size,
        counts[48:58].sum() / size,
        min(1.0, counts[33] / n),
        min(1.0, counts[124] / n),
        (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / size,
        distinct / n / min(1.0, 40 / n**0.5),
        1 - len(set(lines)) / len(lines),
        min(20.0, size / n),
        float(np.log1p(len(words))),
    ]


def _sample(docs: DataFrame, labels: DataFrame, targets, limit: int) -> DataFrame:
    """text and 0/1 per target for at most ``limit`` labelled rows, the same each run.

    Ids are drawn among those that have a document, and an id that repeats
    gives one row, the one with the smallest hash of its text.
    """
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(t.label).cast("int").alias(f"t{k}") for k, t in enumerate(targets)]
    )
    held = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    drawn = held.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    drawn = F.broadcast(drawn)  # at most ``limit`` rows of a few numbers
    picked = docs.select("doc_id", "text").join(drawn, "doc_id")
    # each task sends one row of an id, however many it has
    marks = [f"t{k}" for k in range(len(targets))]
    one = picked.groupBy("doc_id", *marks).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("one.text", *marks)


def _chosen_words(sample: DataFrame, target: int) -> list[int]:
    """The buckets whose presence tells the classes apart best, by the likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            seen = np.zeros((2, BUCKETS), dtype=np.int32)
            for text, side in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[side, list(words.buckets(set((text or "").encode().split())))] += 1
            some = np.flatnonzero(seen.sum(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(seen[0, some].astype(np.int64)), pa.array(seen[1, some].astype(np.int64))],
                ["bucket", "n0", "n1"],
            )

    marked = sample.where(F.col(f"t{target}").isin(0, 1)).select("text", f"t{target}")
    sides = {r[0]: r[1] for r in marked.groupBy(f"t{target}").count().collect()}
    if len(sides) < 2:
        return []
    found = marked.mapInArrow(count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    all_ = float(sides[0] + sides[1])

    def gain(seen: Column, side: int) -> Column:
        """n log(n / expected), over holding the word or not."""
        expected = (F.col("n0") + F.col("n1")) * (sides[side] / all_)
        without = F.lit(sides[side]) - seen
        expected_without = F.lit(float(sides[side])) - expected
        part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
        return part(seen, expected) + part(without, expected_without)

    told = 2 * (gain(F.col("n0"), 0) + gain(F.col("n1"), 1))
    best = (
        found.where(F.col("n0") + F.col("n1") >= MIN_DOCUMENTS)
        .withColumn("gain", told)
        .where(F.col("gain") >= MIN_GAIN)
        .orderBy(F.desc("gain"), "bucket")
        .limit(CHOSEN_WORDS)
    )
    return [r["bucket"] for r in best.select("bucket").collect()]


# --- the document model ------------------------------------------------------


def fit_logistic(x, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (the last one is the constant) by Newton steps with a ridge penalty.

    ``x`` is the model matrix, or a function that gives its rows from one to
    another: only FIT_ROWS of them are held at a time.
    """
    rows = x if callable(x) else lambda start, end: x[start:end]
    w = penalty = None
    for _ in range(steps):
        gradient = hessian = 0.0
        for start in range(0, len(y), FIT_ROWS):
            part = rows(start, start + FIT_ROWS)
            part = np.hstack([part, np.ones((len(part), 1))])
            if w is None:
                w, penalty = np.zeros(part.shape[1]), np.full(part.shape[1], ridge)
                penalty[-1] = 1e-3
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            gradient += part.T @ (p - y[start : start + FIT_ROWS])
            hessian += (part * (p * (1 - p))[:, None]).T @ part
        gradient, hessian = gradient + penalty * w, hessian + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Evidence:
    """The log likelihood ratio of a text for each target; zero if it could not be fitted."""

    def __init__(self, targets: int):
        self.words: list[list[int]] = [[] for _ in range(targets)]
        self.weights: list[np.ndarray | None] = [None] * targets
        self.prior = [0.0] * targets
        self.middle = np.zeros(SURFACE)
        self.scale = np.ones(SURFACE)

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, targets=TARGETS, limit: int = SAMPLE_ROWS) -> Evidence:
        self = cls(len(targets))
        sample = stored(_sample(docs, labels, targets, limit), "quality-sample")
        self.words = [_chosen_words(sample, k) for k in range(len(targets))]
        feature_rows = self._features()

        @F.arrow_udf("array<float>")
        def features(texts: pa.Array) -> pa.Array:
            return pa.array(list(feature_rows(texts.to_pylist())), pa.list_(pa.float32()))

        columns = [f"t{k}" for k in range(len(targets))]
        rows = sample.select(
            features(F.col("text")).alias("x"), *[F.coalesce(c, F.lit(-1)).alias(c) for c in columns]
        ).toArrow()  # at most ``limit`` rows of a few hundred numbers
        if not rows.num_rows:
            return self
        width = SURFACE + sum(map(len, self.words))
        # views of what Spark sent: single precision, put together nowhere
        parts = [c.flatten().to_numpy().reshape(-1, width) for c in rows["x"].chunks]
        shape = np.concatenate([p[:, :SURFACE] for p in parts]).astype(float)
        self.middle, self.scale = shape.mean(axis=0), shape.std(axis=0) + 1e-6
        ends = np.cumsum([len(p) for p in parts])
        for k, column in enumerate(columns):
            y = rows[column].to_numpy()
            known = (y == 0) | (y == 1)
            if known.sum() and 0 < y[known].mean() < 1:
                at, design = np.flatnonzero(known), self._design(k)

                def model(start: int, end: int) -> np.ndarray:
                    own = at[start:end]
                    of = np.searchsorted(ends, own, side="right")
                    part = [parts[i][own[of == i] - (ends[i] - len(parts[i]))] for i in np.unique(of)]
                    return design(np.concatenate(part).astype(float))

                self.weights[k] = fit_logistic(model, y[known].astype(float))
                self.prior[k] = float(np.log(y[known].mean() / (1 - y[known].mean())))
        return self

    def _design(self, k: int):
        """Makes the model matrix of target k: surface features and the target's words."""
        middle, scale = self.middle, self.scale
        start = SURFACE + sum(map(len, self.words[:k]))
        end = start + len(self.words[k])

        def design(x: np.ndarray) -> np.ndarray:
            shape = np.clip((x[:, :SURFACE] - middle) / scale, -8, 8)
            return np.hstack([shape, x[:, start:end]])

        return design

    def _features(self):
        """Makes the feature rows of texts: surface features, then 0/1 for every chosen word."""
        chosen = [b for words in self.words for b in words]

        def feature_rows(texts: list[str | None]) -> np.ndarray:
            words, out = Words(), np.zeros((len(texts), SURFACE + len(chosen)), dtype=np.float32)
            for row, text in zip(out, texts, strict=True):
                raw = (text or "").encode()
                split = raw.split()
                distinct = set(split)
                row[:SURFACE] = surface(raw, split, len(distinct))
                held = words.buckets(distinct)
                row[SURFACE:] = [b in held for b in chosen]
            return out

        return feature_rows

    def of(self, text: Column) -> Column:
        """array<double>: the evidence for each target."""
        feature_rows = self._features()
        designs = [self._design(k) for k in range(len(self.weights))]
        weights, prior = self.weights, self.prior

        @F.arrow_udf("array<double>")
        def evidence(texts: pa.Array) -> pa.Array:
            x = feature_rows(texts.to_pylist()).astype(float)
            out = np.zeros((len(texts), len(weights)))
            for k, w in enumerate(weights):
                if w is not None:
                    d = designs[k](x)
                    out[:, k] = np.clip(d @ w[:-1] + w[-1] - prior[k], -30, 30)
            return pa.array(list(out), pa.list_(pa.float64()))

        return evidence(text)


# --- sites -------------------------------------------------------------------


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(groups: DataFrame, rate: Column | float, n: str, s: str) -> float:
    """Documents that the prior of these groups is worth: the method of moments.

    The spread of group rates around their prior beyond what sampling explains
    is rate (1 - rate) / (strength + 1).
    """
    rate = F.lit(rate) if isinstance(rate, float) else rate
    noise = rate * (1 - rate) / F.col(n)
    spread = F.pow(F.col(s) / F.col(n) - rate, F.lit(2)) - noise
    row = groups.agg(
        F.sum(F.col(n) * spread).alias("spread"), F.sum(F.col(n) * rate * (1 - rate)).alias("most")
    ).first()
    if not row["most"] or row["spread"] is None or row["spread"] <= 0:
        return STRENGTH[1]
    return float(min(max(row["most"] / row["spread"] - 1, STRENGTH[0]), STRENGTH[1]))


def site_rates(scored: DataFrame, prior: list[float]) -> DataFrame:
    """host, path, rates (array): the posterior rate of each target on each path.

    ``scored`` has host, path and evidence; ``prior`` is the log odds of each
    target among labelled rows, with which evidence becomes a probability.
    Null hosts and paths are a site of their own. ``site`` has, per target, the
    sums behind the rate, from which a document's own part can be taken
    (:func:`_others_rate`).
    """
    targets = len(prior)
    soft = [_soft(k, prior) for k in range(targets)]
    paths = stored(
        scored.groupBy("host", "path").agg(
            F.count("*").alias("n"), *[F.sum(p).alias(f"s{k}") for k, p in enumerate(soft)]
        ),
        "quality-paths",
    )
    sums = [F.sum(c).alias(c) for c in ["n", *[f"s{k}" for k in range(targets)]]]
    total = paths.agg(*sums).first()
    if not total["n"]:
        nothing = F.struct(*[F.lit(0.5).alias(c) for c in SITE])
        return paths.select(
            "host", "path", F.array(*[F.lit(0.5)] * targets).alias("rates"), F.array(*[nothing] * targets).alias("site")
        )
    renamed = {c: f"host_{c}" for c in ["n", *[f"s{k}" for k in range(targets)]]}
    hosts = paths.groupBy("host").agg(*sums).withColumnsRenamed(renamed).withColumnRenamed("host", "name")
    hosts = stored(hosts, "quality-hosts")
    whole, host_strength = [], []
    for k in range(targets):
        rate = min(max(total[f"s{k}"] / total["n"], 1e-6), 1 - 1e-6)
        a = _strength(hosts, float(rate), "host_n", f"host_s{k}")
        whole.append(float(total[f"s{k}"]))
        host_strength.append(a)
        shrunk = (F.col(f"host_s{k}") + a * rate) / (F.col("host_n") + a)
        hosts = hosts.withColumn(f"host_rate{k}", shrunk)
    paths = stored(paths.join(hosts.hint("shuffle_hash"), paths["host"].eqNullSafe(hosts["name"])), "quality-sites")
    rates, site = [], []
    for k in range(targets):
        b = _strength(paths, F.col(f"host_rate{k}"), "n", f"s{k}")
        rates.append((F.col(f"s{k}") + b * F.col(f"host_rate{k}")) / (F.col("n") + b))
        sums = [
            F.col("n"), F.col(f"s{k}"), F.lit(b), F.col("host_n"), F.col(f"host_s{k}"), F.lit(host_strength[k]),
            F.lit(total["n"]), F.lit(whole[k]),
        ]
        site.append(F.struct(*[c.cast("double").alias(name) for name, c in zip(SITE, sums, strict=True)]))
    return paths.select("host", "path", F.array(*rates).alias("rates"), F.array(*site).alias("site"))


def _soft(k: int, prior: list[float]) -> Column:
    """A document's probability by its text alone."""
    return _sigmoid(F.col("evidence")[k] + F.lit(float(prior[k])))


def _others_rate(k: int, prior: list[float]) -> Column:
    """The rate of a document's path without the document itself.

    Its evidence comes on top of this rate and must not be in it as well: a
    path of one document has the rate of its host's other documents.
    """
    site, own = F.col("site")[k], _soft(k, prior)
    rest = F.when(site["whole_n"] > 1, (site["whole_s"] - own) / (site["whole_n"] - 1)).otherwise(0.5)
    host = (site["host_s"] - own + site["host_strength"] * rest) / (site["host_n"] - 1 + site["host_strength"])
    return (site["s"] - own + site["strength"] * host) / (site["n"] - 1 + site["strength"])


def _with_rates(scored: DataFrame, rates: DataFrame) -> DataFrame:
    """``scored`` plus its path's rates."""
    sites = stored(rates.withColumnsRenamed({"host": "site_host", "path": "site_path"}), "quality-rates")
    longest = sites.agg(
        F.max(F.coalesce(F.octet_length("site_host"), F.lit(0)) + F.coalesce(F.octet_length("site_path"), F.lit(0)))
    ).first()[0] or 0
    same = scored["host"].eqNullSafe(sites["site_host"]) & scored["path"].eqNullSafe(sites["site_path"])
    return scored.join(sized_broadcast(sites, 320 + longest), same).drop("site_host", "site_path")


def _posterior(k: int, prior: list[float]) -> Column:
    return _sigmoid(F.col("evidence")[k] + _logit(_others_rate(k, prior)))


def _kept(targets, prior: list[float]) -> Column:
    """No target more likely than not on the side that goes."""
    ok = F.lit(True)
    for k, t in enumerate(targets):
        likely = _posterior(k, prior)
        ok = ok & ((likely >= 0.5) if t.keep else (likely <= 0.5))
    return ok


def _scored(docs: DataFrame, evidence: Evidence, host: Column, path: Column, *more: Column) -> DataFrame:
    return docs.select(
        *more, host.alias("host"), path.alias("path"), evidence.of(F.col("text")).alias("evidence")
    )


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, targets=TARGETS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, host, path, per target evidence and probability, keep; a row per row of ``docs``.

    ``labels`` has doc_id and a 0/1 column per target; other values and null
    ids say nothing, and an id labelled twice counts once, with its larger
    label. Without labels of both kinds a target has no evidence, every
    probability is even, and all is kept. Null and empty texts are scored
    as such. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    evidence = Evidence.fit(docs, labels, targets, sample_rows)
    scored = stored(_scored(docs, evidence, host, path, F.col("doc_id")), "quality-scores")
    judged = _with_rates(scored, site_rates(scored, evidence.prior))
    columns = []
    for k, t in enumerate(targets):
        columns += [F.col("evidence")[k].alias(f"{t.label}_evidence"), _posterior(k, evidence.prior).alias(f"p_{t.label}")]
    return judged.select("doc_id", "host", "path", *columns, _kept(targets, evidence.prior).alias("keep"))


def accepted(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, targets=TARGETS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The documents that :func:`classify` keeps, with all their columns."""
    small_batches(docs.sparkSession)
    evidence = Evidence.fit(docs, labels, targets, sample_rows)
    # scored once: the rates and the rows are both read from what is written
    whole = stored(_scored(docs, evidence, host, path, F.struct("*").alias("doc")), "quality-scored")
    rates = site_rates(whole.select("host", "path", "evidence"), evidence.prior)
    return _with_rates(whole, rates).where(_kept(targets, evidence.prior)).select("doc.*")
