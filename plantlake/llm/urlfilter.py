"""URL filters: rules by host and path, compiled to a Bloom filter cascade.

Rules are evaluated once per distinct key (host, path) of the corpus. The keys
they block are then encoded exactly: level one of the cascade is a Bloom filter
of the listed keys, level two one of the other keys that pass level one, level
three one of the listed keys that pass level two, and so on, until a level lets
nothing wrong through. Since the levels are built over the corpus's complete
key universe, membership is exact for every key in it, and judging a page needs
the filters, but no join with the keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import UPPER, stored

#: Distinct keys of one shard of the cascade, about, and bits per key of a level.
SHARD_KEYS = 100_000
BITS_PER_KEY = 6
#: Cascades up to this size in all go to every task; larger ones are met shard by shard.
MAX_SHIPPED_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# --- keys and rules ----------------------------------------------------------


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits host or a parent domain and the path's start, as its name; else null."""
    longest = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(r.name)
        )
        for r in longest
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def rule_verdict(rule: Column, rules: list[Rule]) -> Column:
    """allow or block; null where no rule fits."""
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.name, F.lit(r.verdict)).otherwise(verdict)
    return verdict


# --- the cascade -------------------------------------------------------------


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """The bit positions of each key: (keys, probes)."""
    step = (h2 | np.uint64(1)) + np.uint64(2 * level)
    k = np.arange(1, probes + 1, dtype=np.uint64) + np.uint64(level * 97)
    mixed = h1[:, None] + k[None, :] * step[:, None]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) % np.uint64(bits)


def _passes(bitmap: np.ndarray, h1, h2, level: int, probes: int) -> np.ndarray:
    at = _positions(h1, h2, level, bitmap.size * 8, probes)
    set_ = (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return set_.all(axis=1)


PROBES = max(1, round(BITS_PER_KEY * math.log(2)))


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[np.ndarray]:
    """The levels over a universe of distinct keys, given by two hashes each."""
    inside, outside = listed.nonzero()[0], (~listed).nonzero()[0]
    levels: list[np.ndarray] = []
    while inside.size:
        size = max(8, inside.size * BITS_PER_KEY // 8 + 1)
        bitmap = np.zeros(size, dtype=np.uint8)
        at = _positions(h1[inside], h2[inside], len(levels), size * 8, PROBES).ravel()
        np.bitwise_or.at(bitmap, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        wrong = outside[_passes(bitmap, h1[outside], h2[outside], len(levels), PROBES)]
        levels.append(bitmap)
        inside, outside = wrong, inside  # the next level encodes what came through wrongly
    return levels


def in_cascade(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Listed or not: the first level that stops a key decides."""
    listed = np.zeros(h1.size, dtype=bool)
    open_ = np.arange(h1.size)
    for k, bitmap in enumerate(levels):
        open_ = open_[_passes(bitmap, h1[open_], h2[open_], k, PROBES)]
        # a key that passes levels 0..k and stops at k+1 is listed when k is even
        listed[open_] = k % 2 == 0
    return listed


def _unpack(sizes, blob: bytes) -> list[np.ndarray]:
    ends = np.cumsum(sizes)
    data = np.frombuffer(blob, dtype=np.uint8)
    return [data[end - size : end] for size, end in zip(sizes, ends, strict=True)]


def _key_hashes(host: Column, path: Column) -> tuple[Column, Column]:
    """128 bits of a key as two longs."""
    return F.xxhash64(host, path), F.xxhash64(F.lit("second"), path, host)


class Cascade:
    """A sharded cascade: (shard, sizes, levels) rows in the shared folder."""

    def __init__(self, shards: DataFrame, count: int):
        self.shards, self.count = shards, count

    @classmethod
    def build(cls, universe: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
        """``universe``: distinct rows of host, path, listed. It may be empty."""
        h1, h2 = _key_hashes(F.col("host"), F.col("path"))
        keys = stored(universe.select(h1.alias("h1"), h2.alias("h2"), "listed"), "url-keys")
        count = max(1, math.ceil(keys.count() / shard_keys))
        keys = keys.withColumn("shard", F.pmod(F.col("h2"), F.lit(count)).cast("int"))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            listed = pdf["listed"].to_numpy(dtype=bool)
            h1, h2 = (pdf[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
            levels = build_cascade(h1, h2, listed)
            blob = b"".join(level.tobytes() for level in levels)
            return pd.DataFrame(
                {"shard": pdf["shard"].iloc[:1], "sizes": [[x.size for x in levels]], "levels": [blob]}
            )

        shards = keys.groupBy("shard").applyInPandas(
            build, "shard int, sizes array<long>, levels binary"
        )
        return cls(stored(shards, "url-cascade"), count)

    def contains(self, pages: DataFrame, max_shipped: int = MAX_SHIPPED_BYTES) -> DataFrame:
        """``pages`` (with host, path) plus ``listed``. Exact for keys of the universe."""
        h1, h2 = _key_hashes(F.col("host"), F.col("path"))
        shard = F.pmod(h2, F.lit(self.count)).cast("int")
        size = self.shards.agg(F.sum(F.octet_length("levels"))).first()[0] or 0
        if size <= max_shipped:
            return self._shipped(pages, shard, h1, h2)
        return self._routed(pages, shard, h1, h2)

    def _shipped(self, pages, shard, h1, h2) -> DataFrame:
        found = {r["shard"]: (r["sizes"], bytes(r["levels"])) for r in self.shards.collect()}
        shipped = pages.sparkSession.sparkContext.broadcast(found)

        @F.pandas_udf("boolean")
        def member(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            levels = {k: _unpack(*v) for k, v in shipped.value.items()}
            for shards, a, b in parts:
                a, b = a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64)
                out = np.zeros(len(shards), dtype=bool)
                for k in shards.unique():
                    mine = (shards == k).to_numpy()
                    out[mine] = in_cascade(levels.get(k, []), a[mine], b[mine])
                yield pd.Series(out)

        return pages.withColumn("listed", member(shard, h1, h2))

    def _routed(self, pages, shard, h1, h2, salts: int = 64) -> DataFrame:
        """Beyond the size that is shipped: each page goes to its shard's filter.

        A host that holds a third of the pages has many keys, a key many pages:
        pages are salted, and each salt gets a copy of the filter.
        """
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
        schema = pages.schema
        asked = pages.select(
            shard.alias("shard"), salt.alias("salt"), h1.alias("h1"), h2.alias("h2"),
            F.struct("*").alias("page"),
        )
        filters = self.shards.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def meet(filters: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            levels = _unpack(filters["sizes"].iloc[0], filters["levels"].iloc[0]) if len(filters) else []
            a, b = (asked[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("h1", "h2"))
            return pd.DataFrame({"page": asked["page"], "listed": in_cascade(levels, a, b)})

        out = filters.groupBy("shard", "salt").cogroup(asked.groupBy("shard", "salt")).applyInPandas(
            meet, f"page {schema.simpleString()}, listed boolean"
        )
        return out.select("page.*", "listed")


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row with page_id and url.

    ``rule`` is the rule that fits, or null. The verdict is read from a cascade
    that lists the keys (host, path) whose verdict differs from ``default``.
    A null url or one without ``://`` has an empty host and path, which no rule
    fits. An empty table gives no rows.
    """
    keyed = pages.select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    ).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    other = "block" if default == "allow" else "allow"
    verdict = F.coalesce(rule_verdict(F.col("rule"), rules), F.lit(default))
    universe = (
        keyed.select("host", "path", "rule").distinct()
        .select("host", "path", (verdict == other).alias("listed"))
    )
    cascade = Cascade.build(universe)
    judged = cascade.contains(keyed)
    return judged.withColumn(
        "verdict", F.when(F.col("listed"), F.lit(other)).otherwise(F.lit(default))
    ).drop("listed")
