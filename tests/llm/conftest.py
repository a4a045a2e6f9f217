"""Small tables for the training-data operators."""

import duckdb
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, source) rows.

    Extra columns carry names that operators use inside.
    """

    def make(*rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
        ]
        df = spark.createDataFrame(full, DOCS)
        clashing = ["row", "digest", "n", "key", "doc", "size", "rank", "ids", "copy", "evidence"]
        return df.withColumns({c: F.lit(f"own {c}") for c in clashing})

    return make


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def prose(seed, words, vocabulary=5000):
    """Pseudo text that repeats from run to run."""
    state, out = seed * 2654435761 % 2**32 or 1, []
    for _ in range(words):
        state = (state * 1664525 + 1013904223) % 2**32
        out.append(f"w{(state >> 8) % vocabulary}")
    return " ".join(out)
