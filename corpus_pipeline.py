"""The corpus pipeline: filter, dedup, near-dedup, mix and encode ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import bpe, exactdedup, jaccard, mixing, quality
from plantlake.llm.common import stored, table
from plantlake.llm.queries import vocabulary
from plantlake.session import fresh_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality and toxic ones go."""
    labels = table(spark, sf_dir, "labels")
    return quality.accepted(docs, labels, F.col("source"), F.col("lang"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    index = exactdedup.DigestIndex(spark, fresh_path(spark, "digest-index"))
    return exactdedup.deduplicate(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a near-duplicate component the row with the smallest doc_id stays."""
    return jaccard.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix sends."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), vocabulary(), with_text=True))


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_texts),
]

#: SQL can express neither the fitted classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
