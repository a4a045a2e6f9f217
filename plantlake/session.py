"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Static tuning used by the jobs; every entry can be overridden per session.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # start wide, let AQE merge small shuffle partitions up to the advisory size,
    # not just until every core has one
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`JOB_CONF`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Calendar functions follow the session zone; events carry UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_LOCAL_BASE: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _LOCAL_BASE.setdefault("base", tempfile.mkdtemp(prefix="plantlake-"))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
