"""Gold → relational serving table, and events → topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.functions.records import encode_events


def counted(df: DataFrame, name: str = "exported") -> tuple[DataFrame, Observation]:
    """The rows, and a counter filled by the same pass that writes them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def serving_options(url: str, properties: dict[str, str], connections: int) -> dict[str, str]:
    """``truncate`` keeps grants and indexes; ``numPartitions`` bounds connections."""
    return {
        "url": url,
        "dbtable": schemas.SERVING_TABLE,
        "truncate": "true",
        "numPartitions": str(connections),
        **properties,
    }


def serve_gold(
    gold: DataFrame, url: str, properties: dict[str, str], connections: int = 16
) -> int:
    """Overwrite the serving table and return how many rows were written."""
    rows, seen = counted(gold)
    options = serving_options(url, properties, connections)
    rows.write.format("jdbc").mode("overwrite").options(**options).save()
    return seen.get["rows"]


def publish_events(events: DataFrame, servers: str, topic: str = schemas.SENSOR_TOPIC) -> None:
    """Events to the topic, keyed by equipment (needs the Kafka connector)."""
    (
        encode_events(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
