"""Publishing events to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def messages(events: DataFrame, key: str = "trans_num") -> DataFrame:
    """Key and compact JSON value with the fields in name order."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(events.columns)]), {"ignoreNullFields": "false"})
    return events.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def publish(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write to Kafka (needs the connector)."""
    (messages(events).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).options(**options).save())
