"""Message streams in the shape the Kafka connector delivers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.schemas import KAFKA_MESSAGE


def kafka_stream(spark: SparkSession, servers: str, topic: str, group: str = "txflow", **options: str) -> DataFrame:
    """Subscribe to ``topic`` from its earliest offset (needs the Kafka connector)."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.group.id": group,
        "failOnDataLoss": "true",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def replay_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stored messages (Parquet files in the Kafka shape) as a stream."""
    reader = spark.readStream.schema(KAFKA_MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def decode(messages: DataFrame) -> DataFrame:
    """Key and value as text; bytes that are no UTF-8 give a null ``value`` and a repaired ``raw_value``."""
    value = F.col("value").cast(T.StringType())
    return messages.select(
        F.make_valid_utf8(F.col("key").cast("string")).alias("kafka_key"),
        F.try_validate_utf8(value).alias("value"),
        F.make_valid_utf8(value).alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
    )
