"""Payments counted in event-time windows while they arrive; late ones are kept aside.

Spark's stateful operators drop rows behind the watermark without a trace. So a
first stream deals the payments: those that are behind the watermark when their
micro-batch begins go to a side table, all others to a table that a second
stream reads. The second has the same watermark and, run after the first (as with
``availableNow``), sees batches no finer than the first, so it drops nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txflow.session import children, read_text, remove, write_text


def deal(payments: DataFrame, checkpoint: str, path: str, delay_seconds: int = 3600, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream of payments to ``path/ontime`` and ``path/late``.

    Late is a payment whose ``ts`` is more than ``delay_seconds`` before the
    newest of earlier micro-batches. The newest time is noted batch by batch, so a
    batch that runs again decides as it did. A payment without a time is late.
    """
    base = path.rstrip("/")

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = _newest(spark, base, number)
        late = F.col("ts").isNull()
        if newest is not None:
            late |= F.unix_micros("ts") < newest - delay_seconds * 1_000_000
        for name, rows in (("late", batch.where(late)), ("ontime", batch.where(~late))):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .parquet(f"{base}/{name}/batch={number:012d}"))
        done = spark.read.schema(batch.schema).parquet(f"{base}/ontime/batch={number:012d}")
        top = done.agg(F.max(F.unix_micros("ts"))).first()[0]
        if top is not None or newest is not None:
            write_text(spark, f"{base}/newest/{number:012d}", str(max(x for x in (top, newest) if x is not None)))
        for name in children(spark, f"{base}/newest"):
            if name.isdigit() and int(name) < number - 1:  # the one before is needed if this batch runs again
                remove(spark, f"{base}/newest/{name}")

    return (payments.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def _newest(spark: SparkSession, base: str, number: int) -> int | None:
    """Microseconds of the newest payment before a batch."""
    earlier = [name for name in children(spark, f"{base}/newest") if name.isdigit() and int(name) < number]
    return int(read_text(spark, f"{base}/newest/{max(earlier)}")) if earlier else None


def late(spark: SparkSession, path: str, schema) -> DataFrame:
    """The payments that came too late for their windows."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/late")


def ontime(spark: SparkSession, path: str, schema) -> DataFrame:
    """The others, as a stream."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/ontime")


def velocity_windows(payments: DataFrame, delay: str = "1 hour", size: str = "10 minutes", slide: str = "5 minutes") -> DataFrame:
    """Payments and their sum per cardholder and sliding window, each once when the watermark has passed its end."""
    return (payments.withWatermark("ts", delay).groupBy("cardholder_id", F.window("ts", size, slide).alias("w"))
            .agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
            .select("cardholder_id", F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), "n", "amount"))


def burst_sessions(payments: DataFrame, delay: str = "1 hour", gap: str = "10 minutes", max_amount: float = 5,
                   least: int = 3) -> DataFrame:
    """Runs of at least ``least`` small payments of a cardholder, each less than ``gap`` after the one before.

    A run appears once, when the watermark has passed its end.
    """
    runs = (payments.where(F.col("amount") <= max_amount).withWatermark("ts", delay)
            .groupBy("cardholder_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n")))
    return runs.where(F.col("n") >= least).select("cardholder_id", F.col("s.start").alias("begins"), F.col("s.end").alias("ends"), "n")


def append(rows: DataFrame, checkpoint: str, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Write finished windows to Parquet, each exactly once."""
    return (rows.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start())
