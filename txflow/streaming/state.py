"""The upsert as a stateful stream: Spark keeps the state of every record number."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txflow.operators import fold
from txflow.session import children

#: Keeps state on disk beside the task, so that it may outgrow memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fold_stream(sightings: DataFrame, checkpoint: str, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Fold a stream of sightings; after each micro-batch the states of the numbers it touched go to ``path``.

    The state of a number is that of ``fold.fold_state`` (first and last
    sighting, last of each source, count). It is kept as long as the checkpoint,
    as an upsert may come at any time. A micro-batch costs what it holds, not
    what came before, and one that runs again replaces its own folder.
    """
    spark = sightings.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def store(states: DataFrame, batch_id: int) -> None:
        (states.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{path.rstrip('/')}/batch={batch_id:012d}"))

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        return (fold.fold_state(sightings).writeStream.outputMode("update").foreachBatch(store)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def folded(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest state of every record number; None before the first micro-batch.

    States of a number only grow, so the newest is the one with the largest count.
    """
    if not children(spark, path):
        return None
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
    state = [c for c in rows.columns if c not in (fold.KEY, "batch")]
    newest = rows.groupBy(fold.KEY).agg(F.max(F.struct("n", *[c for c in state if c != "n"])).alias("_newest"))
    return newest.select(fold.KEY, *[F.col(f"_newest.{c}").alias(c) for c in state])
