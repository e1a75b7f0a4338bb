"""Rejected records as gzip JSON under source=…/ingest_date=…/batch_id=…"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.session import filled, remove

from txflow.schemas import QUARANTINE, QUARANTINE_PARTITIONS


def from_landing(landing: DataFrame) -> DataFrame:
    """The rejected half of the landing table in quarantine shape."""
    rows = landing.where("rejected").withColumn("ingest_date", F.to_date("ingested_at"))
    return rows.select(*QUARANTINE.names)


#: Rejects per task of the scan from which on they are written as they are read.
PLENTY = 20_000


def replace(rejects: DataFrame, path: str, source: str, batch_id: str, rows: int | None = None) -> None:
    """Make ``rejects`` all that is kept of one load or micro-batch, on whichever days it ran before.

    Rebalancing turns the few rejects of many tasks into evenly sized files and
    splits a partition that gets most of them. It is left out where ``rows``, if
    told, are many for each task of the scan and all cores have such a task.
    """
    spark = rejects.sparkSession
    remove(spark, f"{path.rstrip('/')}/source={source}/ingest_date=*/batch_id={batch_id}")
    cores = spark.sparkContext.defaultParallelism
    if not rows or rows < PLENTY * cores or not cores <= filled(rejects) <= rows // PLENTY:
        rejects = rejects.hint("rebalance")
    (rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("ignoreNullFields", "false")
     .partitionBy(*QUARANTINE_PARTITIONS).json(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Everything kept; nothing, before the first load that refused a record."""
    try:
        return spark.read.schema(QUARANTINE).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], QUARANTINE)
        raise


def envelope(rejects: DataFrame) -> DataFrame:
    """Stream rejects under the names of the message envelope."""
    return rejects.where(F.col("source") == "kafka").select(
        "kafka_partition", "kafka_offset", "kafka_key", "kafka_timestamp", "raw_value", "error_type",
        "error_detail", "failed_fields", F.col("ingested_at").alias("ingestedAt"),
        F.lit("kafka-stream").alias("source"))
