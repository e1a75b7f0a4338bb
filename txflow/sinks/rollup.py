"""What reports need of each load, counted when it arrives and merged by day.

A load (or micro-batch) leaves four small tables per day of ingest: how often
each record number came from each source, how many stream records had which
lag, how many records were refused and for which fields, and sketches. All of
them merge by adding or by union, so a day's report reads that day's folders
(``<table>/ingest_date=<day>/load=<id>``) and never opens the landing table.
Running a load again replaces what it left.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.operators import recon, sketches
from txflow.plans.report import report_of
from txflow.session import children, remove

SCHEMAS = {
    "numbers": "trans_num STRING, source STRING, n LONG",
    "lags": "ingestLagSeconds LONG, n LONG",
    "refused": "source STRING, error_type STRING, field STRING, n LONG",
    "sketches": "lag BINARY, merchants BINARY",
}
_DAY = "ingest_date"


def _day(rows: DataFrame) -> Column:
    return (F.col(_DAY) if _DAY in rows.columns else F.to_date("ingested_at")).alias(_DAY)


class Rollups:
    """Counts by day and load under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, sightings: DataFrame, quarantine: DataFrame, load: str) -> None:
        """Count one load: its accepted records and its rejects."""
        seen = sightings.select("*", _day(sightings)) if _DAY not in sightings.columns else sightings
        refused = quarantine.select("source", "error_type", "failed_fields", _day(quarantine))
        by_source = refused.groupBy(_DAY, "source").agg(F.count("*").alias("n"))
        by_field = (refused.select(_DAY, "source", "error_type", F.explode("failed_fields").alias("field"))
                    .groupBy(_DAY, "source", "error_type", "field").agg(F.count("*").alias("n")))
        lags = recon.lags(seen.select("trans_num", "source", "ts", "ingested_at", _DAY), _DAY)
        self._write("numbers", seen.groupBy(_DAY, "trans_num", "source").agg(F.count("*").alias("n")), load)
        self._write("lags", lags.groupBy(_DAY, "ingestLagSeconds").agg(F.count("*").alias("n")), load)
        # The number of rejects of a source has no field.
        self._write("refused", by_field.unionByName(by_source, allowMissingColumns=True), load)
        self._write("sketches", sketches.day_sketches(seen, lags, _DAY), load)

    def _write(self, table: str, rows: DataFrame, load: str) -> None:
        for day in children(self.spark, f"{self.path}/{table}"):  # another day's counts of an earlier attempt
            if f"load={load}" in children(self.spark, f"{self.path}/{table}/{day}"):
                remove(self.spark, f"{self.path}/{table}/{day}/load={load}")
        (rows.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(_DAY, "load").parquet(f"{self.path}/{table}"))

    def read(self, table: str, dt: date) -> DataFrame:
        """One day's rows of all loads; no other day is listed."""
        schema = SCHEMAS[table]
        if f"{_DAY}={dt}" not in children(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/{table}/{_DAY}={dt}")

    def report(self, dt: date, thresholds: dict[str, float] | None = None) -> DataFrame:
        """The same as ``plans.report.daily_report`` over all loads of the day."""
        refused = self.read("refused", dt)
        fields = (refused.where(F.col("field").isNotNull()).groupBy("source", "error_type", "field")
                  .agg(F.sum("n").alias("cnt")))
        rejected = refused.where(F.col("field").isNull()).groupBy("source").agg(F.sum("n").alias("cnt"))
        each = self.read("numbers", dt).groupBy("trans_num", "source").agg(F.sum("n").alias("n"))
        return report_of(each, rejected, fields, recon.lag_distribution_of(self.read("lags", dt)), dt, thresholds)

    def sketches(self, dt: date) -> DataFrame:
        """One row: the sketches of the day's lags and merchants over all loads."""
        return sketches.merged(self.read("sketches", dt))


