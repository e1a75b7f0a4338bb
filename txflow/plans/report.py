"""The daily reconciliation report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.operators import recon
from txflow.skew import DEFAULT, Limits, stack

#: Largest value of a metric that still passes; metrics not listed are only reported.
THRESHOLDS = {"duplicates": 0.0, "field_mismatch": 0.0, "batch_only": 0.0, "stream_only": 0.0, "lag_p99": 300.0}


def daily_report(sightings: DataFrame, quarantine: DataFrame, dt: date,
                 thresholds: dict[str, float] | None = None, limits: Limits = DEFAULT) -> DataFrame:
    """dt, metric, dimension, value, status for records ingested on ``dt``.

    ``status`` is PASS or FAIL for metrics with a threshold; the row ``summary``
    counts the failures over all of them.
    """
    day = F.lit(dt)

    def of_day(df: DataFrame) -> DataFrame:
        """By the partition column, where there is one."""
        return df.where((F.col("ingest_date") if "ingest_date" in df.columns else F.to_date("ingested_at")) == day)

    seen, refused = of_day(sightings), of_day(quarantine)
    return report_of(number_counts(seen), refused.groupBy("source").agg(F.count("*").alias("cnt")),
                     recon.field_mismatches(refused), recon.lag_distribution(seen, limits=limits), dt, thresholds)


def number_counts(seen: DataFrame) -> DataFrame:
    """How often each record number came from each source."""
    return seen.groupBy("trans_num", "source").agg(F.count("*").alias("n"))


def report_of(each: DataFrame, rejected: DataFrame, mismatches: DataFrame, lag: DataFrame, dt: date,
              thresholds: dict[str, float] | None = None) -> DataFrame:
    """The report from its parts: ``number_counts``, rejects by source, fields by error, and the row of lags."""
    day = F.lit(dt)

    def rows(df: DataFrame, metric: str, value, dimension=None) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"),
                         (F.lit("all") if dimension is None else dimension).alias("dimension"),
                         value.cast("double").alias("value"))

    spread = lag.select(F.inline(F.array(*[
        F.struct(F.lit(f"lag_{c}").alias("metric"), F.lit("kafka").alias("dimension"),
                 F.col(f"`{c}`").cast("double").alias("value"))
        for c in lag.columns if c != "n"])))
    place = F.concat_ws("/", "source", "error_type", "field")
    metrics = stack(
        _metrics_of_numbers(each),
        rows(rejected, "rejected", F.col("cnt"), F.col("source")),
        rows(mismatches, "field_mismatch", F.col("cnt"), place),
        spread,
    )
    known = THRESHOLDS if thresholds is None else thresholds
    pairs = [x for name, most in known.items() for x in (F.lit(name), F.lit(float(most)))]
    most = F.try_element_at(F.create_map(*pairs), F.col("metric")) if pairs else F.lit(None).cast("double")
    judged = metrics.withColumn("status", F.when(F.col("value") <= most, "PASS").when(F.col("value") > most, "FAIL"))
    failures = F.count_if(F.col("status") == "FAIL")
    summary = judged.agg(
        F.lit("summary").alias("metric"), F.lit("all").alias("dimension"), failures.cast("double").alias("value"),
        F.when(failures == 0, "PASS").otherwise("FAIL").alias("status"))
    return judged.unionByName(summary).select(day.alias("dt"), "metric", "dimension", "value", "status")


def _metrics_of_numbers(each: DataFrame) -> DataFrame:
    """Records and duplicates by source, and numbers seen from one source only: one pass over the day."""
    # A number's row has its sources, as few as the report has dimensions.
    numbers = each.groupBy("trans_num").agg(
        F.count_if(F.col("source") == "batch").alias("batch"), F.count_if(F.col("source") == "kafka").alias("kafka"),
        F.collect_list(F.struct("source", "n")).alias("sources"))
    once = (F.col("pos") == 0) & F.col("trans_num").isNotNull()
    by_source = numbers.select("trans_num", "batch", "kafka", F.posexplode("sources").alias("pos", "one")).groupBy(
        F.col("one.source").alias("source")).agg(
        F.sum("one.n").alias("records"), F.sum(F.col("one.n") - 1).alias("duplicates"),
        F.count_if(once & (F.col("batch") > 0) & (F.col("kafka") == 0)).alias("batch_only"),
        F.count_if(once & (F.col("kafka") > 0) & (F.col("batch") == 0)).alias("stream_only"))

    def metric(name: str, dimension, value):
        return F.struct(F.lit(name).alias("metric"), dimension.alias("dimension"), value.cast("double").alias("value"))

    def by_each(name: str):
        return F.transform("sources", lambda e: metric(name, e["source"], e[name]))

    counts = by_source.agg(
        F.collect_list(F.struct("source", "records", "duplicates")).alias("sources"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("batch_only", "stream_only")])
    found = counts.select(F.inline(F.concat(
        by_each("records"), by_each("duplicates"),
        F.array(*[metric(n, F.lit("all"), F.col(n)) for n in ("batch_only", "stream_only")]))))
    # A source without duplicates is not mentioned.
    return found.where((F.col("metric") != "duplicates") | (F.col("value") > 0))


def write_report(report: DataFrame, path: str) -> None:
    """Replace the report's own ``dt=`` partition; a report is a handful of rows."""
    (report.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").json(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    schema = "metric STRING, dimension STRING, value DOUBLE, status STRING, dt DATE"
    return spark.read.schema(schema).json(path).select("dt", "metric", "dimension", "value", "status")
