"""Reconciliation of batch against stream, and load checks, over sightings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions.timestamps import whole_seconds
from txflow.operators.quantiles import quantiles
from txflow.skew import DEFAULT, Limits


def _is(kind: str) -> Column:
    return F.col("source") == kind


def count_by_source(sightings: DataFrame) -> DataFrame:
    return (sightings.groupBy("source").agg(F.count("*").alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc_nulls_last("source")))


def source_pivot(sightings: DataFrame) -> DataFrame:
    return sightings.agg(F.count_if(_is("batch")).alias("batchCount"), F.count_if(_is("kafka")).alias("streamCount"))


def _only(sightings: DataFrame, here: str, there: str) -> DataFrame:
    """Record numbers seen from ``here`` and never from ``there``, with their latest sighting.

    An anti-join would pair every sighting with its counterpart's; one combined
    aggregation over both sides answers the same and does not mind a number
    that is seen again and again.
    """
    latest = F.max(F.when(_is(here), F.struct("seq", "amount", "ts")))
    return (sightings.where(F.col("source").isin(here, there)).groupBy("trans_num")
            .agg(latest.alias("latest"), F.count_if(_is(there)).alias("others"))
            .where(F.col("latest").isNotNull() & (F.col("others") == 0) & F.col("trans_num").isNotNull())
            .select(F.col("trans_num").alias("transNum"), F.col("latest")["amount"].alias("amount"),
                    F.col("latest")["ts"].alias("ts")))


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.orderBy("transNum").limit(limit)


def batch_only(sightings: DataFrame, limit: int | None = 500) -> DataFrame:
    return _first(_only(sightings, "batch", "kafka"), limit)


def stream_only(sightings: DataFrame, limit: int | None = 50) -> DataFrame:
    return _first(_only(sightings, "kafka", "batch"), limit)


def lags(sightings: DataFrame, *more: str) -> DataFrame:
    """Whole seconds between a stream record's event time and its ingest, and columns named besides."""
    return sightings.where(_is("kafka")).select(
        *more, F.col("trans_num").alias("transNum"),
        whole_seconds(F.col("ts"), F.col("ingested_at")).alias("ingestLagSeconds"))


def ingest_lag(sightings: DataFrame, limit: int | None = 50) -> DataFrame:
    rows = lags(sightings)
    return rows if limit is None else rows.orderBy(F.desc_nulls_first("ingestLagSeconds"), "transNum").limit(limit)


def lag_distribution(sightings: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99),
                     limits: Limits = DEFAULT) -> DataFrame:
    """One row: n, min, max, avg and one column per quantile (``p50`` and so on)."""
    rows = lags(sightings)
    if rows.count() <= limits.rows:  # one pass gives all
        one = rows.agg(
            F.count("ingestLagSeconds").alias("n"), F.min("ingestLagSeconds").alias("min"),
            F.max("ingestLagSeconds").alias("max"), F.avg("ingestLagSeconds").alias("avg"),
            F.percentile("ingestLagSeconds", list(probs)).alias("q"))
        return one.select("n", "min", "max", "avg", *[F.col("q")[i].alias(f"p{p * 100:g}") for i, p in enumerate(probs)])
    plain = rows.agg(F.count("ingestLagSeconds").alias("n"), F.min("ingestLagSeconds").alias("min"),
                     F.max("ingestLagSeconds").alias("max"), F.avg("ingestLagSeconds").alias("avg"))
    points = quantiles(rows, None, "ingestLagSeconds", probs, limits)
    named = points.select(*[F.col("q")[i].alias(f"p{p * 100:g}") for i, p in enumerate(probs)])
    return plain.join(F.broadcast(named), how="left")  # one row each


def lag_distribution_of(counts: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """``lag_distribution`` from how many records (``n``) had which lag; lags are whole seconds, so those are few."""
    each = counts.where(F.col("ingestLagSeconds").isNotNull()).groupBy("ingestLagSeconds").agg(F.sum("n").alias("n"))
    lag, n = F.col("ingestLagSeconds"), F.col("n")
    one = each.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.min(lag).alias("min"), F.max(lag).alias("max"),
                   (F.sum(lag * n) / F.sum(n)).alias("avg"), F.percentile(lag, list(probs), n).alias("q"))
    return one.select("n", "min", "max", "avg", *[F.col("q")[i].alias(f"p{p * 100:g}") for i, p in enumerate(probs)])


def verify_load(sightings: DataFrame) -> DataFrame:
    return sightings.agg(F.count_if(_is("batch")).alias("batchCount"))


def accepted(sightings: DataFrame, trans_nums: list[str]) -> DataFrame:
    """Which of the given record numbers made it in, and how."""
    return sightings.where(F.col("trans_num").isin(trans_nums)).select(
        F.col("trans_num").alias("transNum"), "source", F.col("ingested_at").alias("ingestedAt"))


def daily_counts(sightings: DataFrame) -> DataFrame:
    return (sightings.groupBy(F.to_date("ingested_at").alias("dt"), "source")
            .agg(F.count("*").alias("cnt")))


def duplicate_counts(sightings: DataFrame) -> DataFrame:
    """Per source: record numbers seen more than once, and how many sightings too many."""
    repeats = sightings.groupBy("trans_num", "source").agg(F.count("*").alias("times")).where("times > 1")
    return repeats.groupBy("source").agg(F.count("*").alias("numbers"), F.sum(F.col("times") - 1).alias("extra"))


def field_mismatches(quarantine: DataFrame) -> DataFrame:
    """Rejected fields by source and error type."""
    return (quarantine.select("source", "error_type", F.explode("failed_fields").alias("field"))
            .groupBy("source", "error_type", "field").agg(F.count("*").alias("cnt")))
