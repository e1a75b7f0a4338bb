"""Keyed upsert as a fold over sightings.

A record number is created by its first sighting and touched by later ones;
which fields a later one may set depends on its source. All of that follows
from four sightings per key (first, last, last batch, last stream) and a
count, so the fold is one aggregation with map-side combining: a number seen a
billion times costs one row per task. States merge by the same aggregation, in
any order and any grouping.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "trans_num"
_BATCH_ONLY = ["city_pop", "lat", "long", "latitude", "longitude"]
_STREAM_ONLY = ["cardholder_lat", "cardholder_long", "merchant_lat", "merchant_long", "job"]
_FIRST = ["ts", "is_fraud", "city", "state", "source", *_BATCH_ONLY, *_STREAM_ONLY]


def _seen(*fields: str) -> Column:
    return F.struct("seq", "ingested_at", *fields)


def fold_state(sightings: DataFrame) -> DataFrame:
    """Per record number the sightings that matter. Structs sort by ``seq`` first."""
    only = lambda kind, struct: F.when(F.col("source") == kind, struct)
    return sightings.groupBy(KEY).agg(
        F.min(_seen(*_FIRST)).alias("first"),
        F.max(_seen("amount")).alias("last"),
        F.max(only("batch", _seen("ts", "is_fraud", "file"))).alias("last_batch"),
        F.max(only("kafka", _seen("category", "channel", "state"))).alias("last_kafka"),
        F.count("*").alias("n"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """Combine states of disjoint sets of sightings."""
    return merge_transactions(reduce(DataFrame.unionByName, states))


def merge_transactions(states: DataFrame) -> DataFrame:
    """One state per record number from any number of them."""
    return states.groupBy(KEY).agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("last_batch").alias("last_batch"),
        F.max("last_kafka").alias("last_kafka"),
        F.sum("n").alias("n"),
    )


def transactions(state: DataFrame) -> DataFrame:
    """The record each number holds after all its upserts."""
    first, batch, kafka = F.col("first"), F.col("last_batch"), F.col("last_kafka")

    def latest(sighting: Column, field: str) -> Column:
        # Tests the sighting, not the field: a later null does overwrite.
        return F.when(sighting.isNotNull(), sighting[field]).otherwise(first[field])

    def created_by(kind: str, field: str) -> Column:
        return F.when(first["source"] == kind, first[field])

    return state.select(
        KEY,
        first["source"].alias("source"),
        latest(batch, "ts").alias("ts"),
        F.col("last")["amount"].alias("amount"),
        latest(batch, "is_fraud").alias("is_fraud"),
        kafka["category"].alias("category"),
        kafka["channel"].alias("channel"),
        first["city"].alias("city"),
        latest(kafka, "state").alias("state"),
        *[created_by("batch", c).alias(c) for c in _BATCH_ONLY],
        *[created_by("kafka", c).alias(c) for c in _STREAM_ONLY],
        batch["file"].alias("file"),
        first["ingested_at"].alias("ingested_at"),
        F.when(F.col("n") > 1, F.col("last")["ingested_at"]).alias("updated_at"),
    )


def _linked(sightings: DataFrame) -> DataFrame:
    return sightings.where(F.col("cardholder_id").isNotNull() & F.col("merchant_id").isNotNull())


def cardholder_state(sightings: DataFrame) -> DataFrame:
    """Per cardholder the sightings that matter."""
    job = F.min(F.when(F.col("job").isNotNull(), F.struct("seq", "job")))
    return _linked(sightings).groupBy("cardholder_id").agg(
        F.min(_seen("dob")).alias("first"), job.alias("job"), F.max(_seen()).alias("last"), F.count("*").alias("n"))


def merge_cardholders(states: DataFrame) -> DataFrame:
    return states.groupBy("cardholder_id").agg(
        F.min("first").alias("first"), F.min("job").alias("job"), F.max("last").alias("last"), F.sum("n").alias("n"))


def cardholders(sightings: DataFrame) -> DataFrame:
    """One row per cardholder: birth date of the first sighting, first known job."""
    return cardholder_rows(cardholder_state(sightings))


def cardholder_rows(state: DataFrame) -> DataFrame:
    return state.select(
        "cardholder_id", F.col("first")["dob"].alias("dob"), F.col("job")["job"].alias("job"),
        F.when(F.col("n") > 1, F.col("last")["ingested_at"]).alias("updated_at"))


def merchant_state(sightings: DataFrame) -> DataFrame:
    """Per merchant the sightings that matter."""
    return _linked(sightings).groupBy("merchant_id").agg(
        F.min(_seen("merchant_lat", "merchant_long", "city", "state")).alias("first"),
        F.max(_seen()).alias("last"), F.count("*").alias("n"))


def merge_merchants(states: DataFrame) -> DataFrame:
    return states.groupBy("merchant_id").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))


def merchants(sightings: DataFrame) -> DataFrame:
    """One row per merchant, as first seen; it has no name."""
    return merchant_rows(merchant_state(sightings))


def merchant_rows(state: DataFrame) -> DataFrame:
    return state.select(
        "merchant_id", F.lit(None).cast("string").alias("name"),
        F.col("first")["merchant_lat"].alias("latitude"), F.col("first")["merchant_long"].alias("longitude"),
        F.col("first")["city"].alias("city"), F.col("first")["state"].alias("state"),
        F.when(F.col("n") > 1, F.col("last")["ingested_at"]).alias("updated_at"))


def performed(sightings: DataFrame) -> DataFrame:
    """Edges cardholder -> transaction."""
    return _linked(sightings).select("cardholder_id", KEY).distinct()


def at_merchant(sightings: DataFrame) -> DataFrame:
    """Edges transaction -> merchant."""
    return _linked(sightings).select(KEY, "merchant_id").distinct()


def upsert_stats(txns: DataFrame) -> DataFrame:
    """How many records exist, were only created, and were updated."""
    fresh = F.col("ingested_at").isNotNull() & F.col("updated_at").isNull()
    return txns.agg(F.count("*").alias("total"), F.count_if(fresh).alias("created"),
                    F.count_if(F.col("updated_at").isNotNull()).alias("updated"))
