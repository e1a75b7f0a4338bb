"""The payment graph as node and edge tables, and queries along its paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions.timestamps import iso_utc
from txflow.operators import fold
from txflow.skew import DEFAULT, Limits, grid_join, heavy_keys, lookup


@dataclass
class Graph:
    """Three node tables and two edge tables."""

    transactions: DataFrame
    cardholders: DataFrame
    merchants: DataFrame
    performed: DataFrame
    at_merchant: DataFrame

    @classmethod
    def of(cls, sightings: DataFrame) -> Graph:
        return cls(
            fold.transactions(fold.fold_state(sightings)), fold.cardholders(sightings),
            fold.merchants(sightings), fold.performed(sightings), fold.at_merchant(sightings))

    def write(self, path: str) -> None:
        for name, table in vars(self).items():
            table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Graph:
        return cls(**{name: spark.read.parquet(f"{path}/{name}") for name in cls.__dataclass_fields__})


def paths(graph: Graph, limits: Limits | None = None) -> DataFrame:
    """Cardholder, transaction and merchant ids of every two-hop path.

    A record number has few edges in clean data. With ``limits``, numbers that many
    records share on both sides are looked for, and their pairs spread over tasks.
    """
    if limits is None:
        return graph.performed.join(graph.at_merchant, "trans_num")
    return grid_join(graph.performed, graph.at_merchant, "trans_num", limits)


def payments(graph: Graph) -> DataFrame:
    """Paths with the transaction's own fields: the input of the fraud queries."""
    return paths(graph).join(graph.transactions, "trans_num")


def flatten(graph: Graph, limit: int | None = 1000, limits: Limits = DEFAULT) -> DataFrame:
    """Every path as one wide row, oldest first.

    Merchants and cardholders may be popular, so both are looked up with their
    heavy keys kept apart.
    """
    t = payments(graph)
    m = graph.merchants.select("merchant_id", "name", F.col("city").alias("_m_city"),
                               F.col("state").alias("_m_state"), F.col("latitude").alias("_m_lat"),
                               F.col("longitude").alias("_m_long"))
    c = graph.cardholders.select("cardholder_id", F.col("job").alias("_c_job"), F.col("dob").alias("_c_dob"))
    # Counted on the edges, not on the joined rows.
    busy_merchants = heavy_keys(graph.at_merchant, "merchant_id", limits)
    busy_cardholders = heavy_keys(graph.performed, "cardholder_id", limits)
    rows = lookup(t, m, busy_merchants, how="inner")
    rows = lookup(rows, c, busy_cardholders, how="inner")
    flat = rows.select(
        F.col("trans_num").alias("Transaction_key"),
        iso_utc(F.col("ts")).alias("transdatetrans_time"),
        F.coalesce("name", "merchant_id").alias("merchant"),
        "category",
        F.col("amount").cast("double").alias("amt"),
        F.coalesce("city", "_m_city").alias("city"),
        F.coalesce("state", "_m_state").alias("state"),
        F.col("cardholder_lat").alias("lat"),
        F.col("cardholder_long").alias("long"),
        "city_pop",
        F.col("_c_job").alias("job"),
        F.col("_c_dob").alias("dob"),
        "trans_num",
        F.col("_m_lat").alias("merch_lat"),
        F.col("_m_long").alias("merch_long"),
        "is_fraud",
        F.col("ts").alias("_ts"),
    )
    ordered = flat.orderBy(F.asc_nulls_last("_ts"), F.asc_nulls_last("trans_num"), "merchant", "dob")
    return (ordered if limit is None else ordered.limit(limit)).drop("_ts")


def merchant_fanout(edges: DataFrame, limit: int | None = 20) -> DataFrame:
    """Distinct merchants per cardholder, widest first.

    ``edges`` holds cardholder_id and merchant_id per payment. Pairs are made
    distinct on both ids before they are counted, so a busy cardholder is
    spread over all tasks.
    """
    counts = edges.groupBy("cardholder_id").agg(F.count_distinct("merchant_id").alias("merchantCount"))
    top = counts.select(F.col("cardholder_id").alias("cardholder"), "merchantCount").orderBy(
        F.desc_nulls_first("merchantCount"), "cardholder")
    return top if limit is None else top.limit(limit)
