"""Bursts of small payments by one cardholder across merchants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from txflow.operators.rolling import company_by_clock, company_by_window
from txflow.skew import DEFAULT, Heavy, Limits, heavy_keys, split, stack

def _card() -> W.WindowSpec:
    return W.Window.partitionBy("cardholder_id")


def burst_members(tx: DataFrame, *, max_amount: float = 5, seconds: int = 600, mode: str = "intent",
                  limits: Limits = DEFAULT) -> DataFrame:
    """cardholder_id, trans_num, ts of every small payment that is part of a suspicious pair.

    ``mode="as_written"``: the time condition there holds for one order of any
    two payments, so any second merchant of the same cardholder suffices.
    """
    many, few, _ = _members(tx, max_amount, seconds, mode, limits)
    return stack(few, many)


def burst_rows(tx: DataFrame, *, max_amount: float = 5, seconds: int = 600, min_size: int = 3, mode: str = "intent",
               per_burst: bool = False, limits: Limits = DEFAULT) -> DataFrame:
    """cardholder, trans_num, burstCount of every suspicious payment: one row each, whatever their number.

    ``per_burst`` counts every run of payments without a longer pause than
    ``seconds`` on its own and adds its start as ``burstStart``.
    """
    many, few, heavy = _members(tx, max_amount, seconds, mode, limits)
    if per_burst:
        rows = _runs(stack(few, many), seconds)
    else:
        few = few.withColumn("burstCount", F.count("*").over(_card()))
        if many is not None:
            sizes = many.groupBy("cardholder_id").agg(F.count("*").alias("burstCount"))
            many = many.join(heavy.hint(sizes), "cardholder_id")  # one row per heavy key
        rows = stack(few, many)
    start = ["burstStart"] if per_burst else []
    return rows.where(F.col("burstCount") >= min_size).select(
        F.col("cardholder_id").alias("cardholder"), *start, "trans_num", "burstCount")


def short_bursts(tx: DataFrame, *, per_burst: bool = False, **options) -> DataFrame:
    """cardholder, suspiciousTransactions (sorted), burstCount: ``burst_rows`` with the ids of a burst as one list.

    A list is one value of one row; where a burst may have more ids than a task
    can hold, take the rows.
    """
    keys = ["cardholder", *(["burstStart"] if per_burst else [])]
    return (burst_rows(tx, per_burst=per_burst, **options).groupBy(*keys, "burstCount")
            .agg(F.sort_array(F.collect_list("trans_num")).alias("suspiciousTransactions"))
            .select(*keys, "suspiciousTransactions", "burstCount"))


def _members(tx: DataFrame, max_amount: float, seconds: int, mode: str,
             limits: Limits) -> tuple[DataFrame | None, DataFrame, Heavy]:
    """Suspicious payments of heavy cardholders (None if there are none), and of all others; who is heavy."""
    small = (tx.where(F.col("amount") <= max_amount)
             .where(F.col("ts").isNotNull() & F.col("cardholder_id").isNotNull())
             .select("cardholder_id", "trans_num", "merchant_id", "ts"))
    heavy = heavy_keys(small, "cardholder_id", limits)
    many, few = split(small, heavy)
    if mode == "intent":
        few = company_by_window(few, seconds)
        many = many and company_by_clock(many, seconds)
    else:
        few = few.select("*", *_extremes(lambda c: c.over(_card()))).where(_VARIED)
        if many is not None:
            varied = many.groupBy("cardholder_id").agg(*_extremes(lambda c: c)).where(_VARIED)
            many = many.join(heavy.hint(varied), "cardholder_id", "left_semi")  # one row per heavy key
    once = ("cardholder_id", "trans_num", "ts")
    return many and many.select(*once).distinct(), few.select(*once).distinct(), heavy


def _extremes(over) -> list[Column]:
    return [over(f(c)).alias(f"_{f.__name__}_{c}") for c in ("merchant_id", "trans_num") for f in (F.min, F.max)]


_VARIED = "_min_merchant_id <> _max_merchant_id AND _min_trans_num <> _max_trans_num"


def _runs(members: DataFrame, seconds: int) -> DataFrame:
    """Adds the start and the size of each payment's run.

    Payments within one clock slot as long as the allowed pause belong to one
    run, so runs are found among slots: a window over a cardholder holds one row
    per slot, however many payments there are.
    """
    pause = (seconds + 1) * 1_000_000
    rows = members.withColumn("_us", F.unix_micros("ts")).withColumn("_slot", F.floor(F.col("_us") / pause))
    slots = rows.groupBy("cardholder_id", "_slot").agg(
        F.min("_us").alias("_from"), F.max("_us").alias("_to"), F.count("*").alias("_n"))
    line = _card().orderBy("_slot")
    opens = F.when(F.col("_from") - F.lag("_to").over(line) < pause, None).otherwise(F.col("_from"))
    slots = slots.withColumn("_open", opens).withColumn("_run", F.last("_open", ignorenulls=True).over(
        line.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)))
    sizes = slots.groupBy("cardholder_id", "_run").agg(F.sum("_n").alias("burstCount"))
    known = slots.select("cardholder_id", "_slot", "_run").join(sizes, ["cardholder_id", "_run"])
    return (rows.join(known, ["cardholder_id", "_slot"])
            .withColumn("burstStart", F.timestamp_micros("_run")))
