"""Amount anomalies: robust deviation from a cascade of baselines, plus velocity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions.timestamps import iso_utc
from txflow.operators.quantiles import mad_halves, median_and_mad
from txflow.operators.rolling import velocity_by_clock, velocity_by_window
from txflow.skew import DEFAULT, Heavy, Limits, heavy_keys, lookup, split, stack


def amount_anomalies(
    tx: DataFrame,
    baseline_tx: DataFrame | None = None,
    card_tx: DataFrame | None = None,
    *,
    since: str | None = None,
    min_card: int = 5,
    min_cat: int = 30,
    floor: float = 0.25,
    eps: float = 1e-9,
    cap: float = 25.0,
    weights: tuple[float, float] = (0.7, 0.3),
    velocity_seconds: int = 600,
    limit: int | None = 100,
    mode: str = "intent",
    limits: Limits = DEFAULT,
    weight: str | None = None,
    sizes: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Score every payment against its cardholder, category or global baseline.

    ``tx``: payments with trans_num, ts, amount, category, cardholder_id,
    merchant_id. ``baseline_tx``: transactions behind the category and global
    baselines (default: ``tx`` once per transaction). ``card_tx``: transactions
    per cardholder (default: ``tx`` once per cardholder and transaction).
    ``since`` narrows what is scored, not the baselines. ``mode="as_written"``
    drops payments whose cardholder or category lacks support instead of
    falling back. With ``weight`` both baseline tables hold amounts (beside category
    or cardholder_id) and, in that column, how often they occur; ``sizes`` then may
    tell by category and by cardholder_id how many rows (column ``rows``) ``tx`` and
    these tables hold, which otherwise takes a pass over ``tx`` for each.
    """
    tx = tx.select("trans_num", "ts", "cardholder_id", "merchant_id", "category",
                   F.col("amount").cast("double").alias("amount")).where(F.col("cardholder_id").isNotNull())
    own = card_tx if card_tx is not None else tx.dropDuplicates(["cardholder_id", "trans_num"])
    shared = baseline_tx if baseline_tx is not None else tx.dropDuplicates(["trans_num"])
    how = "left" if mode == "intent" else "inner"

    # Category values join before the shuffle by cardholder, cardholder values after it,
    # so velocity and the cardholder join share that one shuffle.
    # Amounts that are counted tell little of how many payments share a key.
    def heavy_of(key: str, plain: DataFrame, counted: DataFrame, size: int) -> Heavy:
        if weight is None:
            return heavy_keys(plain, key, limits)
        return heavy_keys(_keys(key, tx, counted), key, limits) if sizes is None else heavy_keys(sizes[size], key, limits, "rows")

    heavy = heavy_of("category", shared, shared, 0)
    many, few = mad_halves(shared, "amount", heavy, min_cat, weight)
    rows = lookup(tx, _named(few, "cat"), heavy, right_many=many and _named(many, "cat"))

    heavy = heavy_of("cardholder_id", tx, own, 1)
    base_many, base_few = mad_halves(own, "amount", heavy, min_card, weight)
    many, few = split(rows, heavy)
    rows = velocity_by_window(few, velocity_seconds, "tx_last_10m").join(
        _named(base_few, "ch"), "cardholder_id", how)
    if many is not None:
        many = velocity_by_clock(many, velocity_seconds, "tx_last_10m").join(
            heavy.hint(_named(base_many, "ch")), "cardholder_id", how)  # one row per heavy key
        rows = stack(rows, many)
    if mode != "intent":
        rows = rows.where(F.col("cat_n").isNotNull())
    if since is not None:
        rows = rows.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    overall = median_and_mad(shared, None, "amount", limits=limits, weight=weight)
    rows = rows.join(F.broadcast(_named(overall, "g")), how="left")  # one row, or none without amounts

    scored = rows.select("*", *_scores(min_card, min_cat, floor, eps, cap))
    blend = weights[0] * F.col("mad_score") + weights[1] * F.col("tx_last_10m").cast("double")
    result = scored.select(
        "trans_num",
        iso_utc(F.col("ts")).alias("ts"),
        F.col("cardholder_id").alias("cardholder"),
        F.col("merchant_id").alias("merchant"),
        "category",
        "amount",
        "baseline_used",
        F.round("mad_score", 2).alias("amount_anomaly_score"),
        "tx_last_10m",
        F.round(blend, 2).alias("combined_score"),
        F.col("mad_score").alias("raw_score"),
    )
    if limit is None:
        return result
    return result.orderBy(F.desc_nulls_first("combined_score"), F.desc_nulls_first("amount_anomaly_score"),
                          "trans_num", "merchant").limit(limit)


def _keys(key: str, *tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [table.select(key) for table in tables])


def _named(table: DataFrame, name: str) -> DataFrame:
    return table.withColumnsRenamed({"n": f"{name}_n", "med": f"{name}_med", "mad": f"{name}_mad"})


def _scores(min_card: int, min_cat: int, floor: float, eps: float, cap: float) -> list[Column]:
    """The baseline chosen and the capped deviation from it."""
    own, shared = F.col("ch_n") >= min_card, F.col("cat_n") >= min_cat

    def choose(a: Column, b: Column, c: Column) -> Column:
        return F.when(own, a).when(shared, b).otherwise(c)

    center = choose(F.col("ch_med"), F.col("cat_med"), F.col("g_med"))
    mad = choose(F.col("ch_mad"), F.col("cat_mad"), F.col("g_mad"))
    unit = F.when(mad.isNull() | (mad == 0), eps).when(mad < floor, floor).otherwise(mad)
    raw = F.abs(F.col("amount") - center) / unit
    return [choose(F.lit("cardholder"), F.lit("category"), F.lit("global")).alias("baseline_used"),
            F.when(raw > cap, cap).otherwise(raw).alias("mad_score")]
