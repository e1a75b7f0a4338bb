"""Quantiles and distinct counts that merge: sketches of bounded size, in place of values.

An exact quantile or distinct count over many days needs the days' values again;
sketches of days or loads are stored and merged instead. The exact operators
(``quantiles``, ``recon``, ``graph``) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch, and the rank error that 99 of 100 estimates keep at that size (2.296 / K^0.9723).
K, RANK_ERROR = 400, 0.0068
#: log2 of the registers of a distinct count; its relative error is about 1.04 / sqrt(2^LOG_REGISTERS).
LOG_REGISTERS = 12


def lag_sketches(lags: DataFrame, *keys: str) -> DataFrame:
    """A quantile sketch of ``ingestLagSeconds`` for each combination of ``keys``."""
    return lags.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col("ingestLagSeconds").cast("double"), K).alias("lag"))


def lag_quantiles(sketches: DataFrame, *keys: str, probs: Sequence[float] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """n and the estimated quantiles of merged sketches, a column each (``p50`` and so on)."""
    one = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("lag").alias("lag"))
    return one.select(*keys, F.kll_sketch_get_n_double("lag").alias("n"),
                      *[F.kll_sketch_get_quantile_double("lag", F.lit(float(p))).alias(f"p{p * 100:g}") for p in probs])


def fanout_sketches(edges: DataFrame, *keys: str) -> DataFrame:
    """A distinct count of merchants for each cardholder and combination of ``keys``."""
    return edges.groupBy("cardholder_id", *keys).agg(F.hll_sketch_agg("merchant_id", LOG_REGISTERS).alias("merchants"))


def fanout(sketches: DataFrame) -> DataFrame:
    """Distinct merchants per cardholder over all sketches, estimated."""
    return sketches.groupBy(F.col("cardholder_id").alias("cardholder")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("merchants")).alias("merchantCount"))


def number_sketches(sightings: DataFrame, *keys: str) -> DataFrame:
    """Sketches of the record numbers of each source, from which numbers of one source only are estimated."""
    def of(kind: str):
        return F.theta_sketch_agg(F.when(F.col("source") == kind, F.col("trans_num")), F.lit(LOG_REGISTERS)).alias(kind)

    return sightings.groupBy(*keys).agg(of("batch"), of("kafka"))


def only_counts(sketches: DataFrame) -> DataFrame:
    """One row: numbers in batch only, in the stream only, and in both, estimated."""
    one = sketches.agg(F.theta_union_agg("batch").alias("batch"), F.theta_union_agg("kafka").alias("kafka"))
    return one.select(F.theta_sketch_estimate(F.theta_difference("batch", "kafka")).alias("batchOnly"),
                      F.theta_sketch_estimate(F.theta_difference("kafka", "batch")).alias("streamOnly"),
                      F.theta_sketch_estimate(F.theta_intersection("batch", "kafka")).alias("both"))


def day_sketches(sightings: DataFrame, lags: DataFrame, day: str) -> DataFrame:
    """Per day, sketches of the lags and of all merchants; a day without stream records has no lags."""
    merchants = sightings.groupBy(day).agg(
        F.hll_sketch_agg(F.col("merchant_id") if "merchant_id" in sightings.columns else F.lit(None).cast("string"),
                         LOG_REGISTERS).alias("merchants"))
    return merchants.join(lag_sketches(lags, day), day, "left").select(day, "lag", "merchants")


def merged(rows: DataFrame) -> DataFrame:
    """The union of ``day_sketches``, as one row."""
    return rows.agg(F.kll_merge_agg_double("lag").alias("lag"), F.hll_union_agg("merchants").alias("merchants"))
