"""Canonical batch records: field harmonisation, validation, outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions.casts import as_json, cast_failures, finite, lenient, names_where, number
from txflow.functions.ids import cardholder_id, merchant_id
from txflow.functions.timestamps import batch_text, parse_batch_text
from txflow.schemas import ALIASES, CANONICAL, CAST_CHECKED


def canonicalise(raw: DataFrame) -> DataFrame:
    """One column per canonical field: per row, the first spelling that holds a value.

    Fields absent everywhere become null columns; other columns are dropped.
    """
    def first_of(field: str) -> Column:
        present = [F.col(f"`{a}`") for a in ALIASES[field] if a in raw.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    passed = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in ("file", "unreadable")]
    return raw.select(*[first_of(f).alias(f) for f in CANONICAL], *passed)


#: Canonical field -> column of its typed value.
TYPED = {"amt": "amount", "lat": "lat_d", "long": "long_d", "latitude": "latitude_d", "longitude": "longitude_d",
         "city_pop": "city_pop_i", "is_fraud": "is_fraud_i"}


def validate(records: DataFrame) -> DataFrame:
    """Typed fields plus the outcome of every check.

    ``error_type`` is null for a clean record; ``failed_fields`` lists failed
    casts or, where all casts hold, every key field that is missing. Each step
    reads columns of the one before, so no cast or parse runs twice.
    """
    tried = records.select("*", *[(number(F.col(c)) if kind == "double" else lenient(F.col(c), kind)).alias(TYPED[c])
                                  for c, kind in CAST_CHECKED], batch_text(F.col("trans_date_trans_time")).alias("_when"))
    cast = tried.withColumns({TYPED[c]: finite(F.col(TYPED[c])) for c, kind in CAST_CHECKED if kind == "double"})
    parsed = cast.select("*", parse_batch_text(F.col("_when")).alias("ts"),
                         cast_failures(TYPED).alias("mismatch_cols")).drop("_when")
    missing = names_where([
        ("trans_date_trans_time", F.col("ts").isNull()),
        ("trans_num", F.col("trans_num").isNull()),
        ("amt", F.col("amount").isNull()),
    ])
    broken = F.col("unreadable").isNotNull()
    fields = (F.when(broken, F.array().cast("array<string>"))
              .when(F.size("mismatch_cols") > 0, F.col("mismatch_cols")).otherwise(missing))
    error = (F.when(broken, F.lit("JSONDecodeError"))
             .when(F.size("mismatch_cols") > 0, F.lit("CastMismatch"))
             .when(F.size("failed_fields") > 0, F.lit("MissingKey")))
    raw = (F.when(broken, F.col("unreadable"))
           .when(F.col("error_type").isNotNull(), as_json(*CANONICAL, "file")))
    judged = parsed.select("*", fields.alias("failed_fields")).select("*", error.alias("error_type"))
    return judged.select("*", raw.alias("raw_record"))


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_type").isNotNull())


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error_type").isNull())


def payload(validated: DataFrame, as_of: Column) -> DataFrame:
    """The clean records in the shape of the batch upsert."""
    return accepted(validated).select(
        F.col("trans_num").alias("transNum"),
        F.unix_seconds("ts").alias("tsEpoch"),
        "amount",
        F.col("is_fraud_i").alias("isFraud"),
        "city", "state",
        F.col("city_pop_i").alias("cityPop"),
        F.col("lat_d").alias("lat"),
        F.col("long_d").alias("long"),
        F.col("latitude_d").alias("latitude"),
        F.col("longitude_d").alias("longitude"),
        "file",
        F.lit("batch").alias("source"),
        as_of.alias("ingestedAt"),
    )


def batch_identities(validated: DataFrame) -> DataFrame:
    """Ids a batch record would have, had it come by stream (off by default)."""
    return validated.withColumns({
        "cardholder_id": cardholder_id(F.col("dob"), F.col("city"), F.col("state")),
        "merchant_id": merchant_id(F.col("latitude_d"), F.col("longitude_d"), F.col("city"), F.col("state")),
    })
