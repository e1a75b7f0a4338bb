"""Checks of one stream message, as column expressions over its JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions.casts import names_where
from txflow.functions.ids import has_text
from txflow.functions.timestamps import parse_stream, stream_shape_ok
from txflow.schemas import EVENT_FIELDS

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+(\.0*)?\s*$"
_NUMERIC_TYPES = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|STRING)"
_TYPE = {"str": "string", "float": "double", "int": "int"}


def _value(name: str) -> Column:
    return F.col(f"_s_{name}")


def _typed(name: str, kind: str) -> Column:
    """The field's value under its model type, null where it does not fit."""
    text, written = _value(name), F.col(f"_t_{name}")
    if kind == "str":
        return F.when(written == "STRING", text)
    as_bool = F.when(text == "true", 1).otherwise(0).cast(_TYPE[kind])
    if kind == "float":
        number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
        number = F.when(F.abs(number) < float("inf"), number)  # no NaN, no infinity
    else:
        digits = F.regexp_replace(F.trim(text), r"\.0*$", "")
        number = F.when(text.rlike(_WHOLE), digits.try_cast("int"))
    return F.when(written == "BOOLEAN", as_bool).when(written.rlike(_NUMERIC_TYPES), number)


def check_messages(messages: DataFrame) -> DataFrame:
    """Validate decoded messages (see ``sources.messages.decode``).

    Adds the typed fields, ``ts`` and, for a bad message, ``error_type``,
    ``error_detail`` and ``failed_fields``; the first failing stage names the
    error: JSONDecodeError, ValidationError, InvalidTimestamp, SinkError.
    """
    keep = messages.columns
    parsed = messages.withColumn("_v", F.try_parse_json("value"))
    parts = []
    for name, _, _ in EVENT_FIELDS:
        parts.append(F.schema_of_variant(F.try_variant_get("_v", f"$.{name}", "variant")).alias(f"_t_{name}"))
        parts.append(F.try_variant_get("_v", f"$.{name}", "string").alias(f"_s_{name}"))
    parsed = parsed.select(*keep, F.schema_of_variant("_v").alias("_shape"), *parts)
    typed = parsed.select(*keep, "_shape", *[F.col(f"_t_{n}") for n, _, _ in EVENT_FIELDS],
                          *[_typed(n, k).alias(n) for n, k, _ in EVENT_FIELDS])

    def bad(name: str, required: bool) -> Column:
        if required:
            return F.col(name).isNull()
        return F.col(name).isNull() & F.col(f"_t_{name}").isNotNull() & (F.col(f"_t_{name}") != "VOID")

    failed = names_where([(n, bad(n, req)) for n, _, req in EVENT_FIELDS])
    raw_ts = F.col("trans_date_trans_time")
    checked = typed.withColumn("failed_fields", failed).withColumn("ts", parse_stream(raw_ts))
    far = ~(has_text(F.col("merch_lat")) & has_text(F.col("merch_long")))
    error = (F.when(F.col("_shape").isNull(), F.lit("JSONDecodeError"))
             .when(F.size("failed_fields") > 0, F.lit("ValidationError"))
             .when(~stream_shape_ok(raw_ts), F.lit("InvalidTimestamp"))
             .when(F.col("ts").isNull() | far, F.lit("SinkError")))
    detail = (F.when(F.col("error_type") == "JSONDecodeError", F.lit("message body is not valid JSON"))
              .when(~F.col("_shape").startswith("OBJECT"), F.lit("message body is not an object"))
              .when(F.col("error_type") == "ValidationError",
                    F.concat(F.lit("missing or ill-typed: "), F.concat_ws(", ", "failed_fields")))
              .when(F.col("error_type") == "InvalidTimestamp",
                    F.concat(F.lit("trans_date_trans_time='"), raw_ts, F.lit("' is not an ISO-8601 UTC datetime")))
              .when((F.col("error_type") == "SinkError") & F.col("ts").isNotNull(),
                    F.lit("merch_lat or merch_long is out of range"))
              .when(F.col("error_type") == "SinkError",
                    F.concat(F.lit("trans_date_trans_time='"), raw_ts, F.lit("' is out of range"))))
    fields = (F.when(F.col("error_type") == "JSONDecodeError", F.array().cast("array<string>"))
              .when(F.col("error_type") == "InvalidTimestamp", F.array(F.lit("trans_date_trans_time")))
              .otherwise(F.array_distinct("failed_fields")))
    return (checked.withColumn("error_type", error).withColumn("error_detail", detail)
            .withColumn("failed_fields", fields)
            .drop("_shape", *[f"_t_{n}" for n, _, _ in EVENT_FIELDS]))
