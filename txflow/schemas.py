"""Fixed values of the data model and the table schemas built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: must equal the established input contract ----------------

# Canonical batch field -> accepted spellings, the canonical one first.
ALIASES: dict[str, list[str]] = {
    "trans_date_trans_time": ["trans_date_trans_time", "trans_date", "transaction_datetime", "trans_date_time"],
    "trans_num": ["trans_num", "transNum", "transaction_id"],
    "amt": ["amt", "amount", "txn_amount"],
    "city_pop": ["city_pop", "cityPop", "city_population"],
    "is_fraud": ["is_fraud", "isFraud"],
    "Client Name": ["Client Name", "client_name", "customer_name"],
    "transaction type": ["transaction type", "category", "txn_category"],
    "job": ["job", "occupation"],
    "dob": ["dob", "date_of_birth"],
    "lat": ["lat"],
    "long": ["long"],
    "latitude": ["latitude"],
    "longitude": ["longitude"],
    "city": ["city"],
    "state": ["state"],
}

# Column order of a canonical batch record.
CANONICAL = [
    "trans_date_trans_time", "Client Name", "transaction type", "amt", "city", "state", "lat", "long",
    "city_pop", "job", "dob", "trans_num", "latitude", "longitude", "is_fraud",
]

# Fields whose text must survive a cast, with the type it is cast to.
CAST_CHECKED = [
    ("amt", "double"), ("lat", "double"), ("long", "double"), ("latitude", "double"),
    ("longitude", "double"), ("city_pop", "int"), ("is_fraud", "flag"),
]

TRUE_WORDS = ["true", "yes", "y", "t", "1"]
FALSE_WORDS = ["false", "no", "n", "f", "0"]

# Stream message fields in model order: (name, kind, required).
EVENT_FIELDS = [
    ("trans_num", "str", True), ("trans_date_trans_time", "str", True), ("amt", "float", True),
    ("is_fraud", "int", True), ("category", "str", True), ("channel", "str", True),
    ("city", "str", True), ("state", "str", True), ("city_pop", "int", False),
    ("lat", "float", True), ("long", "float", True), ("dob", "str", True), ("job", "str", True),
    ("merch_lat", "float", True), ("merch_long", "float", True),
]

# File name patterns per format.
CSV_GLOB = "*.{csv,csv.gz,csv.gzip}"
JSONL_GLOB = "*.{jsonl,ndjson,jsonl.gz,ndjson.gz}"
JSON_GLOB = "*.{json,json.gz}"

# --- end of fixed values ----------------------------------------------------

#: Every spelling a reader has to look for.
KNOWN_NAMES = [name for names in ALIASES.values() for name in names]

_KINDS = {"str": T.StringType(), "float": T.DoubleType(), "int": T.IntegerType()}

EVENT_SCHEMA = T.StructType([T.StructField(n, _KINDS[k], not req) for n, k, req in EVENT_FIELDS])

CANONICAL_RAW = T.StructType([T.StructField(n, T.StringType()) for n in [*CANONICAL, "file"]])


_TYPES = {
    "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "INT": T.IntegerType(), "LONG": T.LongType(),
    "BINARY": T.BinaryType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    "TEXTS": T.ArrayType(T.StringType()),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name TYPE, …``; needs no running session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BATCH_PAYLOAD = _struct(
    "transNum STRING, tsEpoch LONG, amount DOUBLE, isFraud INT, city STRING, state STRING, cityPop INT,"
    "lat DOUBLE, long DOUBLE, latitude DOUBLE, longitude DOUBLE, file STRING, source STRING, ingestedAt TIMESTAMP"
)

#: Shape of a message source, as the Kafka connector delivers it.
KAFKA_MESSAGE = _struct(
    "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP, timestampType INT"
)

#: Order of sightings: ingest time, then position in the source, then content.
SEQ = _struct("at TIMESTAMP, part INT, pos LONG, tie LONG")

#: Columns of an accepted record, whichever way it arrived.
SIGHTING = T.StructType([*_struct(
    "trans_num STRING, ts TIMESTAMP, amount DOUBLE, is_fraud INT, category STRING, channel STRING,"
    "city STRING, state STRING, city_pop INT, lat DOUBLE, long DOUBLE, latitude DOUBLE, longitude DOUBLE,"
    "cardholder_lat DOUBLE, cardholder_long DOUBLE, merchant_lat DOUBLE, merchant_long DOUBLE,"
    "job STRING, dob STRING, cardholder_id STRING, merchant_id STRING, file STRING,"
    "kafka_topic STRING, kafka_partition INT, kafka_offset LONG, ingested_at TIMESTAMP"
).fields, T.StructField("seq", SEQ)])

#: What a rejected record adds.
REJECT = _struct(
    "raw_record STRING, raw_value STRING, error_type STRING, error_detail STRING, failed_fields TEXTS,"
    "kafka_key STRING, kafka_timestamp LONG"
)

#: One row per record received; partitioned by the last four columns.
LANDING_PARTITIONS = ["source", "batch_id", "ingest_date", "rejected"]
LANDING = T.StructType(
    [*SIGHTING.fields, *REJECT.fields, *_struct("source STRING, batch_id STRING, ingest_date DATE, rejected BOOLEAN").fields]
)

#: One row per rejected record; partitioned by source, ingest_date and batch_id.
QUARANTINE_PARTITIONS = ["source", "ingest_date", "batch_id"]
QUARANTINE = _struct(
    "raw_record STRING, raw_value STRING, error_type STRING, error_detail STRING, failed_fields TEXTS,"
    "file STRING, kafka_topic STRING, kafka_partition INT, kafka_offset LONG, kafka_key STRING,"
    "kafka_timestamp LONG, ingested_at TIMESTAMP, source STRING, ingest_date DATE, batch_id STRING"
)
