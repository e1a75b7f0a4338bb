import json

import pytest
from pyspark.sql import functions as F

from txflow.functions.events import check_messages
from txflow.plans.load import Stores
from txflow.schemas import EVENT_FIELDS, KAFKA_MESSAGE
from txflow.sinks import landing, publish, quarantine
from txflow.sources.messages import decode, replay_stream
from txflow.streaming.ingest import ingest_stream

GOOD = {
    "trans_num": "T-1", "trans_date_trans_time": "2026-02-17T09:05:00Z", "amt": 52.3, "is_fraud": 0,
    "category": "GROCERY", "channel": "POS", "city": "Austin", "state": "TX", "city_pop": 5000, "lat": 30.2,
    "long": -97.7, "dob": "1982-01-15", "job": "Engineer", "merch_lat": 30.267153, "merch_long": -97.743057,
}


def changed(drop=(), **values):
    return {k: v for k, v in {**GOOD, **values}.items() if k not in drop}


CASES = [
    ("ok", changed(), None, []),
    ("micros", changed(trans_date_trans_time="2026-02-17T09:05:00.000001Z"), None, []),
    ("lax", changed(amt="7.5", is_fraud=True, lat="30", city_pop="12", extra={"a": 1}), None, []),
    ("float int", changed(is_fraud=1.0), None, []),
    ("text int", changed(is_fraud="1.0"), None, []),
    ("no population", changed(drop=["city_pop"]), None, []),
    ("null population", changed(city_pop=None), None, []),
    ("amt text", changed(amt="not_a_number"), "ValidationError", ["amt"]),
    ("no key", changed(drop=["trans_num"]), "ValidationError", ["trans_num"]),
    ("geo", changed(lat="not_a_lat", long="bad"), "ValidationError", ["lat", "long"]),
    ("fraud", changed(is_fraud="maybe"), "ValidationError", ["is_fraud"]),
    ("multi", changed(amt="NaN", lat="abc", is_fraud="yes-maybe"), "ValidationError", ["amt", "is_fraud", "lat"]),
    ("null amt", changed(amt=None), "ValidationError", ["amt"]),
    ("suffix", changed(amt="12d"), "ValidationError", ["amt"]),
    ("infinite", changed(amt="1e999"), "ValidationError", ["amt"]),
    ("fraction", changed(is_fraud=1.5), "ValidationError", ["is_fraud"]),
    ("number as text field", changed(trans_num=5), "ValidationError", ["trans_num"]),
    ("bad population", changed(city_pop="many"), "ValidationError", ["city_pop"]),
    ("time", changed(trans_date_trans_time="not-a-date"), "InvalidTimestamp", ["trans_date_trans_time"]),
    ("zone", changed(trans_date_trans_time="2026-02-17T09:05:00+05:30"), "InvalidTimestamp", ["trans_date_trans_time"]),
    ("digits", changed(trans_date_trans_time="2026-99-99T99:99Z"), "SinkError", []),
    ("far", changed(merch_lat=1e18), "SinkError", []),
    ("far enough", changed(merch_long=-9e13), None, []),
    ("largest", changed(merch_long=1.7976931348623157e308), "SinkError", []),
    ("not json", "this is not json at all", "JSONDecodeError", []),
    ("array", [1, 2], "ValidationError", [n for n, _, req in EVENT_FIELDS if req]),
    ("scalar", "5", "ValidationError", [n for n, _, req in EVENT_FIELDS if req]),
    ("null body", None, "JSONDecodeError", []),
    ("bad bytes", b"\xff\xfe{}", "JSONDecodeError", []),
]


def message_frame(spark, cases=CASES):
    rows = []
    for i, (name, body, _, _) in enumerate(cases):
        if isinstance(body, (dict, list)):
            body = json.dumps(body)
        value = body.encode() if isinstance(body, str) else body
        rows.append((bytearray(name.encode()), value if value is None else bytearray(value), "t", i % 2, i, None, 0))
    return spark.createDataFrame(rows, KAFKA_MESSAGE).withColumn("timestamp", F.timestamp_millis(F.lit(1700000000123)))


def test_every_case(spark):
    out = check_messages(decode(message_frame(spark))).collect()
    found = {r.kafka_key: (r.error_type, list(r.failed_fields or [])) for r in out}
    assert found == {name: (error, fields) for name, _, error, fields in CASES}


def test_typed_values(spark):
    rows = {r.kafka_key: r for r in check_messages(decode(message_frame(spark))).collect()}
    lax = rows["lax"]
    assert (lax.amt, lax.is_fraud, lax.lat, lax.city_pop) == (7.5, 1, 30.0, 12)
    assert rows["micros"].ts.microsecond == 1 and rows["text int"].is_fraud == 1


def test_stream_lands_once_and_survives_restart(spark, folder):
    message_frame(spark).repartition(5).write.parquet(f"{folder}/topic")
    stores = Stores.under(folder)

    def run():
        stream = replay_stream(spark, f"{folder}/topic", files_per_batch=2)
        query = ingest_stream(stream, f"{folder}/checkpoint", stores, {"availableNow": True})
        query.awaitTermination()
        assert query.exception() is None

    run()
    run()
    good = landing.sightings(landing.read_landing(spark, stores.landing))
    bad = quarantine.envelope(quarantine.read(spark, stores.quarantine))
    first = good.count()
    assert first == sum(error is None for _, _, error, _ in CASES)
    assert {r.kafka_offset: r.error_type for r in bad.collect()} == {
        i: error for i, (_, _, error, _) in enumerate(CASES) if error}
    assert bad.count() == sum(error is not None for _, _, error, _ in CASES)

    # Later messages, a re-sent one among them, arrive after the restart.
    more = [("ok", changed(amt=60.0), None, []), ("new", changed(trans_num="T-2"), None, [])]
    message_frame(spark, more).write.mode("append").parquet(f"{folder}/topic")
    run()
    again = landing.sightings(landing.read_landing(spark, stores.landing))
    assert again.count() == first + 2 and again.where("trans_num = 'T-2'").count() == 1


def test_a_second_stream_leaves_the_first_alone(spark, folder):
    stores = Stores.under(folder)
    for i, name in enumerate(("T-1", "T-2")):
        message_frame(spark, [("k", changed(trans_num=name), None, []), ("bad", "no json", None, [])]).write.parquet(f"{folder}/topic{i}")
        stream = replay_stream(spark, f"{folder}/topic{i}")
        ingest_stream(stream, f"{folder}/checkpoint{i}", stores, {"availableNow": True}).awaitTermination()
    seen = landing.sightings(landing.read_landing(spark, stores.landing))
    assert {r.trans_num for r in seen.collect()} == {"T-1", "T-2"}
    assert quarantine.read(spark, stores.quarantine).count() == 2


def test_replayed_micro_batch_replaces_itself(spark, folder):
    from txflow.plans.load import stamp
    from txflow.streaming.ingest import write_micro_batch

    rows = check_messages(decode(message_frame(spark))).withColumn("ingested_at", stamp(None))
    stores = Stores.under(folder)
    for _ in range(2):
        write_micro_batch(rows, "q-3", stores)
    assert landing.read_landing(spark, stores.landing).count() == len(CASES)
    assert quarantine.read(spark, stores.quarantine).count() == sum(e is not None for _, _, e, _ in CASES)


def test_published_json_is_compact_and_sorted(spark):
    df = spark.createDataFrame([("k", 1.5, None)], "trans_num string, amt double, city string")
    row = publish.messages(df).first()
    assert (row.key, row.value) == ("k", '{"amt":1.5,"city":null,"trans_num":"k"}')


def test_kafka_needs_the_connector(spark):
    from txflow.sources.messages import kafka_stream

    with pytest.raises(Exception, match="kafka"):
        kafka_stream(spark, "localhost:9092", "t")
