"""Delivery by offset, stateful folds and event-time windows."""

import random

import pytest
from pyspark.sql import functions as F

from txflow.functions.events import check_messages
from txflow.operators import fold
from txflow.plans.load import Stores, stamp
from txflow.session import children
from txflow.sinks import landing, quarantine
from txflow.sinks.ledger import SCHEMA, Ledger, merge, runs
from txflow.sources.messages import decode
from txflow.streaming import ingest, state, windows

OFFSETS = "kafka_topic string, kafka_partition int, kafka_offset long"


def offsets(spark, *rows):
    return spark.createDataFrame([(t, p, o) for t, p, some in rows for o in some], OFFSETS)


def ranges(df):
    return sorted((r.kafka_topic, r.kafka_partition, r.first, r.last) for r in df.collect())


def test_runs_and_merged_ranges(spark):
    found = runs(offsets(spark, ("a", 0, [3, 1, 2, 2, 7, 9, 8]), ("a", 1, [1]), ("b", 0, range(2**20 - 2, 2**20 + 2))))
    assert ranges(merge(found)) == [("a", 0, 1, 3), ("a", 0, 7, 9), ("a", 1, 1, 1), ("b", 0, 2**20 - 2, 2**20 + 1)]
    some = spark.createDataFrame([("a", 0, f, l) for f, l in ((0, 9), (2, 3), (10, 12), (14, 15), (4, 11))], SCHEMA.removesuffix(", batch STRING"))
    assert ranges(merge(some)) == [("a", 0, 0, 12), ("a", 0, 14, 15)]


@pytest.mark.parametrize("limits", [{}, {"each": 0}])
def test_known_offsets_are_left_out(spark, folder, limits):
    ledger, known, pick = Ledger(spark, folder, **limits), set(), random.Random(1)
    for number in range(3):
        batch = [(pick.choice("ab"), pick.randint(0, 1), pick.randint(0, 40)) for _ in range(25)]
        rows = spark.createDataFrame([*batch, (None, 0, 3), ("a", 0, None)], OFFSETS)
        name = f"{'xy'[number % 2]}-{number // 2}"
        for _ in range(2):  # a batch that runs again finds its own offsets free
            fresh = ledger.unseen(rows, name)
            assert sorted(map(str, fresh.collect())) == sorted(
                str(r) for r in rows.collect() if r.kafka_topic is None or r.kafka_offset is None or tuple(r) not in known)
            ledger.enter(fresh, name)
        known |= set(batch)
    assert ledger.streams() == {"x": 1, "y": 0}
    assert len([n for n in children(spark, folder) if n.startswith("gen=")]) <= 2
    # Ranges of batches that can't run again are merged.
    for number in range(2, 5):
        ledger.enter(offsets(spark, ("a", 0, range(100 * number, 100 * number + 100))), f"x-{number}")
    kept = [r for r in ledger.ranges().collect() if r.kafka_topic == "a" and r.kafka_partition == 0 and r.first >= 200]
    assert sorted((r.first, r.last, r.batch) for r in kept) == [(200, 399, None), (400, 499, "x-4")]


def test_whole_ranges_close_gaps(spark, folder):
    ledger = Ledger(spark, folder)
    ledger.enter(offsets(spark, ("a", 0, [1, 5])), "x-0", whole=True)
    assert ranges(ledger.unseen(offsets(spark, ("a", 0, [0, 3, 6])), "y-0").withColumns(
        {"first": F.col("kafka_offset"), "last": F.col("kafka_offset")})) == [("a", 0, 0, 0), ("a", 0, 6, 6)]


def messages(spark, numbers):
    body = ('{"trans_num":"T%d","trans_date_trans_time":"2024-01-01T00:00:00Z","amt":1.5,"is_fraud":0,"category":"c","channel":"POS",'
            '"city":"x","state":"CO","lat":1.5,"long":2.5,"merch_lat":3.5,"merch_long":4.5,"dob":"d","job":"j"}')
    raw = spark.createDataFrame([(body % n if n % 5 else "no json", n) for n in numbers], "body string, offset long").select(
        F.lit("k").cast("binary").alias("key"), F.col("body").cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
    return check_messages(decode(raw)).withColumn("ingested_at", stamp(None))


def test_a_batch_that_was_stopped_is_found_by_a_new_stream(spark, folder, monkeypatch):
    stores = Stores.under(folder)
    ingest.write_micro_batch(messages(spark, range(10)), "x-0", stores)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "enter", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            ingest.write_micro_batch(messages(spark, range(10, 20)), "x-1", stores)
    ingest.write_micro_batch(messages(spark, range(25)), "y-0", stores)  # another checkpoint, from the beginning
    landed = landing.read_landing(spark, stores.landing)
    assert sorted(r.kafka_offset for r in landed.collect()) == list(range(25))
    assert quarantine.read(spark, stores.quarantine).count() == 5


def test_a_micro_batch_reads_no_other_load(spark, folder, monkeypatch):
    from txflow.sinks.store import GraphStore

    stores = Stores.under(folder, graph=True)
    GraphStore(spark, stores.graph, buckets=2).buckets
    for name in ("state", "merged", "stats", "graph"):
        monkeypatch.setattr(GraphStore, name, lambda *a, **k: pytest.fail("history was read"))
    ingest.write_micro_batch(messages(spark, range(10)), "x-0", stores)
    ingest.write_micro_batch(messages(spark, range(5, 15)), "x-1", stores)
    monkeypatch.undo()
    assert sorted(GraphStore(spark, stores.graph).loads()) == ["x-0", "x-1"]
    # What a stream delivers a second time is no second sighting.
    transactions = GraphStore(spark, stores.graph).graph().transactions.collect()
    assert {r.trans_num for r in transactions} == {f"T{n}" for n in range(15) if n % 5}
    assert all(r.updated_at is None for r in transactions)


def seen(spark, numbers):
    return spark.createDataFrame([(n, f"T{n % 7}", "batch" if n % 3 else "kafka") for n in numbers], "seq long, trans_num string, source string").selectExpr(
        "*", "timestamp_seconds(seq) as ts", "timestamp_seconds(seq) as ingested_at", "cast(seq as double) as amount", "concat('c', seq) as category",
        "'p' as channel", "concat('x', seq) as city", "'y' as state", "0 as is_fraud", "1 as city_pop", "'j' as job", "'f' as file",
        *[f"0d as {c}" for c in ("lat", "long", "latitude", "longitude", "cardholder_lat", "cardholder_long", "merchant_lat", "merchant_long")])


def test_fold_goes_on_after_a_restart(spark, folder):
    assert state.folded(spark, f"{folder}/states") is None
    for numbers in (range(20, 30), [3, 50], [], range(0, 60, 2)):
        rows = seen(spark, numbers)
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        state.fold_stream(stream, f"{folder}/checkpoint", f"{folder}/states", {"availableNow": True}).awaitTermination()
    once = fold.fold_state(spark.read.schema(rows.schema).parquet(f"{folder}/in"))
    assert sorted(map(str, state.folded(spark, f"{folder}/states").select(once.columns).collect())) == sorted(map(str, once.collect()))


def test_late_payments_are_kept_aside(spark, folder):
    schema, now = "cardholder_id string, ts timestamp, amount double", {"availableNow": True}
    parts = [[("a", 0), ("a", 60), ("b", 7200)], [("a", 3599), ("b", 3600), ("a", 7260), ("a", None), ("b", 20000)], [("a", 16399), ("c", 16400)]]
    for part in parts:
        rows = spark.createDataFrame(part, "cardholder_id string, s long").select(
            "cardholder_id", F.timestamp_seconds("s").alias("ts"), F.lit(1.0).alias("amount"))
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        windows.deal(stream, f"{folder}/dealing", f"{folder}/dealt", 3600, now).awaitTermination()
        counts = windows.velocity_windows(windows.ontime(spark, f"{folder}/dealt", schema), slide="10 minutes")
        windows.append(counts, f"{folder}/counting", f"{folder}/out", now).awaitTermination()
        bursts = windows.burst_sessions(windows.ontime(spark, f"{folder}/dealt", schema), least=2)
        windows.append(bursts, f"{folder}/bursting", f"{folder}/bursts", now).awaitTermination()
    late = windows.late(spark, f"{folder}/dealt", schema).select("cardholder_id", F.unix_seconds("ts")).collect()
    assert sorted(map(tuple, late), key=str) == [("a", 16399), ("a", 3599), ("a", None)]
    out = spark.read.schema(counts.schema).parquet(f"{folder}/out")
    assert sorted(tuple(r) for r in out.select("cardholder_id", F.unix_seconds("begins"), "n").collect()) == [
        ("a", 0, 2), ("a", 7200, 1), ("b", 3600, 1), ("b", 7200, 1)]
    runs_found = spark.read.schema(bursts.schema).parquet(f"{folder}/bursts").select("cardholder_id", F.unix_seconds("begins"), F.unix_seconds("ends"), "n")
    assert [tuple(r) for r in runs_found.collect()] == [("a", 0, 660, 2)]


def test_messages_are_checked_once_and_landed_once(spark, folder, monkeypatch):
    from txflow.sources.messages import replay_stream

    def raw(numbers):
        return spark.createDataFrame([("no json", n) for n in numbers], "body string, offset long").select(
            F.lit("k").cast("binary").alias("key"), F.col("body").cast("binary").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))

    stores, checked = Stores.under(folder), []

    def check(rows):
        checked.append(sorted(r.kafka_offset for r in rows.collect()))
        return check_messages(rows)

    monkeypatch.setattr(ingest, "check_messages", check)
    for name, numbers in (("first", range(10)), ("second", range(14))):
        raw(numbers).coalesce(1).write.parquet(f"{folder}/{name}")
        ingest.ingest_stream(replay_stream(spark, f"{folder}/{name}"), f"{folder}/checkpoint-{name}", stores, {"availableNow": True}).awaitTermination()
    assert checked == [list(range(10)), list(range(10, 14)), list(range(10))]
    assert sorted(r.kafka_offset for r in landing.read_landing(spark, stores.landing).collect()) == list(range(14))
