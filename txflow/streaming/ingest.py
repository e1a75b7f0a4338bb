"""Continuous ingest of message streams."""

from __future__ import annotations

from concurrent.futures import Future
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txflow.functions.events import check_messages
from txflow.plans.load import Stores, stamp
from txflow.session import children
from txflow.sinks import landing, quarantine
from txflow.sinks.ledger import Ledger
from txflow.sinks.rollup import Rollups
from txflow.sinks.store import GraphStore
from txflow.sources.messages import decode


def ingest_stream(messages: DataFrame, checkpoint: str, stores: Stores, trigger: dict | None = None,
                  as_of: datetime | None = None, whole_ranges: bool = False) -> StreamingQuery:
    """Route a Kafka-shaped stream into landing and quarantine.

    Both writes of a micro-batch end before its offsets are committed. The time
    of a micro-batch is fixed in the checkpoint when it is planned, so a replay
    carries the same ingest time and replaces its own partition: a restart
    neither loses nor repeats records. A batch is known by the query's id, which
    lasts as long as its checkpoint, and its number, so streams may share stores.
    Nothing is dropped for being late. A message whose offset other batches have
    landed is left out (``sinks.ledger``), so a stream may start anew from the
    beginning of its topic with another checkpoint; unless a message of the batch
    differs from the one landed at its offset, which tells of a topic made anew. ``whole_ranges`` says that a
    batch holds all there is between its offsets, as those of Kafka do.
    ``trigger`` defaults to one-second batches; pass ``{"availableNow": True}``
    to drain and stop.
    """
    at = F.current_timestamp() if as_of is None else stamp(as_of)
    rows = decode(messages).withColumn("ingested_at", at)

    query_id: Future[str] = Future()

    def store(batch: DataFrame, batch_id: int) -> None:
        write_micro_batch(batch, f"{query_id.result()}-{batch_id}", stores, whole_ranges)

    query = (rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": "1 second"})).start())
    query_id.set_result(query.id)
    return query


def write_micro_batch(messages: DataFrame, batch_id: str, stores: Stores, whole_ranges: bool = False) -> None:
    """Land one micro-batch, export its rejects, update the stored graph and the ledger; safe to repeat.

    Neither reads what other batches have written, but for the ledger's ranges and,
    where messages meet these, what was landed of them.
    ``messages`` are decoded, and checked here if they aren't yet: once, and by
    all tasks, however few files or partitions they come from.
    """
    spark = messages.sparkSession
    ledger = Ledger(spark, stores.ledger) if stores.ledger else None
    if ledger:
        settle(spark, ledger, stores, batch_id)
        rows = _landing_rows(ledger.unseen(messages, batch_id))
        again = ledger.seen(messages, batch_id)
        if again is not None and not again.isEmpty():
            again = _landing_rows(again)
            # Another message at the offset of a landed one: the topic was made anew, and nothing of it was landed.
            anew = _unlanded(again, stores, batch_id).select("kafka_topic").distinct()
            if not anew.isEmpty():
                rows = rows.unionByName(again.join(F.broadcast(anew), "kafka_topic", "left_semi"))
    else:
        rows = _landing_rows(messages)
    landing.write_batch(rows, stores.landing, "kafka", batch_id)
    written = landing.read_landing(spark, stores.landing, "kafka", batch_id)
    quarantine.replace(quarantine.from_landing(written), stores.quarantine, "kafka", batch_id)
    if stores.graph:
        store = GraphStore(spark, stores.graph)
        if not store.holds(batch_id):  # a replay after compaction
            store.apply(landing.sightings(written), batch_id)
    if stores.rollups:
        Rollups(spark, stores.rollups).add(landing.sightings(written), quarantine.from_landing(written), batch_id)
    if ledger:
        # Last: a batch that was stopped before has no entry, and is found by its folder.
        ledger.enter(written, batch_id, whole_ranges)


def _landing_rows(messages: DataFrame) -> DataFrame:
    checked = messages if "error_type" in messages.columns else check_messages(messages.hint("rebalance"))
    return landing.from_stream(checked, F.col("ingested_at"))


def _unlanded(rows: DataFrame, stores: Stores, batch_id: str) -> DataFrame:
    """``rows`` without those that another batch has landed with the same content (``seq.tie`` is a hash of it)."""
    def place(df: DataFrame) -> DataFrame:
        return df.select("kafka_topic", "kafka_partition", "kafka_offset", F.col("seq.tie").alias("_tie"))

    landed = place(landing.read_landing(rows.sparkSession, stores.landing, "kafka").where(F.col("batch_id") != batch_id))
    return rows.withColumn("_tie", F.col("seq.tie")).join(landed, landed.columns, "left_anti").select(*rows.columns)


def settle(spark: SparkSession, ledger: Ledger, stores: Stores, batch_id: str) -> None:
    """Enter batches of other streams that were landed and then stopped before they were entered.

    Looked for with the first batch of a stream, by the names of folders; a
    stream's batches up to the last one entered need no look.
    """
    stream, entered = batch_id.rpartition("-")[0], ledger.streams()
    if stream in entered:
        return
    for name in children(spark, f"{stores.landing}/source=kafka"):
        batch = name.removeprefix("batch_id=")
        other, _, number = batch.rpartition("-")
        if not name.startswith("batch_id=") or other == stream or not number.isdigit() or int(number) <= entered.get(other, -1):
            continue
        if "_SUCCESS" in children(spark, f"{stores.landing}/source=kafka/{name}"):
            ledger.enter(landing.read_landing(spark, stores.landing, "kafka", batch), batch)


def recent_unique(sightings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Stream with repeats of a record number dropped while they are at most ``delay`` apart."""
    return sightings.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["trans_num"])
