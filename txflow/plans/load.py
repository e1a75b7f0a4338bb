"""The batch load: files to landing rows, quarantine and load statistics."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txflow.operators import canonical
from txflow.sinks import landing, quarantine
from txflow.sinks.rollup import Rollups
from txflow.sinks.store import GraphStore
from txflow.sources import files


class Stores(NamedTuple):
    """Where the tables live: shared storage every executor reaches."""

    landing: str
    quarantine: str
    graph: str | None = None  # None: loads don't update a stored graph
    ledger: str | None = None  # None: a stream that starts anew lands its messages again
    rollups: str | None = None  # None: loads leave no counts for reports

    @classmethod
    def under(cls, base: str, graph: bool = False, rollups: bool = False) -> Stores:
        base = base.rstrip("/")
        return cls(f"{base}/landing", f"{base}/quarantine", f"{base}/graph" if graph else None, f"{base}/ledger",
                   f"{base}/rollups" if rollups else None)


def stamp(as_of: datetime | None) -> Column:
    """One ingest time for a whole batch, so that all sinks agree."""
    moment = datetime.now(timezone.utc) if as_of is None else as_of
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(round(moment.timestamp() * 1_000_000)))


def validated_files(spark: SparkSession, path: str, include_ids: bool = False, on_error: str = "raise") -> DataFrame:
    """Every record under ``path``, canonical, typed and judged."""
    rows = canonical.validate(canonical.canonicalise(files.read_all(spark, path, on_error=on_error)))
    return canonical.batch_identities(rows) if include_ids else rows


def load_batch(spark: SparkSession, path: str, as_of: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean payload, quarantine rows) of the files under ``path``, nothing written."""
    # Filters stay above a metric. Below it they would run all the casts and parses that they test a second time.
    rows = validated_files(spark, path).observe("load preview", F.count("*").alias("records"))
    at = stamp(as_of)
    rejects = landing.from_batch(rows, at).withColumn("batch_id", F.lit("preview"))
    return canonical.payload(rows, at), quarantine.from_landing(rejects)


def sample(clean: DataFrame, rows: int = 1) -> DataFrame:
    """A few payload rows for a log line, the same ones each time."""
    return clean.orderBy("transNum", "tsEpoch").limit(rows)


def run_load(spark: SparkSession, path: str, stores: Stores, load_id: str, as_of: datetime | None = None,
             include_ids: bool = False, writers: int | None = None, on_error: str = "raise") -> dict[str, int]:
    """Load files into the stores; returns how many records came in and were refused.

    With a stored graph also how many record numbers the load holds (total),
    created and updated there.

    Input is scanned and parsed once. The landing write takes every record;
    quarantine is then exported from its rejected partition alone. Running the
    same ``load_id`` again replaces what it wrote, also on another day and also
    if nothing is refused any more. A CSV file that can't be read stops the load
    (``on_error="skip"``: a warning names it).
    """
    rows = landing.from_batch(validated_files(spark, path, include_ids, on_error), stamp(as_of))
    counted = Observation(f"load {load_id}")
    rows = rows.observe(counted, F.count("*").alias("records"), F.count_if("rejected").alias("rejected"))
    landing.write_batch(rows, stores.landing, "batch", load_id, writers)
    written = landing.read_landing(spark, stores.landing, "batch", load_id)
    counts = dict(counted.get)
    quarantine.replace(quarantine.from_landing(written), stores.quarantine, "batch", load_id, counts["rejected"])
    if stores.rollups:
        Rollups(spark, stores.rollups).add(landing.sightings(written), quarantine.from_landing(written), load_id)
    if stores.graph:
        store = GraphStore(spark, stores.graph)
        store.apply(landing.sightings(written), load_id)
        counts |= store.stats(load_id)
    return counts
