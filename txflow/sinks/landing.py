"""The landing table: one row per record received, accepted or not.

A load or micro-batch is parsed once and written once, into its own folder
``source=…/batch_id=…``; a repeated attempt overwrites that folder, so replays
leave no duplicates. Sightings and quarantine are then narrow reads of it, the
``rejected`` partition telling them apart, and a day's records those of its
``ingest_date``. ``compact`` gathers the folders of many micro-batches.
"""

from __future__ import annotations

import json
import re
from itertools import count as count_from

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions.ids import cardholder_id, merchant_id
from txflow.schemas import LANDING, LANDING_PARTITIONS, REJECT, SIGHTING
from txflow.session import below, children, read_text, remove, write_text

_ROW_GROUP = 16 << 20
_PLAIN = [f for f in LANDING.fields if f.name not in (*LANDING_PARTITIONS, "seq")]


def _shape(rows: DataFrame, values: dict[str, Column], source: str, at: Column,
           part: Column, pos: Column) -> DataFrame:
    """Project to the landing columns; anything not in ``values`` is null."""
    plain = rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _PLAIN])
    # The tie-breaker makes the order of sightings total without a sort.
    tie = F.xxhash64(*[f.name for f in _PLAIN if f.name != "ingested_at"])
    seq = F.struct(at.alias("at"), part.cast("int").alias("part"), pos.cast("long").alias("pos"), tie.alias("tie"))
    return (plain.withColumn("seq", seq.cast(SIGHTING["seq"].dataType))
            .withColumn("source", F.lit(source))
            .withColumn("ingest_date", F.to_date(at))
            .withColumn("rejected", F.col("error_type").isNotNull()))


def from_batch(validated: DataFrame, as_of: Column) -> DataFrame:
    """Validated batch records as landing rows; ids only if they were derived."""
    c = F.col
    values = {n: c(n) for n in (
        "trans_num", "ts", "amount", "city", "state", "job", "dob", "file", "raw_record", "error_type",
        "failed_fields")}
    values |= {
        "is_fraud": c("is_fraud_i"), "category": c("transaction type"), "city_pop": c("city_pop_i"),
        "lat": c("lat_d"), "long": c("long_d"), "latitude": c("latitude_d"), "longitude": c("longitude_d"),
        "error_detail": F.when(c("error_type").isNotNull(), F.concat_ws(", ", c("failed_fields"))),
        "ingested_at": as_of,
    }
    values |= {n: c(n) for n in ("cardholder_id", "merchant_id") if n in validated.columns}
    return _shape(validated, values, "batch", as_of, F.lit(0), F.lit(0))


def from_stream(checked: DataFrame, as_of: Column) -> DataFrame:
    """Checked messages as landing rows with hashed ids."""
    c = F.col
    good = c("error_type").isNull()
    values = {n: c(n) for n in (
        "trans_num", "ts", "is_fraud", "category", "channel", "city", "state", "city_pop", "job", "dob",
        "kafka_topic", "kafka_partition", "kafka_offset", "error_type", "error_detail", "failed_fields",
        "kafka_key", "kafka_timestamp")}
    values |= {
        "amount": c("amt"), "cardholder_lat": c("lat"), "cardholder_long": c("long"),
        "merchant_lat": c("merch_lat"), "merchant_long": c("merch_long"),
        "cardholder_id": F.when(good, cardholder_id(c("dob"), c("city"), c("state"))),
        "merchant_id": F.when(good, merchant_id(c("merch_lat"), c("merch_long"), c("city"), c("state"))),
        "raw_value": F.when(~good, c("raw_value")),
        "ingested_at": as_of,
    }
    return _shape(checked, values, "kafka", as_of, c("kafka_partition"), c("kafka_offset"))


def write_batch(rows: DataFrame, path: str, source: str, batch_id: str, writers: int | None = None) -> None:
    """Replace one batch of the landing table. ``writers`` limits the parallel writers.

    With such a limit all tasks write first, to a folder beside the batches; the
    few writers then copy from there. A shuffle of the rows would take three
    times the disk. Their files have small row groups, so that many tasks can read
    them. Sorted by outcome, a task fills one file after the other.
    """
    spark, batch = rows.sparkSession, f"source={source}/batch_id={batch_id}"
    rows, staged = rows.drop("source").sortWithinPartitions("rejected"), f"{path.rstrip('/')}/_staged/{batch}"
    try:
        if writers:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(staged)
            rows = spark.read.schema(rows.schema).parquet(staged).coalesce(writers)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
         .options(**{"parquet.block.size": _ROW_GROUP} if writers else {})
         .partitionBy("ingest_date", "rejected").parquet(f"{path.rstrip('/')}/{batch}"))
    finally:
        if writers:
            remove(spark, staged)


def read_landing(spark: SparkSession, path: str, source: str = "*", batch_id: str = "*") -> DataFrame:
    """The table, or one batch of it without listing the others."""
    folder = f"{path.rstrip('/')}/source={source}/batch_id={batch_id}"
    try:
        return spark.read.schema(LANDING).option("basePath", path).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], LANDING)
        raise


def compact(spark: SparkSession, path: str, source: str, into: str, prefix: str) -> int:
    """Gather the batches whose id begins with ``prefix`` in one batch; returns how many there were.

    It is called ``into``, or ``into.2`` and so on where earlier calls have made
    that. Which files of which batches it holds is noted under ``_gathered``
    before it is written, and only folders with no other files are removed, once
    the gathered rows are complete. Stopped in between, a second call ends the
    work. Batches still being written are left for a later call. A batch written
    again after it was gathered, and an ``into`` that is no gathered batch, are
    refused. Not for batches that may still be replayed.
    """
    base = path.rstrip("/")
    folder, notes = f"{base}/source={source}", f"{base}/_gathered/source={source}"
    names = [n.removeprefix("batch_id=") for n in children(spark, folder) if n.startswith("batch_id=")]
    noted = {n for n in children(spark, notes) if not n.startswith(".")}
    # A note whose batch is not complete is one of a call that was stopped: nothing was removed for it.
    whole = [n for n in names if n in noted and _files(spark, f"{folder}/batch_id={n}")[0]]
    held: dict[str, set[str]] = {}
    for gathered in whole:
        for name, files in json.loads(read_text(spark, f"{notes}/{gathered}")).items():
            held.setdefault(name, set()).update(files)
    series = {n for n in noted if n == into or re.fullmatch(re.escape(into) + r"\.\d+", n)}
    count, again, old = 0, [], {}
    for name in names:
        mine = name.startswith(prefix) and name != into and name not in series
        if not mine and name not in held:
            continue
        complete, files = _files(spark, f"{folder}/batch_id={name}")
        if name in held:
            if files <= held[name] and (files or complete):
                remove(spark, f"{folder}/batch_id={name}")
                count += mine
            elif mine and files:
                again.append(name)
        elif complete:
            old[name] = sorted(files)
    if again:
        raise ValueError(f"batches written again after they were gathered: {', '.join(sorted(again)[:5])}")
    if not old:
        return count
    if into in names and into not in noted:
        raise ValueError(f"batch {into} is there already and was not gathered by this function")
    taken = {*whole, *held, *(n for n in names if n not in noted)}
    target = next(n for n in (into if i == 1 else f"{into}.{i}" for i in count_from(1)) if n not in taken)
    rows = spark.read.schema(LANDING).option("basePath", base).parquet(*[f"{folder}/batch_id={n}" for n in old])
    write_text(spark, f"{notes}/{target}", json.dumps(old))
    write_batch(rows.drop("batch_id").hint("rebalance"), path, source, target)
    for name, files in old.items():
        if _files(spark, f"{folder}/batch_id={name}") == (True, set(files)):
            remove(spark, f"{folder}/batch_id={name}")
            count += 1
    return count


def _files(spark: SparkSession, folder: str) -> tuple[bool, set[str]]:
    """Whether a batch is complete, and its files; Spark gives those of every write names of their own."""
    found = below(spark, folder)
    return "_SUCCESS" in found, {f for f in found if not any(part.startswith(("_", ".")) for part in f.split("/"))}


def sightings(landing: DataFrame) -> DataFrame:
    """Accepted records: the system of record for everything downstream."""
    return landing.where(~F.col("rejected")).drop("rejected", "batch_id", *REJECT.names)
