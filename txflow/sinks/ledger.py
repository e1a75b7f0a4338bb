"""Which offsets of a topic have been landed, so that no message is landed twice.

A stream that starts anew reads its topics from the beginning. The ledger holds
ranges of offsets per topic and partition; a micro-batch leaves out what other
batches have landed, lands the rest and then enters it. A topic that was made
anew has other messages at the same offsets: ``streaming.ingest`` compares those
that meet a range with what was landed. A batch that runs again
may write its own range again, so the last batch of every stream is kept apart
until the next one is entered; all others are merged, and what is read and
written for a batch does not grow with the batches before it.

One table, replaced generation by generation. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txflow.session import children, read_text, remove, write_text

_PLACE = ["kafka_topic", "kafka_partition"]
SCHEMA = "kafka_topic STRING, kafka_partition INT, first LONG, last LONG, batch STRING"
#: Up to so many ranges are sent to all tasks, of at most so many to one partition of a topic.
FEW, EACH = 100_000, 1_000
#: Offsets in whose blocks runs are found; a partition of a topic is no bound of what a task sorts.
_BLOCK = 1 << 20


class Ledger:
    """Ranges under ``path``: ``gen=<number>``. A range without a ``batch`` belongs to earlier ones.

    Batches are called ``<stream>-<number>``; a stream's numbers rise.
    """

    def __init__(self, spark: SparkSession, path: str, few: int = FEW, each: int = EACH):
        self.spark, self.path, self.few, self.each = spark, path.rstrip("/"), few, each

    def _generations(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in children(self.spark, self.path)
                      if name.startswith("gen=") and "_SUCCESS" in children(self.spark, f"{self.path}/{name}"))

    def ranges(self) -> DataFrame:
        now = self._generations()
        if not now:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/gen={now[-1]}")

    def streams(self) -> dict[str, int]:
        """The number of the last batch that was entered, per stream."""
        folder = f"{self.path}/streams"
        return {name: int(read_text(self.spark, f"{folder}/{name}")) for name in children(self.spark, folder)
                if not name.startswith(".")}

    def unseen(self, rows: DataFrame, batch: str) -> DataFrame:
        """``rows`` without those whose offsets other batches have landed; a row without an offset is never left out."""
        return self._met(rows, batch, "left_anti") or rows

    def seen(self, rows: DataFrame, batch: str) -> DataFrame | None:
        """The others: ``rows`` at offsets that other batches have landed. None if there are no such offsets at all."""
        return self._met(rows, batch, "left_semi")

    def _met(self, rows: DataFrame, batch: str, how: str) -> DataFrame | None:
        if not self._generations():
            return None
        known = self.ranges().where(~F.col("batch").eqNullSafe(F.lit(batch)))
        sizes = known.groupBy(*_PLACE).count().agg(F.sum("count").alias("all"), F.max("count").alias("most")).first()
        if not sizes["all"]:
            return None
        if sizes["all"] <= self.few and sizes["most"] <= self.each:
            k = known.select(*[F.col(c).alias(f"_{c}") for c in _PLACE], "first", "last")
            inside = F.col("kafka_offset").between(F.col("first"), F.col("last"))
            for name in _PLACE:
                inside &= F.col(name) == F.col(f"_{name}")
            return rows.join(F.broadcast(k), inside, how)
        return _beyond(rows, merge(known), how)

    def enter(self, landed: DataFrame, batch: str, whole: bool = False) -> None:
        """Note the offsets of ``landed`` as those of ``batch``, after they were written.

        ``whole``: the batch holds everything there is between its first and its
        last offset of a partition, as batches of Kafka do; offsets that don't
        exist are then no gaps. Otherwise runs of offsets are entered as they are.
        """
        offsets = landed.select(*_PLACE, "kafka_offset").where(F.col("kafka_offset").isNotNull())
        if whole:
            mine = offsets.groupBy(*_PLACE).agg(F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"))
        else:
            mine = runs(offsets)
        stream = batch.rpartition("-")[0]
        earlier = F.col("batch").isNull() | (F.col("batch").startswith(f"{stream}-") & (F.col("batch") != batch))
        all_ranges = self.ranges()
        others = all_ranges.where(F.col("batch").isNotNull() & ~earlier & (F.col("batch") != batch))
        settled = merge(all_ranges.where(earlier)).withColumn("batch", F.lit(None).cast("string"))
        now = self._generations()
        new = settled.unionByName(others).unionByName(mine.withColumn("batch", F.lit(batch)))
        (new.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{self.path}/gen={(now or [0])[-1] + 1}"))
        write_text(self.spark, f"{self.path}/streams/{stream}", batch.rpartition("-")[2])
        for old in now[:-1]:  # the one before stays for those who are reading it
            remove(self.spark, f"{self.path}/gen={old}")


def runs(offsets: DataFrame) -> DataFrame:
    """Ranges of consecutive ``kafka_offset`` per topic and partition, cut at multiples of _BLOCK."""
    block = F.shiftright("kafka_offset", _BLOCK.bit_length() - 1).alias("_block")
    order = Window.partitionBy(*_PLACE, "_block").orderBy("kafka_offset")
    numbered = offsets.select(*_PLACE, "kafka_offset", block).withColumn(
        "_run", F.col("kafka_offset") - F.dense_rank().over(order))
    return (numbered.groupBy(*_PLACE, "_block", "_run")
            .agg(F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last")).drop("_block", "_run"))


def merge(ranges: DataFrame) -> DataFrame:
    """Ranges that touch or overlap as one."""
    order = Window.partitionBy(*_PLACE).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select(*_PLACE, "first", "last").withColumn(
        "_new", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
    numbered = starts.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*_PLACE, "_group").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_group")


def _beyond(rows: DataFrame, known: DataFrame, how: str = "left_anti") -> DataFrame:
    """Rows outside all ranges (or, with ``left_semi``, inside), whatever their number: each row looks back to the last range that begins before it.

    Only offsets are sorted; the rows are then joined to those found.
    """
    def side(df: DataFrame, at: str, last: Column) -> DataFrame:
        return df.select(*_PLACE, F.col(at).alias("_at"), last.alias("_last"))

    order = Window.partitionBy(*_PLACE).orderBy("_at", F.col("_last").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    offsets = side(rows.where(F.col("kafka_offset").isNotNull()), "kafka_offset", F.lit(None).cast("long"))
    both = side(known, "first", F.col("last")).unionByName(offsets)
    back = both.withColumn("_reach", F.last("_last", ignorenulls=True).over(order))
    seen = (back.where(F.col("_last").isNull() & (F.col("_reach") >= F.col("_at")))
            .select(*[F.col(c).alias(f"_{c}") for c in _PLACE], "_at").distinct())
    same = F.col("kafka_offset") == F.col("_at")
    for name in _PLACE:
        same &= F.col(name) == F.col(f"_{name}")
    return rows.join(seen, same, how)
