"""The payment graph, stored in buckets of its keys and updated load by load.

Each load adds what its own sightings fold to, in a partition of its own, dealt
to the same buckets as everything before it. States merge in any order, and
all states of a key lie in one bucket: a table is one aggregation over the base
and the loads since, without a shuffle, and tables bucketed by the same key join
without one. Running a load again replaces its partition. ``compact`` merges
everything into the base of a next generation, which is then read as it is.
One writer at a time.

The tables are external tables of the session's catalog, named after their
path; any session declares them again over the same files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.operators import fold
from txflow.operators.graph import Graph
from txflow.session import children, read_text, write_text


class Part(NamedTuple):
    """How a table is made of sightings, merged, and shown; the key it is bucketed by."""

    of: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    rows: Callable[[DataFrame], DataFrame]
    key: str


PARTS = {
    "transactions": Part(fold.fold_state, fold.merge_transactions, fold.transactions, fold.KEY),
    "cardholders": Part(fold.cardholder_state, fold.merge_cardholders, fold.cardholder_rows, "cardholder_id"),
    "merchants": Part(fold.merchant_state, fold.merge_merchants, fold.merchant_rows, "merchant_id"),
    "performed": Part(fold.performed, DataFrame.distinct, lambda edges: edges, fold.KEY),
    "at_merchant": Part(fold.at_merchant, DataFrame.distinct, lambda edges: edges, fold.KEY),
}
_BASE = "base"


def _text(value: str) -> str:
    """As SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class GraphStore:
    """Tables under ``path``: ``gen=<number>/<table>/load=<id>``, each in ``buckets`` buckets.

    The number of buckets is fixed by whoever writes first; a bucket should fit
    a task.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path = spark, path.rstrip("/")
        self._wanted = buckets

    @property
    def buckets(self) -> int:
        note = f"{self.path}/buckets"
        if "buckets" not in children(self.spark, self.path):
            write_text(self.spark, note, str(self._wanted))
        return int(read_text(self.spark, note))

    def generation(self) -> int:
        """The newest generation that was completed; 0 needs no base."""
        done = [int(name.split("=")[1]) for name in children(self.spark, self.path)
                if name.startswith("gen=") and "_SUCCESS" in children(self.spark, f"{self.path}/{name}/complete")]
        return max(done, default=0)

    def _folder(self, table: str, generation: int | None = None) -> str:
        return f"{self.path}/gen={self.generation() if generation is None else generation}/{table}"

    def loads(self, table: str = "transactions") -> list[str]:
        """The partitions of a table; the base is one of them."""
        return [unquote(name.split("=", 1)[1]) for name in children(self.spark, self._folder(table)) if name.startswith("load=")]

    def _declare(self, folder: str, key: str, rows: DataFrame | None = None) -> str:
        """The catalog's name for a table, whose columns are those of ``rows`` or of its files."""
        name = f"txflow_{hashlib.md5(folder.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            schema = (self.spark.read.parquet(folder) if rows is None else rows).drop("load").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            # The type of ``load`` is stated: ids like 01 or 1.0 stay what they are.
            self.spark.sql(f"CREATE TABLE {name} ({columns}, load STRING) USING parquet PARTITIONED BY (load) "
                           f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION {_text(folder)}")
            if self.spark.conf.get("spark.sql.catalogImplementation") == "hive":  # others list the folders
                self.spark.catalog.recoverPartitions(name)
        return name

    def _write(self, rows: DataFrame, folder: str, load: str, key: str) -> None:
        """Replace one load; each task writes one bucket."""
        name, view = self._declare(folder, key, rows), f"load_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, key).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (load = {_text(load)}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def _all(self, write: Callable[[str, Part], None]) -> None:
        """Write the tables at the same time: none of these jobs keeps a cluster busy to its end."""
        run = inheritable_thread_target(self.spark)(write)
        with ThreadPoolExecutor(len(PARTS)) as pool:
            for done in [pool.submit(run, table, part) for table, part in PARTS.items()]:
                done.result()

    def state(self, table: str) -> DataFrame | None:
        """All states of a table with the ``load`` they are from, not merged; None before the first load."""
        if not self.loads(table):
            return None
        name = self._declare(self._folder(table), PARTS[table].key)
        self.spark.catalog.refreshTable(name)  # another session may have written since
        return self.spark.table(name)

    def merged(self, table: str) -> DataFrame:
        """One state per key."""
        states = self.state(table).drop("load")
        return states if self.loads(table) == [_BASE] else PARTS[table].merge(states)

    def apply(self, sightings: DataFrame, load: str) -> None:
        """Add one load. What it costs depends on the load, not on what is stored."""
        if load == _BASE:
            raise ValueError(f"a load can't be called {_BASE}")
        if self.holds(load):
            raise ValueError(f"load {load} is part of the base and can't be replaced any more")
        folders, _ = {table: self._folder(table) for table in PARTS}, self.buckets
        self._all(lambda table, part: self._write(part.of(sightings), folders[table], load, part.key))

    def holds(self, load: str) -> bool:
        """Whether a load was merged into the base."""
        now = self.generation()
        return now > 0 and not self.spark.read.schema("load STRING").parquet(
            f"{self.path}/gen={now}/complete").where(F.col("load") == load).isEmpty()

    def stats(self, load: str) -> dict[str, int]:
        """How many record numbers a load holds, created and updated; created are those whose first sighting it holds.

        Reads the number and first sighting of every record stored, without a shuffle.
        """
        seen = self.state("transactions").select(fold.KEY, "load", F.col("first.seq").alias("_seq"))
        mine = F.col("load") == load
        both = seen.groupBy(fold.KEY).agg(F.min(F.when(mine, F.col("_seq"))).alias("_mine"),
                                          F.min(F.when(~mine, F.col("_seq"))).alias("_theirs"))
        created = F.col("_theirs").isNull() | (F.col("_mine") < F.col("_theirs"))
        row = both.where(F.col("_mine").isNotNull()).agg(F.count("*").alias("total"), F.count_if(created).alias("created")).first()
        return {"total": row.total, "created": row.created, "updated": row.total - row.created}

    def graph(self) -> Graph:
        """The merged tables."""
        return Graph(**{table: part.rows(self.merged(table)) for table, part in PARTS.items()})

    def compact(self) -> None:
        """Merge base and loads into a new generation; the old one stays until it is removed."""
        now = self.generation()
        loads = self.spark.createDataFrame([(name,) for name in self.loads() if name != _BASE], "load STRING")
        if now:
            loads = loads.unionByName(self.spark.read.schema("load STRING").parquet(f"{self.path}/gen={now}/complete"))
        self._all(lambda table, part: self._write(self.merged(table), self._folder(table, now + 1), _BASE, part.key))
        # Written last: a generation without it is not read.
        loads.write.mode("overwrite").parquet(f"{self.path}/gen={now + 1}/complete")
