"""Keeping one heavy key from deciding how long a job runs.

A key is *heavy* when it holds more than ``rows`` rows, however large the table:
what one task may get of an ordinary key is bounded. The list of heavy keys is
found by one combined count before a plan is built. Where it comes out empty,
the plan holds only the ordinary branch. Up to ``most`` keys are collected, and
tables with a row for each are broadcast; more stay a stored table, and joins
with them are shuffled. Either way the results are the same.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.session import scratch_dir


class Limits(NamedTuple):
    """When a key counts as heavy, and how many heavy keys may be collected."""

    rows: int = 1_000_000
    most: int = 100_000


class Heavy(NamedTuple):
    """Heavy values of one column: a table, or None; whether null is one; whether they are few enough to broadcast."""

    key: str
    keys: DataFrame | None
    nulls: bool
    few: bool = True

    def hint(self, table: DataFrame) -> DataFrame:
        """A table with a few rows for each heavy key, as the side of a join."""
        return F.broadcast(table) if self.few else table

    def held(self, table: DataFrame) -> DataFrame:
        """Compute such a table once; later steps start from its rows instead of repeating the plan behind it."""
        if self.few:
            return table.sparkSession.createDataFrame(table.collect(), table.schema)
        path = scratch_dir(table.sparkSession, "heavy")
        table.write.parquet(path)
        return table.sparkSession.read.schema(table.schema).parquet(path)


#: For a single group: the whole table under a constant key.
ONE = Heavy("_all", None, False)


DEFAULT = Limits()


def heavy_keys(df: DataFrame, key: str, limits: Limits = DEFAULT, weight: str | None = None) -> Heavy:
    """Count ``key`` (with ``weight`` a row stands for as many) and list its heavy values."""
    counts = df.groupBy(key).agg((F.count("*") if weight is None else F.sum(weight)).alias("_rows"))
    listed = counts.where(F.col("_rows") > limits.rows).select(key)
    found = listed.limit(limits.most + 1).collect()
    if len(found) > limits.most:
        table = Heavy(key, None, False, False).held(listed)
        nulls = not table.where(F.col(key).isNull()).isEmpty()
        return Heavy(key, table.where(F.col(key).isNotNull()), nulls, False)
    keys = [row for row in found if row[0] is not None]
    table = df.sparkSession.createDataFrame(keys, listed.schema) if keys else None
    return Heavy(key, table, len(keys) < len(found))


def split(df: DataFrame, heavy: Heavy) -> tuple[DataFrame | None, DataFrame]:
    """Rows of heavy keys (None if there are no such keys), and all others; no shuffle."""
    if heavy.keys is None:
        return None, df
    listed = heavy.hint(heavy.keys)
    return df.join(listed, heavy.key, "left_semi"), df.join(listed, heavy.key, "left_anti")


def stack(*frames: DataFrame | None) -> DataFrame:
    """Union by name of those frames that exist."""
    return reduce(DataFrame.unionByName, [f for f in frames if f is not None])


def lookup(left: DataFrame, right: DataFrame, heavy: Heavy, how: str = "left",
           right_many: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to the one matching row of ``right``, whatever the skew of ``left``.

    ``right`` holds at most one row per key; ``heavy`` is a list made from
    ``left`` or from a table ``left`` is a part of. Rows of heavy keys meet a
    broadcast of only those keys' rows (``right_many``, if those come from
    elsewhere), if the keys are few enough. The rest takes a shuffle
    join. Rows without a key match nothing; if they are many, they pass it by.
    """
    key = heavy.key
    extra = [f for f in right.schema.fields if f.name != key]
    columns = [*left.columns, *[f.name for f in extra]]
    keyless = None
    if how == "inner" or heavy.nulls:
        if how != "inner":
            keyless = (left.where(F.col(key).isNull())
                       .withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra}).select(*columns))
        left = left.where(F.col(key).isNotNull())
    many, few = split(left, heavy)
    if many is not None:
        if right_many is None:
            right_many = right.join(heavy.hint(heavy.keys), key, "left_semi")
        many = many.join(heavy.hint(right_many), key, how).select(*columns)
    return stack(many, few.join(right, key, how).select(*columns), keyless)


def grid_join(left: DataFrame, right: DataFrame, key: str, limits: Limits = DEFAULT) -> DataFrame:
    """Inner join of two tables that may both hold many rows of one key.

    All pairs of such a key are wanted, but no task should make them alone. A key
    with more than ``limits.rows`` rows on either side gets a grid: its left rows
    are dealt to grid lines and its right rows to grid columns, by their hashes,
    and each is repeated along the other direction. A cell then meets about
    ``limits.rows`` rows of each side, and every pair meets in one cell.
    """
    left, right = (df.where(F.col(key).isNotNull()) for df in (left, right))
    sizes = (left.groupBy(key).agg(F.count("*").alias("_l")).join(right.groupBy(key).agg(F.count("*").alias("_r")), key)
             .where(F.greatest("_l", "_r") > limits.rows)
             .select(key, *[F.ceil(F.col(n) / limits.rows).cast("int").alias(f"_of{n}") for n in ("_l", "_r")]))
    found = sizes.limit(limits.most + 1).collect()
    if not found:
        return left.join(right, key)
    if len(found) > limits.most:
        grids = Heavy(key, None, False, False).held(sizes)
    else:
        grids = left.sparkSession.createDataFrame(found, sizes.schema)
    heavy = Heavy(key, grids.select(key), False, len(found) <= limits.most)
    (many_l, few_l), (many_r, few_r) = split(left, heavy), split(right, heavy)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one line of its own direction and in all of the other."""
        columns = [c for c in df.columns if c != key]
        return (df.join(heavy.hint(grids), key)
                .withColumn(own, F.pmod(F.xxhash64(*columns), F.col(f"_of{own}")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"_of{other}") - 1)))
                .drop("_of_l", "_of_r"))

    cells = dealt(many_l, "_l", "_r").join(dealt(many_r, "_r", "_l"), [key, "_l", "_r"]).drop("_l", "_r")
    return cells.unionByName(few_l.join(few_r, key))
