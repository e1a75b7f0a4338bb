"""Exact interpolated quantiles, per key or over a whole table.

Ordinary keys use Spark's ``percentile``. A heavy key (or the whole table as
one group) would end as one value map in one task, so its ranks are found by
narrowing instead: values are counted per coarse cell, the cell holding the
wanted rank is kept, its values are counted per finer cell, and so on down to
the value. Each step is a combined aggregation over at most a few thousand
cells per key; no step gathers a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from txflow.skew import DEFAULT, ONE, Heavy, Limits, heavy_keys, split, stack

#: Cells per unit of log1p(|value|): first 0.1 %, then one in a million wide.
_CELLS = (1e3, 1e6)
_ALL = "_all"


def quantiles(df: DataFrame, key: str | None, value: str, probs: Sequence[float] = (0.5,),
              limits: Limits = DEFAULT) -> DataFrame:
    """``key, n, q`` with ``q[i]`` the linearly interpolated quantile ``probs[i]``.

    Null, NaN and infinite values are ignored, as are rows without a key, and
    -0.0 is 0.0, whichever way a group takes. ``key=None`` treats the whole table
    as one group and returns ``n, q``.
    """
    rows = _numbers(df, key, value)
    if key is None:
        way = by_percentile if _is_small(rows, limits) else by_narrowing
        return way(rows, _ALL, probs).drop(_ALL)
    heavy = heavy_keys(rows, key, limits)
    many, few = split(rows, heavy)
    return stack(by_percentile(few, key, probs), many and by_narrowing(many, key, probs, heavy))


def _numbers(df: DataFrame, key: str | None, value: str, weight: str | None = None) -> DataFrame:
    """The group, the value ``_v`` and, for rows that stand for several, their number ``_w``."""
    group = F.lit(0).alias(_ALL) if key is None else F.col(key)
    count = [] if weight is None else [F.col(weight).alias("_w")]
    rows = df.select(group, (F.col(value).cast("double") + F.lit(0.0)).alias("_v"), *count)
    return rows.where(F.col(key or _ALL).isNotNull() & (F.abs("_v") < float("inf")))


def _is_small(rows: DataFrame, limits: Limits) -> bool:
    return rows.count() <= limits.rows


def by_percentile(rows: DataFrame, key: str, probs: Sequence[float]) -> DataFrame:
    """For groups of bounded size."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.percentile("_v", list(probs)).alias("q"))


def by_narrowing(rows: DataFrame, key: str, probs: Sequence[float], heavy: Heavy = ONE) -> DataFrame:
    """For groups of any size, a few or those of ``heavy`` keys; ``rows`` holds ``key``, ``_v`` and maybe ``_w``.

    Cells are counted straight from the rows, so a task passes on at most one
    row per key and cell; the values themselves are only counted within the
    cells that hold a wanted rank. Between steps only those ranks travel: two per
    key and probability.
    """
    place = F.signum("_v") * F.log1p(F.abs("_v"))
    levels = [f"_cell{i}" for i in range(len(_CELLS))]
    counted = rows.withColumns({c: F.floor(place * scale).cast("long") for c, scale in zip(levels, _CELLS, strict=True)})
    if "_w" not in rows.columns:
        counted = counted.withColumn("_w", F.lit(1))
    position = [F.lit(p) * (F.col("n") - 1) for p in probs]
    ends = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), end(x).cast("long").alias("rank"))
                     for i, x in enumerate(position) for side, end in enumerate((F.floor, F.ceil))])

    coarse = W.Window.partitionBy(key)
    cells = (counted.groupBy(key, levels[0]).agg(F.sum("_w").alias("_in"))
             .withColumn("n", F.sum("_in").over(coarse))
             .withColumn("_to", F.sum("_in").over(_upto(coarse, levels[0]))))
    wanted = _holding(cells.select("*", F.inline(ends)))
    rank = [key, "n", "i", "side", "rank"]
    for depth, cell in enumerate([*levels[1:], "_v"], start=1):
        here = [key, *levels[:depth]]
        cells = (counted.join(heavy.hint(wanted), here)
                 .groupBy(*rank, *levels[:depth], cell).agg(F.sum("_w").alias("_in")))
        within = W.Window.partitionBy(key, "i", "side")
        wanted = _holding(cells.withColumn("_to", F.sum("_in").over(_upto(within, cell))))

    def at(i: int, side: int) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col("_v"))).alias(f"_{i}_{side}")

    found = wanted.groupBy(key, "n").agg(*[at(i, s) for i in range(len(probs)) for s in (0, 1)])
    blends = []
    for i, x in enumerate(position):
        low, high = F.col(f"_{i}_0"), F.col(f"_{i}_1")
        share = x - F.floor(x)
        blends.append(F.when(low == high, low).otherwise((1 - share) * low + share * high))
    return found.select(key, "n", F.array(*blends).alias("q"))


def _upto(window: W.WindowSpec, cell: str) -> W.WindowSpec:
    return window.orderBy(cell).rowsBetween(W.Window.unboundedPreceding, 0)


def _holding(cells: DataFrame) -> DataFrame:
    """The cells that hold a wanted rank, the rank now counted from the cell's start."""
    start = F.col("_to") - F.col("_in")
    return (cells.where((F.col("rank") >= start) & (F.col("rank") < F.col("_to")))
            .withColumn("rank", F.col("rank") - start).drop("_in", "_to"))


def median_and_mad(df: DataFrame, key: str | None, value: str, min_n: int = 1,
                   limits: Limits = DEFAULT, weight: str | None = None) -> DataFrame:
    """``key, n, med, mad``: median and median absolute deviation, groups of at least ``min_n``.

    With ``weight`` a row stands for as many as that column says (at least one).
    """
    if key is None:
        rows = _numbers(df, None, value, weight)
        way = _direct_mad if _is_small(rows, limits) else _narrowed_mad
        return way(rows, _ALL, min_n).drop(_ALL)
    many, few = mad_halves(df, value, heavy_keys(df, key, limits), min_n, weight)
    return stack(few, many)


def mad_halves(df: DataFrame, value: str, heavy: Heavy, min_n: int = 1,
               weight: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """``median_and_mad`` of the heavy keys (None if there are none), and of all others."""
    many, few = split(_numbers(df, heavy.key, value, weight), heavy)
    return many and _narrowed_mad(many, heavy.key, min_n, heavy), _direct_mad(few, heavy.key, min_n)


def _direct_mad(rows: DataFrame, key: str, min_n: int) -> DataFrame:
    """For groups of bounded size: one shuffle serves both passes and the join between them."""
    weighted = "_w" in rows.columns
    count, times = (F.sum("_w"), F.col("_w")) if weighted else (F.count("*"), F.lit(1))
    rows = rows.repartition(key)
    center = (rows.groupBy(key).agg(count.alias("n"), F.percentile("_v", 0.5, times).alias("med"))
              .where(F.col("n") >= min_n))
    return (rows.join(center, key).groupBy(key)
            .agg(F.max("n").alias("n"), F.max("med").alias("med"),
                 F.percentile(F.abs(F.col("_v") - F.col("med")), 0.5, times).alias("mad")))


def _narrowed_mad(rows: DataFrame, key: str, min_n: int, heavy: Heavy = ONE) -> DataFrame:
    """For groups of any size, a few or those of ``heavy`` keys."""
    center = heavy.held(by_narrowing(rows, key, (0.5,), heavy).where(F.col("n") >= min_n)
                        .select(key, "n", F.col("q")[0].alias("med")))
    off = rows.join(heavy.hint(center), key).withColumn("_v", F.abs(F.col("_v") - F.col("med"))).drop("n", "med")
    mad = by_narrowing(off, key, (0.5,), heavy).select(key, F.col("q")[0].alias("mad"))
    return mad.join(heavy.hint(center), key).select(key, "n", "med", "mad")
