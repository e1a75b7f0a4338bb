"""Counting and comparing within a moving time span, per key.

Ordinary keys use window functions whose frames only ever grow, so the cost is
linear even where one key's events are dense. Heavy keys are cut by the clock:
events are combined per instant and per second, so no task sees more than one
second of instants or one span of seconds of any key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from txflow.skew import DEFAULT, Limits, heavy_keys, split, stack

_SECOND = 1_000_000
_BEGIN = W.Window.unboundedPreceding
Merge = Callable[[Column], Column]


def velocity(tx: DataFrame, seconds: int = 600, limits: Limits = DEFAULT, out: str = "tx_last_10m") -> DataFrame:
    """Adds how many of the cardholder's transactions fall in ``(ts - seconds, ts]``.

    Needs cardholder_id, trans_num, merchant_id and ts. A transaction is counted
    once however many merchants it is linked to; one without a time counts nothing,
    and so does one without a cardholder.
    """
    known = tx.where(F.col("cardholder_id").isNotNull())
    unknown = tx.where(F.col("cardholder_id").isNull()).withColumn(out, F.lit(0).cast("long"))
    many, few = split(known, heavy_keys(known, "cardholder_id", limits))
    return stack(velocity_by_window(few, seconds, out), many and velocity_by_clock(many, seconds, out), unknown)


def velocity_by_window(tx: DataFrame, seconds: int, out: str) -> DataFrame:
    """For cardholders of bounded size: difference of two running counts."""
    columns = tx.columns
    rows = tx.withColumn("_us", F.unix_micros("ts")).repartition("cardholder_id")
    same = W.Window.partitionBy("cardholder_id", "_us", "trans_num").orderBy("merchant_id")
    line = W.Window.partitionBy("cardholder_id").orderBy("_us")
    one = F.when(F.col("_us").isNotNull() & (F.row_number().over(same) == 1), 1).otherwise(0)
    rows = rows.withColumn("_one", one)
    upto = F.sum("_one").over(line.rangeBetween(_BEGIN, 0))
    before = F.coalesce(F.sum("_one").over(line.rangeBetween(_BEGIN, -seconds * _SECOND)), F.lit(0))
    count = F.when(F.col("_us").isNull(), 0).otherwise(upto - before)
    return rows.withColumn(out, count.cast("long")).select(*columns, out)


def velocity_by_clock(tx: DataFrame, seconds: int, out: str) -> DataFrame:
    """For cardholders of any size."""
    columns = tx.columns
    rows = tx.withColumn("_us", F.unix_micros("ts"))
    instants = (rows.where(F.col("_us").isNotNull()).select("cardholder_id", "_us", "trans_num").distinct()
                .groupBy("cardholder_id", "_us").agg(F.count("*").alias("_n")))
    counts = around(instants, "cardholder_id", {"_n": F.sum}, back=seconds)
    joined = rows.join(counts, ["cardholder_id", "_us"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_n"), F.lit(0)).cast("long")).select(*columns, out)


def company_by_window(events: DataFrame, seconds: int) -> DataFrame:
    """Keeps events with another transaction at another merchant within ``seconds``.

    The distance is taken in whole seconds, rounded down. An event qualifies
    exactly if its span holds two merchants and two transactions, so looking at
    the nearest event that differs, either side, settles it without pairing.
    For cardholders of bounded size.
    """
    columns = events.columns
    rows = events.withColumn("_us", F.unix_micros("ts")).where(F.col("_us").isNotNull())
    order = ("_us", "trans_num", "merchant_id")
    ahead = W.Window.partitionBy("cardholder_id").orderBy(*order)
    behind = W.Window.partitionBy("cardholder_id").orderBy(*[F.desc(c) for c in order])
    near = {"merchant_id": F.lit(False), "trans_num": F.lit(False)}
    for side, window in (("a", ahead), ("b", behind)):
        # The neighbour that ends a run of equal values is the nearest event that differs.
        rows = rows.withColumns({f"_{side}_{c}": F.when(F.lag(c).over(window) != F.col(c), F.lag("_us").over(window))
                                 for c in near})
        so_far = window.rowsBetween(_BEGIN, 0)
        rows = rows.withColumns({f"_{side}_{c}": F.last(f"_{side}_{c}", ignorenulls=True).over(so_far) for c in near})
        for c in near:
            close = F.abs(F.col("_us") - F.col(f"_{side}_{c}")) < (seconds + 1) * _SECOND
            near[c] = near[c] | F.coalesce(close, F.lit(False))
    return rows.where(near["merchant_id"] & near["trans_num"]).select(*columns)


def company_by_clock(events: DataFrame, seconds: int) -> DataFrame:
    """``company_by_window`` for cardholders of any size."""
    columns = events.columns
    rows = events.withColumn("_us", F.unix_micros("ts")).where(F.col("_us").isNotNull())
    extremes = {"_m0": ("merchant_id", F.min), "_m1": ("merchant_id", F.max),
                "_t0": ("trans_num", F.min), "_t1": ("trans_num", F.max)}
    instants = rows.groupBy("cardholder_id", "_us").agg(*[f(c).alias(n) for n, (c, f) in extremes.items()])
    spans = around(instants, "cardholder_id", {n: f for n, (_, f) in extremes.items()},
                   back=seconds + 1, ahead=seconds + 1)
    spans = spans.where((F.col("_m0") != F.col("_m1")) & (F.col("_t0") != F.col("_t1")))
    return rows.join(spans, ["cardholder_id", "_us"], "left_semi").select(*columns)


def around(instants: DataFrame, key: str, merges: dict[str, Merge], back: int, ahead: int | None = None) -> DataFrame:
    """Merge values over a span around every instant of a key.

    ``instants``: one row per ``key, _us`` with the columns of ``merges``. The
    span starts ``back`` seconds earlier, exclusive, and ends at the instant
    itself or, with ``ahead``, that many seconds later, exclusive.

    The span is put together from whole seconds in the middle and a part of a
    second at either end, by frames that only grow: ends within one second; the
    middle, as long as a block of seconds, from the end of one block and the
    beginning of the next. So the cost doesn't depend on the span.
    """
    names = list(merges)
    merged = [merges[n](n).alias(n) for n in names]
    second, offset = F.floor(F.col("_us") / _SECOND), F.pmod(F.col("_us"), F.lit(_SECOND))
    ticks = instants.select(key, second.cast("long").alias("_s"), offset.alias("_o"), *names)

    empty = [F.lit(None).cast(ticks.schema[n].dataType).alias(n) for n in names]
    last = -1 if ahead is None else ahead - 1
    width = last + back  # whole seconds of a middle: from s + 1 - back to s + last
    seconds = ticks.groupBy(key, "_s").agg(*merged)

    # Middles: a second looks into the blocks where its middle begins and ends.
    def reach(shift: int, falling: bool) -> DataFrame:
        looks = seconds.select(key, (F.col("_s") + shift).alias("_s"), F.lit(True).alias("_look"), *empty)
        if not falling:  # a middle that is just one block is whole already
            looks = looks.where(F.pmod("_s", F.lit(width)) != width - 1)
        rows = seconds.select(key, "_s", F.lit(False).alias("_look"), *names).unionByName(looks)
        order = F.desc("_s") if falling else F.asc("_s")
        block = (W.Window.partitionBy(key, F.floor(F.col("_s") / width)).orderBy(order)
                 .rangeBetween(_BEGIN, W.Window.currentRow))
        seen = rows.select(key, (F.col("_s") - shift).alias("_s"), "_look",
                           *[merges[n](n).over(block).alias(n) for n in names])
        return seen.where("_look").drop("_look")

    if width > 0:
        middle = reach(1 - back, True).unionByName(reach(last, False)).groupBy(key, "_s").agg(*merged)
    else:
        middle = seconds.select(key, "_s", *empty)

    # Ends: a tick looks into the second at the end of its span.
    def end(shift: int, frame: W.WindowSpec) -> DataFrame:
        looks = ticks.select(key, (F.col("_s") + shift).alias("_s"), "_o", F.lit(True).alias("_look"), *empty)
        rows = ticks.select(key, "_s", "_o", F.lit(False).alias("_look"), *names).unionByName(looks)
        seen = rows.select(key, (F.col("_s") - shift).alias("_s"), "_o", "_look",
                           *[merges[n](n).over(frame).alias(n) for n in names])
        return seen.where("_look").drop("_look")

    in_second = W.Window.partitionBy(key, "_s")
    later = in_second.orderBy(F.desc("_o")).rangeBetween(_BEGIN, -1)
    earlier = in_second.orderBy("_o").rangeBetween(_BEGIN, -1)
    upto = in_second.orderBy("_o").rangeBetween(_BEGIN, 0)
    parts = end(-back, later).unionByName(end(0, upto) if ahead is None else end(ahead, earlier))
    ends = parts.groupBy(key, "_s", "_o").agg(*merged)

    joined = ends.alias("e").join(middle.alias("m"), [key, "_s"], "left")
    both = [merges[n](n).alias(n) for n in names]
    flat = joined.select(key, "_s", "_o", F.inline(F.array(
        F.struct(*[F.col(f"e.{n}").alias(n) for n in names]),
        F.struct(*[F.col(f"m.{n}").alias(n) for n in names]))))
    return (flat.groupBy(key, "_s", "_o").agg(*both)
            .select(key, (F.col("_s") * _SECOND + F.col("_o")).alias("_us"), *names))
