"""Sharding by jump consistent hashing, in SQL expressions only.

The shard of a key follows from the key and the number of shards: no ring, no
table. A pseudo-random sequence of growing jumps starts at shard 0; the last
shard before the jump past the end is the key's. One more shard changes the
outcome only for keys whose next jump lands on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.llm.common import quoted, stored, text_or_empty

#: Cells a shard is numbered in, and the rows from which a cell is cut further.
CELLS, CELL_ROWS = 1024, 1_000_000
#: Jumps done for every key; keys that need more are rare (their number grows with the logarithm of the shards).
EAGER_JUMPS = 64


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a key; null is a key like others."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jump(state: Column, _: Column) -> Column:
        at = state["next"]
        draw = F.shiftrightunsigned(F.xxhash64(key, at), 33) + F.lit(1)  # 1 to 2^31
        far = F.floor((at + F.lit(1)) * (F.lit(float(1 << 31)) / draw))
        return F.when(at < shards, F.struct(at.alias("at"), far.alias("next"))).otherwise(state)

    def jumps(state: Column, count: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(count)), state, jump)

    # Each jump goes forward, so as many jumps as shards always reach the end.
    state = jumps(F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next")),
                  min(shards, EAGER_JUMPS))
    if shards > EAGER_JUMPS:
        state = F.when(state["next"] < shards, jumps(state, shards - EAGER_JUMPS)).otherwise(state)
    return state["at"].cast("int")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  cells: int = CELLS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    The key and the number of shards alone decide the shard (law ``key``);
    grown_shard is the shard with one shard more. ``slot`` numbers the rows of
    a shard from 0 without gaps: by cell of the key's hash, then key, checksum
    and size. Null is a key of its own; repeated rows get a slot each; null
    text has size 1 and checksum 0. Other columns are ignored.

    No task numbers a whole shard: rows are numbered within cells, and the
    cells' counts give where each begins. A cell of more than ``cell_rows``
    rows, such as that of a very frequent key, is dealt to several parts.
    """
    content = text_or_empty(quoted(text))
    id_ = F.col(quoted(key))
    rows = stored(docs.select(
        id_.alias("id"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"),
        jump_shard(id_, shards).alias("shard"), jump_shard(id_, shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("cell"), id_), F.lit(cells)).cast("int").alias("cell"),
        F.monotonically_increasing_id().alias("ordinal")), "shards")
    # At most shards x cells rows; Spark broadcasts them below its threshold.
    loads = rows.groupBy("shard", "cell").agg(F.ceil(F.count("*") / F.lit(cell_rows)).alias("parts"))
    large = loads.where(F.col("parts") > 1)
    rows = (rows.join(large, ["shard", "cell"], "left")
            .withColumn("part", F.pmod("ordinal", F.coalesce("parts", F.lit(1)))))
    place = ["shard", "cell", "part"]
    before = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*place).agg(F.count("*").alias("n"))
              .select(*place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    order = Window.partitionBy(*place).orderBy("id", "text_crc32", "size", "ordinal")
    numbered = rows.withColumn("nth", F.row_number().over(order)).join(starts, place)
    return numbered.select(
        F.col("id").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("nth") - 1).alias("slot"), "grown_shard")
