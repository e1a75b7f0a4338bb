"""Line dedup over overlapping three-line windows.

Every run of three consecutive lines is hashed. A run that occurs more than
once in the whole table is repeated; its first occurrence stays, and every line
that a later occurrence covers goes. Covered lines of overlapping windows merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import quoted

#: Lines of a window.
LINES = 3


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = LINES,
               counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and two more columns: lines before, lines removed.

    Lines are what stands between line feeds. Of equal windows the one in the
    row with the smallest key stays (null is the smallest; among rows of one key
    the one whose text hashes lowest), within a row the first. Windows are judged
    on the input. Fewer than three lines have no window. A null text stays null
    and has 0 lines, an empty one has 1. Repeated rows (same key, same text) are
    one document and get the same result. A text may end up empty.
    """
    lines = F.split(F.col("_text"), "\n")
    # Repeated keys tell by a hash of the text which row is meant.
    rows = docs.select(F.col(quoted(key)).alias("_key"), F.xxhash64(quoted(text)).alias("_version"),
                       F.col(quoted(text)).alias("_text"))
    starts = F.sequence(F.lit(1), F.size(lines) - (width - 1))
    runs = F.transform(starts, lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i, width), "\n"))))
    windows = rows.where(F.size(lines) >= width).select("_key", "_version", F.posexplode(runs).alias("_at", "_run"))
    place = F.struct("_key", "_version", "_at")
    repeated = (windows.groupBy("_run").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
                .where(~F.col("_first").eqNullSafe(F.col("_last"))).select("_run", "_first"))
    later = windows.join(repeated, "_run").where(~place.eqNullSafe(F.col("_first")))
    hits = later.groupBy("_key", "_version").agg(F.collect_set("_at").alias("_hits"))

    @F.arrow_udf("struct<kept:string,removed:long>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, places in batches:
            kept, removed = [], []
            for content, at in zip(texts, places):
                if not at.is_valid or not content.is_valid:
                    kept.append(content.as_py())
                    removed.append(0)
                    continue
                parts = content.as_py().split("\n")
                stays = np.ones(len(parts), bool)
                begin = at.values.to_numpy()
                for i in range(width):
                    stays[begin + i] = False
                kept.append("\n".join(p for p, s in zip(parts, stays.tolist()) if s))
                removed.append(int((~stays).sum()))
            yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(removed, pa.int64())],
                                             ["kept", "removed"])

    own = [F.col(quoted(c)).alias(f"_own{i}") for i, c in enumerate(docs.columns)]
    full = docs.select(*own, F.col(quoted(key)).alias("_key"), F.xxhash64(quoted(text)).alias("_version"),
                       F.col(quoted(text)).alias("_text"))
    hits = hits.withColumnsRenamed({"_key": "_k", "_version": "_v"})
    full = full.join(hits, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_version") == F.col("_v")), "left")
    # Only texts that lose lines travel to Python.
    full = full.withColumn("_cut", cut(F.when(F.col("_hits").isNotNull(), F.col("_text")), "_hits"))
    values = {text: F.when(F.col("_hits").isNotNull(), F.col("_cut.kept")).otherwise(F.col("_text"))}
    return full.select(
        *[values.get(c, F.col(f"_own{i}")).alias(c) for i, c in enumerate(docs.columns)],
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias(counts[0]),
        F.col("_cut.removed").alias(counts[1]))
