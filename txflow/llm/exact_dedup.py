"""Exact dedup by a heavy-hitter split.

Misra-Gries summaries, one per task and merged by adding, name every digest
that may be frequent. The named digests are counted exactly; those verified as
frequent are so few that they are broadcast, and their rows are decided where
they lie. All other digests go through an ordinary shuffle; whatever the size
of the table, each of them has at most ``rows`` rows there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import BLANKS, quoted, stored, text_or_empty

#: Counters of a Misra-Gries summary: at least so many, and more in a table where that leaves a digest of more than ROWS rows.
COUNTERS, ROWS = 1024, 1_000_000

#: At most so many digests are broadcast (a hundred bytes each); where there may be more, joins with them are shuffled.
MOST = 250_000


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, BLANKS, " ")


def exact_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS, rows: int = ROWS,
                  most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Rows are equal if their texts are after normalisation (compared by SHA-256
    digest); null is the empty text. Of equal rows the one with the smallest
    key stays. A null key is larger than any other; of repeated rows (same key,
    equal text) just one stays. Other columns are ignored. An empty table gives
    an empty result.
    """
    digests = stored(docs.select(
        F.col(quoted(key)).alias("id"),
        F.unhex(F.sha2(normalised(text_or_empty(quoted(text))), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("ordinal")), "exact-digests")
    # Nulls last, then the key, then the place in the stored table.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "ordinal")).alias("first")
    size = F.count("*").alias("group_size")

    total = digests.count()
    counters = max(counters, -(-2 * total // rows))
    hint = F.broadcast if counters < most else lambda table: table
    named = hint(frequent(digests.select("digest"), total, counters))
    winners = stored(digests.join(named, "digest", "left_semi").groupBy("digest").agg(first, size), "exact-frequent")
    few = hint(winners)
    heavy = digests.join(few, "digest")
    light = digests.join(few.select("digest"), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(first, size), "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias(key), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("ordinal") == F.col("first.ordinal")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def frequent(values: DataFrame, total: int, counters: int = COUNTERS) -> DataFrame:
    """Every value in more than 2 / (counters + 1) of ``total`` rows, and perhaps some rarer ones.

    A summary counts a value too low by at most rows / (counters + 1), so the
    added-up count of such a value exceeds total / (counters + 1). Added-up
    counts sum to at most ``total``: no more than counters + 1 values pass.
    """
    (name,) = values.columns

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.Series(dtype="int64")
        for batch in batches:
            kept = kept.add(batch[name].value_counts(), fill_value=0).astype("int64")
            if len(kept) > counters:
                kept = kept.nlargest(counters + 1)
                kept = kept - kept.iloc[-1]
                kept = kept[kept > 0]
        yield pd.DataFrame({name: kept.index, "n": kept.to_numpy()})

    found = values.mapInPandas(summary, f"{name} {values.schema[0].dataType.simpleString()}, n long")
    return (found.groupBy(name).agg(F.sum("n").alias("n"))
            .where(F.col("n") > F.lit(total / (counters + 1))).select(name))
