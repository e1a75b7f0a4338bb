"""Toxicity by logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

Every feature has a learning rate of its own, which falls with the gradients it
has seen, and an L1 term that keeps the weights of uninformative features at
zero. The few that remain are sent to the tasks, which score every text where it
lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.batch import RunHash, Texts, mix, pieces, texts_of, words_of
from txflow.llm.common import quoted, stored

#: Features are hashed to 2^BITS cells; a text has each cell at most once.
BITS = 20
#: Labelled rows of each class that are learned from at most (those with the least hash of their key), and how often.
SAMPLE, EPOCHS = 10_000, 5
#: Of FTRL-proximal: pace and start of the learning rates, L1 and L2 terms.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.0


class Weights(NamedTuple):
    """The features that matter, in order, and what each counts; and the constant term."""

    cells: np.ndarray
    values: np.ndarray
    constant: float


def _inside() -> np.ndarray:
    """Bytes that belong to words: digits, letters and all beyond ASCII."""
    table = np.zeros(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[lo:hi] = True
    return table


class Features:
    """Cells of a text's words, pairs, triples, and pairs with one or two words between; A to Z read as a to z."""

    def __init__(self, bits: int = BITS):
        self.bits, self.inside, self.hash = bits, _inside(), RunHash(11).folded()

    def cells(self, texts: Texts) -> Iterator[np.ndarray]:
        """The different cells of each text, ascending."""
        words = words_of(texts, self.inside)
        sums = self.hash.sums(self.hash.values[texts.data])
        one = self.hash.runs(sums, words.begin, words.end)
        for a, b in zip(words.first[:-1], words.first[1:]):
            w = one[a:b]
            grams = [w]
            for gap, seed in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
                grams.append(mix(w[:-gap] * np.uint64(seed) + w[gap:]))
            grams.append(mix(grams[1][:-1] * np.uint64(0x27D4EB2F165667C5) + w[2:]))
            yield np.unique(np.concatenate(grams) >> np.uint64(64 - self.bits)).astype(np.int32)


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from: a fifth, by checksum of the key's text; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           most: int = SAMPLE) -> tuple[DataFrame, float]:
    """Rows to learn from (``order``, label ``y``, ``cells``; stored): at most ``most`` labels of each class.

    The number is by how much the log-odds of label 1 are higher among all
    labels than among those chosen. Labels of rows held out, null labels and labels of unknown documents teach
    nothing. A label other than 0 counts as 1. The chosen keys are bounded by the
    parameter, so they are broadcast; texts are not moved.
    """
    usable = labels.select(F.col(quoted(key)).alias("k"), (F.col(quoted(label)) != 0).cast("int").alias("y"))
    usable = (usable.where(F.col("k").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("k"))).distinct()
              .withColumn("order", F.xxhash64("k", "y")))
    chosen = [usable.where(F.col("y") == y).orderBy("order", "k").limit(most) for y in (0, 1)]
    chosen = stored(chosen[0].unionByName(chosen[1]), "toxicity-labels")
    there, taken = ({row.y: row["count"] for row in df.groupBy("y").count().collect()} for df in (usable, chosen))
    shift = float(np.log(there[1] / taken[1]) - np.log(there[0] / taken[0])) if len(taken) == 2 else 0.0
    features = Features()

    @F.arrow_udf("array<int>")
    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [c for _, _, cut in pieces(texts_of(column)) for c in features.cells(cut)]
            ends = np.cumsum([0, *[len(c) for c in found]]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))

    rows = (docs.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).cast("string").alias("text"))
            .join(F.broadcast(chosen), "k"))
    return stored(rows.select("order", "y", cells("text").alias("cells")), "toxicity-sample"), shift


def learn(rows: DataFrame, shift: float = 0.0, epochs: int = EPOCHS) -> Weights:
    """Weights from what ``sample`` returns, whose rows pass one task in order, ``epochs`` times.

    ``shift`` is added to the constant term. The task holds two numbers for each of the 2^BITS cells, and not the rows.
    Without rows all weights are zero.
    """
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << BITS) + 1  # the last stands for the constant term, which has no L1
        z, n = np.zeros(size), np.zeros(size)
        penalty = np.full(size, L1)
        penalty[-1] = 0.0

        def weights(at) -> np.ndarray:
            slack = np.abs(z[at]) - penalty[at]
            return np.where(slack > 0, -np.sign(z[at]) * slack / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

        for batch in batches:
            truth = batch.column(0).to_pylist()
            ends = batch.column(1).offsets.to_numpy()
            cells = batch.column(1).values.to_numpy()
            for i, y in enumerate(truth):
                at = np.append(cells[ends[i]:ends[i + 1]], size - 1)
                w = weights(at)
                gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
                more = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
                z[at] += gradient - more * w
                n[at] += gradient * gradient
        final = weights(np.arange(size))
        some = np.flatnonzero(final)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(final[some])], ["cell", "weight"])

    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    found = (passes.repartition(1).sortWithinPartitions("epoch", "order", F.hash("cells")).select("y", "cells")
             .mapInArrow(train, "cell long, weight double").toArrow())
    cells, values = found["cell"].to_numpy(), found["weight"].to_numpy()
    last = cells == 1 << BITS
    return Weights(cells[~last].astype(np.int32), values[~last], float(values[last].sum()) + shift)


def score(text: Column, weights: Weights) -> Column:
    """How likely label 1 is, 0 to 1; null counts as empty."""
    features, size = Features(), len(weights.cells)

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # A cell with a weight of its own is found by place; the others share one of zero.
        place = np.full(1 << BITS, size, np.int32)
        place[weights.cells] = np.arange(size)
        values = np.append(weights.values, 0.0)
        for column in batches:
            sums = [float(values[place[c]].sum()) for _, _, cut in pieces(texts_of(column)) for c in features.cells(cut)]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(sums, float) + weights.constant, -35, 35))), pa.float64())

    return judge(F.coalesce(text.cast("string"), F.lit("")))


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted.

    Learns from labelled rows that are not held out, scores all. Rows are scored
    one by one: repeated rows get equal results. A null or empty text has the
    score of the constant term. Without usable labels every score is 0.5.
    """
    model = learn(*sample(docs, labels, key, text, label))
    judged = docs.select(F.col(quoted(key)).alias(key), held_out(F.col(quoted(key))).alias("held_out"),
                         score(F.col(quoted(text)), model).alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
