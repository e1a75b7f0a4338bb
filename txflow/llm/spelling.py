"""Spelling variants: words one edit apart, each led to its more frequent form, by reduced-alphabet generation.

Letters are hashed to a few symbols. Every word generates the full one-edit
neighbourhood of its reduced form, and the neighbourhoods meet the reduced
vocabulary in an ordinary join; what meets is verified on the words as they
are. A neighbourhood in the reduced alphabet is much smaller than one over all
letters, and two words one edit apart are always at most one apart when reduced.

Of a neighbourhood travels only what a bitmap of the reduced vocabulary lets
through. The bitmap has a fixed size; the more words there are the less it holds
back, which costs time and changes nothing in the result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.batch import RunHash, mix
from txflow.llm.common import quoted, stored

#: Runs of letters, as the contract defines them (fixed value).
LETTERS = "[A-Za-zÀ-ÿ]+"
#: One occurrence in so many loses a letter (fixed value).
DAMAGE = 97
#: Least length and number of occurrences of a word, and how much more frequent its form has to be.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: Symbols of the reduced alphabet; bits (as a power of two) of the bitmap that is sent to the tasks.
SYMBOLS, BITMAP = 12, 25
#: Bytes of different words that a task counts before it passes the counts on; numbers it works on at a time.
HELD, WORK = 1 << 24, 1 << 20
#: Letters of one text that are cut into words at a time.
STRETCH = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, times: int = TIMES, symbols: int = SYMBOLS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are what ``occurrences`` counts. A word's form is the most frequent
    word one edit away (ties: the first in code-point order) if it occurs at
    least ``times`` as often; its root is the end of the chain of forms, which
    is finite as numbers grow along it (``times`` has to be above 1). A null
    text has no words, a null key reads as the empty text in the damage rule;
    repeated rows count each time. An empty table gives an empty result, other
    columns are ignored.
    """
    if times <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = vocabulary(occurrences(docs, key, text, least_length), least_count, symbols)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    enough = -F.col("best.less") >= times * F.col("n")
    near = (near_words(words, symbols).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
            .select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"),
                    F.when(enough, -F.col("best.less")).alias("form_n")))
    near = stored(near, "spelling-near")
    ends = roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return (words.select("word", "n").join(near, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, n: how often each run of letters of at least ``least_length`` code points occurs, A to Z as a to z.

    An occurrence whose checksum (of ``<key>:<word>``) is divisible by DAMAGE loses
    the code point at checksum modulo length. Tasks count before anything is shuffled.
    """
    cut = re.compile(LETTERS)

    def stretches(line: str) -> Iterator[list[str]]:
        at = 0
        while at < len(line):
            upto = min(at + STRETCH, len(line))
            if upto < len(line) and (rest := cut.match(line, upto)):
                upto = rest.end()
            yield cut.findall(line, at, upto)
            at = upto

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[bytes] = Counter()
        held = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(tally), pa.binary()).cast(pa.string()), pa.array(list(tally.values()), pa.int64())],
                ["word", "n"])

        for batch in batches:
            for name, line in zip(batch.column(0), batch.column(1)):
                seed = zlib.crc32(f"{name.as_py()}:".encode())
                for runs in stretches(line.as_py()):
                    for run, n in Counter(runs).items():
                        word, size = run.encode().translate(_LOWER), len(run)
                        checksum = zlib.crc32(word, seed)
                        if checksum % DAMAGE == 0:
                            at, whole = checksum % size, word.decode()
                            word, size = (whole[:at] + whole[at + 1:]).encode(), size - 1
                        if size >= least_length:
                            if word not in tally:
                                held += len(word) + 100
                            tally[word] += n
                    if held > HELD:
                        yield out()
                        tally.clear()
                        held = 0
        yield out()

    rows = docs.select(F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")).alias("key"),
                       F.col(quoted(text)).cast("string").alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Reduced:
    """Hashes of reduced words and of all that is one edit away from them."""

    def __init__(self, symbols: int):
        run = RunHash(23)
        self.base, self.back = np.uint64(run.base), np.uint64(run.back)
        self.values = mix(np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        # Letters have code points below 256; their residue spreads neighbours in the alphabet evenly.
        self.symbol = np.arange(256) % symbols

    def grouped(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of equal length, a bounded number at a time: their rows, symbol values, and powers of the base."""
        words = [w.as_py().encode("latin-1") for w in column]
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            size = int(sizes[order[at]])
            upto = min(int(np.searchsorted(sizes[order], size, "right")), at + max(1, WORK // (size + 1)))
            rows = order[at:upto]
            codes = np.frombuffer(b"".join(words[r] for r in rows), np.uint8).reshape(len(rows), size)
            power = np.full(size + 1, self.base, np.uint64)
            power[0] = 1
            yield rows, self.values[self.symbol[codes]], np.cumprod(power, dtype=np.uint64)
            at = upto

    @staticmethod
    def key(sums: np.ndarray, size: int) -> np.ndarray:
        return mix(sums + mix(np.array([size], np.uint64))[0])

    def keys(self, column: pa.Array) -> np.ndarray:
        """One key per word."""
        out = np.zeros(len(column), np.uint64)
        for rows, values, power in self.grouped(column):
            size = values.shape[1]
            out[rows] = self.key((values * power[:size]).sum(axis=1, dtype=np.uint64), size)
        return out

    def neighbours(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and keys of the words themselves and of all their neighbours; a key may come more than once."""
        for rows, values, power in self.grouped(column):
            size = values.shape[1]
            terms = values * power[:size]
            before = np.zeros((len(rows), size + 1), np.uint64)
            np.cumsum(terms, axis=1, out=before[:, 1:])
            total = before[:, -1:]
            yield rows, self.key(total, size)
            yield rows, self.key(before[:, :-1] + (total - before[:, 1:]) * self.back, size - 1)
            step = max(1, WORK // (len(rows) * len(self.values)))
            for lo in range(0, size + 1, step):
                part = slice(lo, min(lo + step, size))
                other = (self.values - values[:, part, None]) * power[None, part, None]
                yield rows, self.key(total[:, :, None] + other, size).reshape(len(rows), -1)
                part = slice(lo, min(lo + step, size + 1))
                moved = before[:, part] + (total - before[:, part]) * self.base
                yield rows, self.key(moved[:, :, None] + self.values * power[part, None], size + 1).reshape(len(rows), -1)


def vocabulary(counts: DataFrame, least_count: int, symbols: int) -> DataFrame:
    """The words that occur often enough: id, word, n, and the key of the reduced word. Stored."""
    reduced = Reduced(symbols)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(reduced.keys(batch.column(0)).view(np.int64))], ["word", "n", "key"])

    # Neighbourhoods take far more work than a table of this size would get tasks for.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = counts.where(F.col("n") >= least_count).repartition(tasks, "word")
    return stored(words.mapInArrow(keyed, "word string, n long, key long")
                  .withColumn("id", F.monotonically_increasing_id()), "spelling-words")


def _place(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits)


def bitmap(words: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """A bit for every possible beginning of a key, set where a word has it; 2^bits bits, however many words there are."""
    parts = (words.select(_place(bits).alias("place"))
             .groupBy(F.shiftright("place", 6).alias("slot"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("some"))).toArrow()
    slots = np.zeros(1 << (bits - 6), np.uint64)
    slots[parts["slot"].to_numpy()] = parts["some"].to_numpy().view(np.uint64)
    return slots


def near_words(words: DataFrame, symbols: int = SYMBOLS, bits: int = BITMAP) -> DataFrame:
    """word, n, near, near_n for all pairs of ``vocabulary`` exactly one edit apart, in both directions."""
    reduced, known = Reduced(symbols), bitmap(words, bits)

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at in range(0, len(ids), 4096):
                kept = []
                for rows, keys in reduced.neighbours(batch.column(1)[at:at + 4096]):
                    place = keys >> np.uint64(64 - bits)
                    hit = (known[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
                    row, column = np.nonzero(hit)
                    kept.append(np.rec.fromarrays([ids[at:at + 4096][rows[row]], keys[row, column]], names="id,key"))
                some = np.unique(np.concatenate(kept))
                yield pa.RecordBatch.from_arrays([pa.array(some["id"]), pa.array(some["key"].view(np.int64))], ["id", "key"])

    around = words.select("id", "word").mapInArrow(generate, "id long, key long")
    right = words.select("key", F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = around.join(right, "key").where(F.col("id") != F.col("near_id")).select("id", "near", "near_n")
    apart = F.levenshtein("word", "near", 1)
    return met.join(words.select("id", "word", "n"), "id").where(apart == 1).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of ``form``; each round doubles the steps that are taken at once."""
    reach = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not reach.where("moved").isEmpty():
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reach = stored(reach.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return reach.select("word", "root")
