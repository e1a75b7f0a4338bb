"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (one to three
letters, with a blank at word ends), most frequent first. A document's own most
frequent n-grams are compared with each profile: every n-gram counts how far its
rank is out of place, one that the profile lacks counts the most. The language
with the least sum is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.llm.batch import Texts, mix, pieces, texts_of, tidy
from txflow.llm.common import quoted

#: N-grams of a profile and of a document; cells that n-grams are hashed to.
PROFILE, CELLS = 400, 1 << 17
#: The prediction for a text without letters, and for any if nothing was learned.
UNDETERMINED = "und"


class Profiles(NamedTuple):
    languages: list[str]
    ranks: np.ndarray  # [cell, language]: rank in the profile, PROFILE where it lacks the n-gram


def _letters() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0."""
    import unicodedata

    out = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and unicodedata.category(chr(point))[0] == "L":
            low = chr(point).lower()
            out[point] = ord(low[0])
    return out


def grams(texts: Texts, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all n-grams, text after text, and where each text's begin. Only letters and word ends count."""
    data = texts.data
    at = np.flatnonzero((data & 0xC0) != 0x80)
    char = letters[np.frombuffer(data.tobytes().decode(errors="surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)]
    bounds = np.searchsorted(at, texts.starts)
    # A blank at both ends of each text; runs of anything but letters count as one blank.
    rows = np.arange(len(bounds) - 1)
    inner = np.arange(len(char)) + np.repeat(rows, np.diff(bounds)) * 2 + 1
    line = np.zeros(len(char) + 2 * len(rows), np.uint64)
    line[inner] = char
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != 0) | (line[:-1] != 0)
    head = bounds[:-1] + 2 * rows
    keep[head] = True
    owner_first = np.searchsorted(np.flatnonzero(keep), head)
    line = line[keep]
    size = len(line)
    row = np.zeros(size, np.int64)
    row[owner_first[1:]] = 1
    row = np.cumsum(row)
    two = np.zeros(size, bool)
    two[:-1] = row[1:] == row[:-1]
    three = np.zeros(size, bool)
    three[:-2] = row[2:] == row[:-2]
    ahead = np.concatenate([line, np.zeros(2, np.uint64)])
    one = line != 0
    pair = line | ahead[1:size + 1] << np.uint64(21)
    trio = pair | ahead[2:size + 2] << np.uint64(42)
    middle = three & (ahead[1:size + 1] != 0)  # a blank only at the ends
    codes = np.concatenate([line[one], pair[two] | np.uint64(1 << 63), trio[middle]])
    owner = np.concatenate([row[one], row[two], row[middle]])
    cell = (mix(codes) >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return cell[order], np.searchsorted(owner[order], np.arange(len(rows) + 1))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles of every non-null label, counted over all the given rows.

    What returns to the driver is ``size`` n-grams per language. Rows without
    label or letters teach nothing; without any others no language is learned.
    """
    letters = _letters()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, tally in tallies.items():
                some = np.flatnonzero(tally)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(tally[some])],
                    ["lang", "cell", "n"])
            tallies.clear()

        for batch in tidy(batches):
            names = batch.column(1).to_pylist()
            for a, _, cut in pieces(texts_of(batch.column(0))):
                cell, first = grams(cut, letters)
                for i in range(len(first) - 1):
                    if names[a + i] not in tallies:
                        if len(tallies) == 64:  # bounded memory, however many labels a task meets
                            yield from out()
                        tallies[names[a + i]] = np.zeros(CELLS, np.int64)
                    part = cell[first[i]:first[i + 1]]
                    np.add.at(tallies[names[a + i]], part, 1)
        yield from out()

    rows = labelled.select(F.col(quoted(text)).cast("string"), F.col(quoted(lang)).cast("string").alias("lang"))
    counts = (rows.where(F.col("lang").isNotNull()).mapInArrow(count, "lang string, cell long, n long")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "cell")
    best = counts.withColumn("rank", F.row_number().over(top) - 1).where(F.col("rank") < size).collect()
    languages = sorted({row.lang for row in best})
    ranks = np.full((CELLS, len(languages)), size, np.int16)
    for row in best:
        ranks[row.cell, languages.index(row.lang)] = row["rank"]
    return Profiles(languages, ranks)


def predict(text: Column, profiles: Profiles, size: int = PROFILE) -> Column:
    """Struct of ``lang`` and ``score`` (1: all n-grams in place, 0: none known) for each text.

    A null or empty text, or one without a letter, is undetermined with score 0.
    Equal distances go to the language that sorts first.
    """
    letters = _letters()
    used = np.flatnonzero((profiles.ranks < size).any(axis=1))
    place = np.full(CELLS, len(used), np.int32)
    place[used] = np.arange(len(used))
    table = np.vstack([profiles.ranks[used], np.full((1, len(profiles.languages)), size)]).astype(np.int16)
    names = profiles.languages

    @F.arrow_udf("struct<lang:string,score:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in tidy(batches):
            langs, scores = [], []
            for _, _, cut in pieces(texts_of(column)):
                cell, first = grams(cut, letters)
                for i in range(len(first) - 1):
                    mine = cell[first[i]:first[i + 1]]
                    if not len(mine) or not names:
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    some, tally = np.unique(mine, return_counts=True)
                    some = some[np.argsort(-tally, kind="stable")[:size]]
                    theirs = table[place[some]].astype(np.int32)
                    off = np.where(theirs < size, np.abs(theirs - np.arange(len(some))[:, None]), size).sum(axis=0)
                    best = int(off.argmin())
                    langs.append(names[best])
                    scores.append(float(1 - off[best] / (size * len(some))))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["lang", "score"])

    return judge(text)


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from: a quarter, by checksum of the key's text."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: key, held_out, lang_pred, score.

    Learns from the rows that are not held out, predicts all. A null key is not
    held out. Rows are judged one by one: repeated rows get equal results.
    """
    model = learn(docs.where(~held_out(F.col(quoted(key)))), text, lang)
    guess = predict(F.col(quoted(text)).cast("string"), model)
    return (docs.select(F.col(quoted(key)).alias(key), held_out(F.col(quoted(key))).alias("held_out"), guess.alias("guess"))
            .select(F.col(quoted(key)), "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score")))
