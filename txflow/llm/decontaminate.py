"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of consecutive words of a benchmark item. For a window to
occur in a document all of its words must, so with its words ordered by rarity
in the corpus a prefix of one word is enough: windows are joined on their
rarest word alone. Where that word stands in the window bounds where the window
can begin, and the text's end bounds its length. Windows that share all of this
(rarest word, its place, length) are one shape: an occurrence of the word is
joined to shapes, at most 55, and not to windows, so that items made of few
words cost no more than others. The words around it, as a hash, then name the
window, and are compared with it word for word.

Items come in blocks of bounded size; one after the other is sent to all tasks
and applied to every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.batch import RunHash, Texts, Words, pieces, spread, texts_of, words_of
from txflow.llm.common import fresh, quoted, stored

#: Words of a window, and the text of items sent to the tasks at a time (a longer item is a block by itself).
#: A block has at most a window for every two bytes.
WINDOW, BLOCK_BYTES = 10, 2 << 20

#: Places in texts that are compared with shapes at a time.
STRETCH = 1 << 20

#: Bytes that are part of a word: digits, letters, everything beyond ASCII (fixed by the word pattern).
WORD_BYTES = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("runs", T.ArrayType(T.LongType()))])


class Windows:
    """All distinct windows of a block of items, found by their rarest word."""

    def __init__(self, ids: list[str | None], texts: list[str | None], width: int):
        self.hashing = RunHash(11).folded()
        self.ids, self.width = ids, width
        columns = texts_of(pa.array(texts, pa.string()))
        words = words_of(columns, WORD_BYTES)
        hashes = self.hashing.runs(self.hashing.sums(self.hashing.values[columns.data]), words.begin, words.end)
        spelled = np.frombuffer(columns.data.tobytes().lower(), np.uint8)
        found: dict[bytes, tuple[set[int], np.ndarray]] = {}
        for item, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            for i in range(a, max(a, b - width) + 1 if b > a else a):
                upto = min(i + width, b)
                key = b" ".join(spelled[p:q].tobytes() for p, q in zip(words.begin[i:upto], words.end[i:upto]))
                found.setdefault(key, (set(), hashes[i:upto]))[0].add(item)
        self.spelling = list(found)
        self.items = [sorted(items) for items, _ in found.values()]
        self.hashes = [h for _, h in found.values()]
        self.vocabulary = np.unique(hashes)

    def order(self, counts: np.ndarray) -> None:
        """Choose each window's prefix, given how often each word of the vocabulary occurs in the corpus."""
        prefix = np.zeros(len(self.hashes), np.uint64)
        self.offset = np.zeros(len(self.hashes), np.int64)
        self.length = np.array([len(h) for h in self.hashes], np.int64)
        for n, h in enumerate(self.hashes):
            rarity = counts[np.searchsorted(self.vocabulary, h)]
            self.offset[n] = np.lexsort((np.arange(len(h)), h, rarity))[0]
            prefix[n] = h[self.offset[n]]
        order = np.lexsort((self.length, self.offset, prefix))
        shapes = np.stack([prefix[order], self.offset[order].astype(np.uint64), self.length[order].astype(np.uint64)])
        shapes = shapes[:, np.append(True, (shapes[:, 1:] != shapes[:, :-1]).any(0))[:len(order)]]
        self.at, self.size = shapes[1:].astype(np.int64)
        self.prefix, self.first = np.unique(shapes[0], return_index=True)
        self.count = np.diff(np.append(self.first, shapes.shape[1]))
        self.whole = RunHash(12)
        sums = np.array([self.whole.runs(self.whole.sums(h), np.array([0]), np.array([len(h)]))[0] for h in self.hashes],
                        np.uint64)
        self.windows = np.argsort(sums, kind="stable")
        self.expected = sums[self.windows]

    def __getstate__(self):
        """What tasks need: words have been counted, and prefixes chosen, by then."""
        return {k: v for k, v in self.__dict__.items() if k not in ("hashes", "vocabulary")}

    def occurrences(self, texts: Texts, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence."""
        none = np.zeros(0, np.int64)
        if not len(self.prefix) or not len(hashes):
            return none, none
        slot = np.minimum(np.searchsorted(self.prefix, hashes), len(self.prefix) - 1)
        seen = np.flatnonzero(self.prefix[slot] == hashes)
        slot = slot[seen]
        sums = self.whole.sums(hashes)
        # Stretches of occurrences, each with a bounded number of shapes (or one occurrence).
        upto = np.cumsum(self.count[slot])
        ends = np.unique(np.append(np.searchsorted(upto, np.arange(STRETCH, upto[-1] if len(upto) else 0, STRETCH)), len(slot)))
        found = [self._compare(texts, words, sums, seen[a:b], slot[a:b])
                 for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _compare(self, texts: Texts, words: Words, sums: np.ndarray, seen: np.ndarray, slot: np.ndarray):
        shape = spread(self.first[slot], self.count[slot])
        begin = np.repeat(seen, self.count[slot])
        text = np.searchsorted(words.first, begin, "right") - 1
        begin = begin - self.at[shape]
        # Positional and length bounds: the whole window lies in the text.
        fits = (begin >= words.first[text]) & (begin + self.size[shape] <= words.first[text + 1])
        begin, shape = begin[fits], shape[fits]
        value = self.whole.runs(sums, begin, begin + self.size[shape])
        first = np.searchsorted(self.expected, value)
        many = np.searchsorted(self.expected, value, "right") - first
        window = self.windows[spread(first, many)]
        begin, shape = np.repeat(begin, many), np.repeat(shape, many)
        # A window may agree with several shapes; its own one counts.
        own = (self.offset[window] == self.at[shape]) & (self.length[window] == self.size[shape])
        begin, window = begin[own], window[own]
        # What agrees in hash is compared in full.
        low = texts.data
        exact = np.array([
            b" ".join(low[p:q].tobytes() for p, q in zip(words.begin[b:b + n], words.end[b:b + n])).lower() == self.spelling[w]
            for b, n, w in zip(begin.tolist(), self.length[window].tolist(), window.tolist())], bool)
        return begin[exact], window[exact]


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  name: str = "contamination") -> DataFrame:
    """``docs`` with one more column, a struct: n_words, n_hit and items (sorted ids of items with occurring windows).

    Words are runs of digits, letters and non-ASCII characters, A to Z in lower
    case. An item shorter than ``width`` words is one window; one without
    words, or with null text, has none. A null item id is left out of
    ``items`` though its windows hit. Null and empty texts have no words. Rows
    are judged one by one, so repeated rows get the same result. With no items
    n_hit is 0. Other columns of either table don't matter.
    """
    found, text_name = fresh(docs, "found"), text
    columns = [F.col(quoted(c)) for c in docs.columns if c != name]
    nothing = F.lit(None).cast(HITS)
    rows = docs.withColumn(found, nothing)
    items = benchmark.select(F.col(quoted(item)).cast("string").alias("id"),
                             F.col(quoted(item_text)).cast("string").alias("words"))
    fold = RunHash(11).folded()
    blocks = _blocks(items, width, block_bytes)
    block = next(blocks, Windows([], [], width))
    while block is not None:
        content = F.col(quoted(text_name)).cast("string")
        block.order(_word_counts(docs.select(content), block.vocabulary, fold))
        rows = rows.withColumn(found, _judge(block, fold)(content, F.col(found)))
        block = next(blocks, None)
        if block is not None:  # one block at a time: the next one needs this one's results only
            rows = stored(rows, "decontaminate")
    return rows.select(*columns, F.struct(
        F.col(f"{found}.n_words"), F.col(f"{found}.n_hit"), F.col(f"{found}.items")).alias(name))


def _judge(block: Windows, fold: RunHash):
    """A function of a text and what earlier blocks found in it."""

    @F.arrow_udf(HITS)
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, earlier in batches:
            total, hit, items, runs = [], [], [], []
            for a, b, cut in pieces(texts_of(column)):
                words = words_of(cut, WORD_BYTES)
                hashes = fold.runs(fold.sums(fold.values[cut.data]), words.begin, words.end)
                begin, window = block.occurrences(cut, words, hashes)
                end = begin + block.length[window] if len(begin) else begin
                owner = np.searchsorted(words.first, begin, "right") - 1
                names: list[set] = [set() for _ in range(b - a)]
                for t, w in set(zip(owner.tolist(), window.tolist())):
                    names[t].update(block.ids[i] for i in block.items[w])
                if earlier.null_count < len(earlier):
                    before = earlier[a:b].to_pylist()
                    for t, (told, x) in enumerate(zip(before, words.first[:-1].tolist())):
                        names[t].update(told["items"])
                        begin = np.concatenate([begin, np.array(told["runs"][::2], np.int64) + x])
                        end = np.concatenate([end, np.array(told["runs"][1::2], np.int64) + x])
                cover = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(cover, begin, 1)
                np.add.at(cover, end, -1)
                inside = np.cumsum(cover[:-1]) > 0
                covered = np.concatenate([[0], np.cumsum(inside)])
                total += np.diff(words.first).tolist()
                hit += np.diff(covered[words.first]).tolist()
                items += [sorted(n for n in names_ if n is not None) for names_ in names]
                for x, y in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside[x:y], [0]])))
                    runs.append(edges.tolist())
            yield pa.StructArray.from_arrays(
                [pa.array(total, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
                 pa.array(runs, pa.list_(pa.int64()))], ["n_words", "n_hit", "items", "runs"])

    return judge


def _blocks(items: DataFrame, width: int, block_bytes: int) -> Iterator[Windows]:
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():  # the query set, one partition at a time
        ids.append(row.id)
        texts.append(row.words)
        size += len((row.words or "").encode())
        if size >= block_bytes:
            yield Windows(ids, texts, width)
            ids, texts, size = [], [], 0
    if ids:
        yield Windows(ids, texts, width)


def _word_counts(texts: DataFrame, vocabulary: np.ndarray, fold: RunHash) -> np.ndarray:
    """How often each word of the vocabulary occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, _, cut in pieces(texts_of(batch.column(0))):
                words = words_of(cut, WORD_BYTES)
                hashes = fold.runs(fold.sums(fold.values[cut.data]), words.begin, words.end)
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                counts += np.bincount(place[vocabulary[place] == hashes], minlength=len(vocabulary))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["word", "n"])

    counts = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        found = texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        for row in found.collect():  # at most one row per word of a block
            counts[row.word] = row.n
    return counts
