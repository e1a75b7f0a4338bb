"""Byte-level BPE, encoding and decoding, for any file of token ranks.

Each batch's distinct pre-tokens are merged together in one rank queue: a
bucket per rank holds places in a linked list of tokens, a hierarchical bitmap
tells by find-first-set which bucket is next, and entries that a merge has made
stale are skipped when their bucket comes up. A pre-token of a million bytes is
just a long list. Pre-tokens repeat so often that merging is a small share.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from txflow.llm.batch import RunHash, Texts, pieces, spread, texts_of, tidy

# Fixed values of the split pattern: white space, and the ends that follow an apostrophe.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ENDS = ["s", "t", "m", "d", "re", "ve", "ll"]
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
#: Bytes of text whose distinct pre-tokens are merged together; more needs less time and more memory.
MERGED_BYTES = 2 << 20
#: The split pattern these rules stand for (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary(NamedTuple):
    """Ranks in the form tasks use. A token's rank is its id."""

    data: np.ndarray        # bytes of all tokens end to end
    starts: np.ndarray      # token i is data[starts[i]:starts[i + 1]]
    pairs: np.ndarray       # left << 32 | right of every pair that merges, sorted
    ranks: np.ndarray       # and the token it merges to
    careful: np.ndarray     # tokens that are part of a token of lower rank
    kinds: np.ndarray       # class of every code point


def vocabulary(path: str) -> Vocabulary:
    """Read a rank file (base64 token, blank, rank on each line) on the driver; its size is the vocabulary's."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    tokens = [b""] * (max(ranks.values()) + 1)
    pairs, careful = {}, np.zeros(len(tokens), bool)
    for token, rank in ranks.items():
        tokens[rank] = token
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut], -1), ranks.get(token[cut:], -1)
            if left >= 0 and right >= 0:
                pairs[left << 32 | right] = rank
            for part in (left, right):
                if part > rank:
                    careful[part] = True
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("every single byte needs a rank")
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(
        np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)]), keys,
        np.array([pairs[k] for k in keys.tolist()], np.int64), careful, _kinds())


def _kinds() -> np.ndarray:
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for kind, name in ((_LETTER, "L"), (_DIGIT, "N")):
        found = "".join(regex.findall(rf"\p{{{name}}}+", every))
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    kinds[_SPACES] = _SPACE
    return kinds


def split(texts: Texts, kinds: np.ndarray) -> np.ndarray:
    """Byte places where pre-tokens begin, as the split pattern finds them within each text."""
    data = texts.data
    at = np.flatnonzero((data & 0xC0) != 0x80)
    char = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    size = len(char)
    if not size:
        return at
    kind = kinds[char]
    fresh = np.zeros(size + 3, bool)  # first character of a text
    bounds = np.searchsorted(at, texts.starts)
    fresh[bounds] = True
    fresh[size:] = True
    run = fresh[:size].copy()
    run[1:] |= kind[1:] != kind[:-1]
    begin = run.copy()
    # White space before other things: its last character goes with them, or stands alone.
    solid = np.flatnonzero(run & (kind != _SPACE) & ~fresh[:size])
    solid = solid[kind[solid - 1] == _SPACE]
    begin[solid - 1] = True
    begin[solid] = char[solid - 1] != 0x20
    # An apostrophe that begins a pre-token may take a short ending along.
    quote = np.flatnonzero(begin & (char == ord("'")) & ~fresh[1:size + 1])
    ahead = np.concatenate([char, np.zeros(2, np.uint32)])
    for end in _ENDS:
        first, length = quote + 1, len(end)
        fits = ahead[first] == ord(end[0])
        if length == 2:
            fits &= (ahead[first + 1] == ord(end[1])) & ~fresh[first + 1]
        hit = first[fits]
        begin[hit] = False
        rest = hit + length
        rest = rest[~fresh[rest]]
        begin[rest[kind[rest] == _LETTER]] = True
    return at[begin]


class RankQueue:
    """Buckets of places by rank; two levels of 64-bit words and a top word name the ranks in use."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low: dict[int, int] = {}
        self.mid: dict[int, int] = {}
        self.top = 0

    def push(self, places: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
            if rank in self.buckets:
                self.buckets[rank].append(part)
                continue
            self.buckets[rank] = [part]
            self.low[rank >> 6] = self.low.get(rank >> 6, 0) | 1 << (rank & 63)
            self.mid[rank >> 12] = self.mid.get(rank >> 12, 0) | 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, np.ndarray]:
        """The least rank in use, and its places in order."""
        first = lambda word: (word & -word).bit_length() - 1
        high = first(self.top)
        middle = high << 6 | first(self.mid[high])
        rank = middle << 6 | first(self.low[middle])
        self.low[middle] &= self.low[middle] - 1
        if not self.low[middle]:
            self.mid[high] &= self.mid[high] - 1
            if not self.mid[high]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        return rank, np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]


def merge(data: np.ndarray, starts: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the pre-tokens data[starts[i]:starts[i + 1]]: ids end to end, and where each one's begin."""
    size = len(data)
    singles = np.zeros(256, np.int64)
    lengths = np.diff(vocab.starts)
    ones = np.flatnonzero(lengths == 1)
    singles[vocab.data[vocab.starts[ones]]] = ones
    none = len(lengths)
    # Place `size` stands for no neighbour; its token never merges.
    token = np.append(singles[data], -1)
    after = np.arange(1, size + 2)
    before = np.arange(-1, size)
    heads, tails = starts[:-1], starts[1:] - 1
    full = tails >= heads
    after[tails[full]] = size
    before[heads[full]] = size
    before[size] = after[size] = size

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = token[left] << 32 | token[right]
        place = np.minimum(np.searchsorted(vocab.pairs, keys), len(vocab.pairs) - 1)
        return np.where((vocab.pairs[place] == keys) & (token[right] >= 0) & (token[left] >= 0), vocab.ranks[place], none)

    alive = np.ones(size, bool)
    rank = np.full(size + 1, none)
    every = np.arange(size)
    table = rank_of_bytes(singles, vocab, none)
    inner = every[after[:size] < size]
    rank[inner] = table[data[inner], data[after[inner]]]
    queue = RankQueue()
    some = np.flatnonzero(rank[:size] < none)
    if len(some):
        queue.push(some, rank[some])
    while queue.top:
        least, left = queue.pop()
        left = left[rank[left] == least]
        if len(left) > 1:
            # Of overlapping pairs the first, third, … of each chain merge.
            chained = after[left[:-1]] == left[1:]
            if chained.any():
                head = np.flatnonzero(np.concatenate([[True], ~chained]))
                nth = np.arange(len(left)) - np.repeat(head, np.diff(np.append(head, len(left))))
                left = left[nth % 2 == 0]
            if vocab.careful[least]:
                # This merge may bring up a lower rank: one merge in each pre-token at a time.
                owner = np.searchsorted(starts, left, "right")
                leading = np.concatenate([[True], owner[1:] != owner[:-1]])
                if not leading.all():
                    queue.push(left[~leading], np.full(int((~leading).sum()), least))
                    left = left[leading]
        if not len(left):
            continue
        right = after[left]
        beyond = after[right]
        token[left] = least
        alive[right] = False
        rank[right] = none
        after[left] = beyond
        before[beyond] = left
        prior = before[left]
        rank[left] = rank_of(left, beyond)
        rank[prior] = rank_of(prior, left)
        rank[size] = none
        changed = np.concatenate([left, prior])
        changed = changed[rank[changed] < none]
        if len(changed):
            queue.push(changed, rank[changed])
    kept = np.flatnonzero(alive)
    return token[kept].astype(np.int32), np.searchsorted(kept, starts)


def rank_of_bytes(singles: np.ndarray, vocab: Vocabulary, none: int) -> np.ndarray:
    """Rank of every pair of single bytes, ``none`` where they don't merge."""
    keys = singles[:, None] << 32 | singles[None, :]
    place = np.minimum(np.searchsorted(vocab.pairs, keys), len(vocab.pairs) - 1)
    return np.where(vocab.pairs[place] == keys, vocab.ranks[place], none)


def gather(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all elements of the listed runs, one run after the other, and where each run begins."""
    count = starts[which + 1] - starts[which]
    return spread(starts[which], count), np.concatenate([[0], np.cumsum(count)])


def encode_batch(texts: Texts, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts end to end, and where each text's begin."""
    return encode_and_decode(texts, vocab)[:2]


def encode_and_decode(texts: Texts, vocab: Vocabulary, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids of all texts end to end, where each text's begin, and what the ids decode to, end to end."""
    hashing = RunHash(seed)
    keys, firsts, samples, own = [], [0], [], []
    for _, _, piece in pieces(texts):
        begin = split(piece, vocab.kinds)
        end = np.append(begin[1:], len(piece.data))
        key = hashing.runs(hashing.sums(hashing.values[piece.data]), begin, end)
        distinct, sample = np.unique(key, return_index=True)
        span, cuts = gather(np.append(begin, len(piece.data)), sample)
        samples.append((distinct, piece.data[span], cuts))
        keys.append(key)
        own.append(np.searchsorted(begin, piece.starts[:-1]) + firsts[-1])
        firsts.append(firsts[-1] + len(begin))
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    # One sample of each distinct pre-token of the batch.
    known = np.concatenate([d for d, _, _ in samples]) if samples else key
    flat = np.concatenate([d for _, d, _ in samples]) if samples else np.zeros(0, np.uint8)
    base = np.cumsum([0, *(len(d) for _, d, _ in samples)])
    begin = np.concatenate([c[:-1] + b for (_, _, c), b in zip(samples, base)] + [[len(flat)]]).astype(np.int64)
    distinct, sample = np.unique(known, return_index=True)
    span, starts = gather(begin, sample)
    bytes_ = flat[span]
    # A pre-token that is a token is that token, whatever its merges would give.
    whole = hashing.runs(hashing.sums(hashing.values[vocab.data]), vocab.starts[:-1], vocab.starts[1:])
    order = np.argsort(whole)
    place = np.minimum(np.searchsorted(whole, distinct, sorter=order), len(order) - 1)
    ready = whole[order[place]] == distinct
    ready &= np.diff(starts) > 0
    rest = np.flatnonzero(~ready)
    span, cuts = gather(starts, rest)
    ids, first = merge(bytes_[span], cuts, vocab)
    count = np.ones(len(distinct), np.int64)
    count[rest] = np.diff(first)
    offsets = np.concatenate([[0], np.cumsum(count)])
    flat_ids = np.empty(int(offsets[-1]), np.int32)
    flat_ids[offsets[:-1][ready]] = order[place[ready]]
    flat_ids[spread(offsets[rest], count[rest])] = ids
    which = np.searchsorted(distinct, key)
    parts = [flat_ids[gather(offsets, which[a:b])[0]] for a, b in zip(firsts[:-1], firsts[1:])]
    total = np.concatenate([[0], np.cumsum(count[which])])
    rows = np.concatenate([*own, [len(key)]]).astype(np.int64)
    out = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    decoded = decode_batch(out, vocab)
    if not np.array_equal(decoded, texts.data):
        return encode_and_decode(texts, vocab, seed + 1)  # two pre-tokens had one hash
    return out, total[rows], decoded


def decode_batch(ids: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """The bytes of ids, end to end."""
    step = 1 << 18
    parts = [vocab.data[gather(vocab.starts, ids[i:i + step])[0]] for i in range(0, len(ids), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def encode(text: Column, vocab: Vocabulary) -> Column:
    """Token ids of a text as array<int>; null has none.

    Bytes that are not UTF-8 count as U+FFFD, as in any decoded string.
    """
    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _by_cuts(batches, lambda cut: _lists(*encode_batch(cut, vocab)))

    return to_ids(text)


def round_trip(text: Column, vocab: Vocabulary) -> Column:
    """Struct of ``ids``, as encode() gives them, and ``bytes``, what decode() makes of them, in one go."""
    def of_cut(cut: Texts, lengths: np.ndarray) -> pa.Array:
        ids, rows, decoded = encode_and_decode(cut, vocab)
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])[rows]
        return pa.StructArray.from_arrays([_lists(ids, rows), _binary(ends, decoded)], ["ids", "bytes"])

    @F.arrow_udf("struct<ids:array<int>,bytes:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = np.diff(vocab.starts)
        yield from _by_cuts(batches, lambda cut: of_cut(cut, lengths))

    return both(text)


def _by_cuts(batches: Iterator[pa.Array], of_cut: Callable[[Texts], pa.Array]) -> Iterator[pa.Array]:
    """What ``of_cut`` makes of each cut, handed on by itself: neither a worker nor the executor holds the results of a whole batch."""
    for column in batches:
        yield from tidy(map(of_cut, _cuts(column)))


def _cuts(column: pa.Array) -> Iterator[Texts]:
    """The texts of a column, some megabytes at a time; bytes that are not UTF-8 are replaced."""
    for _, _, cut in pieces(texts_of(column), MERGED_BYTES):
        try:
            cut.data.tobytes().decode()
        except UnicodeDecodeError:
            spans = zip(cut.starts[:-1], cut.starts[1:])
            cut = texts_of(pa.array([cut.data[a:b].tobytes().decode("utf-8", "replace") for a, b in spans]))
        yield cut


def _lists(ids: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32()))


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def decode(ids: Column, vocab: Vocabulary) -> Column:
    """The bytes that token ids stand for; null gives none. An id outside the vocabulary is an error."""
    @F.arrow_udf("binary")
    def to_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = np.diff(vocab.starts)
        for column in tidy(batches):
            if column.null_count:
                column = column.fill_null([])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            if len(flat) and (flat.min() < 0 or flat.max() >= len(lengths)):
                raise ValueError("token id outside the vocabulary")
            ends = np.concatenate([[0], np.cumsum(lengths[flat])])[offsets]
            yield _binary(ends, decode_batch(flat, vocab))

    return to_bytes(ids)
