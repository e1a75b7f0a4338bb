"""Whole batches of texts as flat arrays, so that tasks work on bytes and words without a loop per text.

A batch that arrives from Spark is cut into pieces of about a hundred kilobytes
(a text is never cut). Hashes of byte or word runs are differences of running
sums, so any run costs the same whatever its length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time, unless one text alone is longer.
PIECE = 1 << 17
_WRAP = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _number(seed: int) -> int:
    return int(mix(np.array([seed * 0x9E3779B97F4A7C15 & _WRAP], dtype=np.uint64))[0])


class Texts(NamedTuple):
    """UTF-8 bytes of some texts end to end: text i is data[starts[i]:starts[i + 1]]."""

    data: np.ndarray
    starts: np.ndarray


class Words(NamedTuple):
    """Places of words: word i is data[begin[i]:end[i]]; text t has words first[t] to first[t + 1] - 1."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """A view of an Arrow string or binary column; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return Texts(whole[starts[0]:starts[-1]], starts.astype(np.int64) - int(starts[0]))


def pieces(texts: Texts, limit: int = PIECE) -> Iterator[tuple[int, int, Texts]]:
    """Cut into runs of whole texts of at most ``limit`` bytes (or one text): first row, row after the last, texts."""
    starts, rows, row = texts.starts, len(texts.starts) - 1, 0
    while row < rows:
        upto = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield row, upto, Texts(texts.data[starts[row]:starts[upto]], starts[row:upto + 1] - starts[row])
        row = upto


def words_of(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes marked in the 256-entry table ``inside``, within each text."""
    flags = inside[texts.data]
    before = np.empty_like(flags)
    before[1:] = flags[:-1]
    after = np.empty_like(flags)
    after[:-1] = flags[1:]
    # Texts are bounded by their own ends.
    size = len(texts.data)
    before[texts.starts[:-1][texts.starts[:-1] < size]] = False
    after[texts.starts[1:][texts.starts[1:] > 0] - 1] = False
    begin = np.flatnonzero(flags & ~before)
    end = np.flatnonzero(flags & ~after) + 1
    return Words(begin, end, np.searchsorted(begin, texts.starts))


def give_back() -> None:
    """Return freed memory to the system: a worker is used again by later stages, which would find it kept."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def tidy(batches: Iterator) -> Iterator:
    """The same batches; memory is given back after each."""
    for batch in batches:
        yield batch
        del batch
        give_back()


class RunHash:
    """64-bit hashes of runs of symbols, by running sums of symbol values times powers of an odd base."""

    def __init__(self, seed: int):
        self.base = _number(3 * seed + 1) | 1
        self.back = pow(self.base, -1, 1 << 64)
        self._powers = self._inverse = np.ones(1, np.uint64)
        #: A random value per byte; fold() gives the same to lower and upper case.
        self.values = mix(np.arange(256, dtype=np.uint64) + np.uint64(_number(3 * seed + 2)))

    def folded(self) -> RunHash:
        """Read the letters A to Z as a to z."""
        self.values[65:91] = self.values[97:123]
        return self

    def __getstate__(self):
        return {"base": self.base, "back": self.back, "values": self.values}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            size = 1 << (size - 1).bit_length()
            for name, by in (("_powers", self.base), ("_inverse", self.back)):
                row = np.full(size, by, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        """Running sums over symbols that are themselves 64-bit values."""
        self._grow(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self._powers[:len(symbols)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each run [begin, end)."""
        return mix((sums[end] - sums[begin]) * self._inverse[begin])

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """The hash of every run of ``width`` symbols, in order of its begin."""
        return mix((sums[width:] - sums[:-width]) * self._inverse[:len(sums) - width])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of values[i:i + width] for every i that has so many."""
    least, done = values, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[:len(least) - (width - done)], least[width - done:])
    return least


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, … (count[0] numbers), then the same for the next."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    skipped = np.cumsum(count) - count
    return np.arange(total) + np.repeat(begin - skipped, count)
