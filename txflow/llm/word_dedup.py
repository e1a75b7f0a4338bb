"""Repeated word sequences, by anchors and hashes, and suffix trees for what these leave open.

The dealt method, prefix-partitioned suffix trees, is followed only in its last step.
Groups are no prefixes: windows go to a fixed number of buckets by the hash of their
anchor, which may lie anywhere in them (``repeats``). Contexts that agree in 72 bits
of hash are taken as equal without a tree, and windows of an anchor with very many
contexts meet by hash alone. For other contexts that differ around an anchor, a tree
grows top-down, one word a level: the suffixes below a node part by their next word,
and a branch with one suffix ends. Its inner nodes as deep as the threshold are
repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from txflow.llm.batch import RunHash, Texts, spread, words_of
from txflow.llm.repeats import Method, Symbols, group_sorted, remove_repeats

#: Threshold in words, and words of an anchor.
WIDTH, GRAIN = 50, 16
#: Bytes that are part of a word: all but blanks (fixed by the word pattern).
WORD_BYTES = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_BYTES = RunHash(51)


def symbols(texts: Texts) -> Symbols:
    words = words_of(texts, WORD_BYTES)
    return Symbols(_BYTES.runs(_BYTES.sums(_BYTES.values[texts.data]), words.begin, words.end), words.first)


def values(raw: np.ndarray) -> np.ndarray:
    return raw


def grow_tree(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the suffix tree of raw[at:at + width] in order, and where each node of depth ``width`` begins."""
    size = len(at)
    order, new = np.arange(size), np.zeros(size, bool)
    new[:1] = True
    for depth in range(width):
        head = np.flatnonzero(new)
        below = np.diff(np.append(head, size))
        inner = np.flatnonzero(np.repeat(below > 1, below))  # leaves of nodes that may still branch
        if not len(inner):
            break
        word, node = raw[at[order[inner]] + depth], np.cumsum(new)[inner]
        parted = (word[1:] != word[:-1]) & (node[1:] == node[:-1])
        if not parted.any():
            continue
        by = np.lexsort((word, node))
        order[inner] = order[inner][by]
        word, node = word[by], node[by]
        new[inner[1:]] |= (word[1:] != word[:-1]) | (node[1:] != node[:-1])
    return order, new


def texts_left(texts: Texts, owner: np.ndarray, runs: np.ndarray) -> list:
    words = words_of(texts, WORD_BYTES)
    depth = np.zeros(len(words.begin) + 1, np.int32)
    np.add.at(depth, runs[:, 0] + words.first[owner], 1)
    np.add.at(depth, runs[:, 1] + words.first[owner], -1)
    stays = np.cumsum(depth[:-1]) == 0
    # Every word left, with one more byte that becomes the blank after it.
    length = words.end[stays] - words.begin[stays] + 1
    out = np.append(texts.data, np.uint8(0x20))[spread(words.begin[stays], length)]
    ends = np.cumsum(length)
    out[ends - 1] = 0x20
    left = np.concatenate([[0], np.cumsum(stays)])[words.first]
    place = np.concatenate([[0], ends])[left].tolist()
    kept = [out[a:max(a, b - 1)].tobytes() for a, b in zip(place[:-1], place[1:])]
    total = np.diff(words.first)
    return [total.tolist(), (total - np.diff(left)).tolist(), kept]


def digests_left(texts: Texts, owner: np.ndarray, runs: np.ndarray) -> list:
    *numbers, kept = texts_left(texts, owner, runs)
    return [*numbers, [hashlib.sha256(k).hexdigest() for k in kept]]


def drop_repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                        grain: int = GRAIN, digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept (words left, joined by one blank).

    Words (runs of anything but blanks) go that a run of ``width`` words covers
    which also starts in a row with a smaller key; see remove_repeats for keys,
    nulls and repeated rows. With ``digests`` there is kept_sha256 instead of
    ``kept``. Texts of fewer words lose none.
    """
    last = "kept_sha256 string" if digests else "kept binary"
    return remove_repeats(docs, Method(
        width, grain, 6, symbols, values, group_sorted, grow_tree, digests_left if digests else texts_left,
        f"n_words long, n_removed long, {last}"), key, text)
