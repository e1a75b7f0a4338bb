"""Repeated byte strings, by a depth-limited radix sort.

Most-significant-digit passes go over the hashes of anchors and contexts, then,
for what is in question, over the bytes of the windows up to the threshold. A
group of one leaves after the pass that isolates it, so only what may be repeated
is ordered further, and never beyond the threshold; the groups that remain are
exactly the repeated windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from txflow.llm.batch import RunHash, Texts
from txflow.llm.repeats import Method, Symbols, remove_repeats

#: Threshold in bytes, and bytes of an anchor.
WIDTH, GRAIN = 50, 16
#: (which key, shift) of the digits, most significant first: 32 bits of the anchor, 40 of the context.
_DIGITS = [(0, 16), (0, 0), (1, 24), (1, 8), (1, 0)]
_BYTES = RunHash(41)


def radix_groups(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal (high, low) together, and where each group begins in it."""
    size = len(high)
    order, new = np.arange(size), np.zeros(size, bool)
    new[:1] = True
    for which, shift in _DIGITS:
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, size))
        active = np.flatnonzero(np.repeat(count > 1, count))
        if not len(active):
            break
        group = np.cumsum(new)[active].astype(np.uint64)
        digit = (high, low)[which][order[active]] >> np.uint64(shift) & np.uint64(0xFFFF)
        key = group << np.uint64(16) | digit
        by = np.argsort(key, kind="stable")
        order[active] = order[active][by]
        key = key[by]
        new[active[1:]] |= key[1:] != key[:-1]
    return order, new


def radix_order(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order the strings raw[at:at + width], eight bytes a pass, and tell where each group of equal ones begins."""
    padded = np.append(raw, np.zeros(8, np.uint8))
    size = len(at)
    order, new = np.arange(size), np.zeros(size, bool)
    new[:1] = True
    for depth in range(0, width, 8):
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, size))
        active = np.flatnonzero(np.repeat(count > 1, count))
        if not len(active):
            break
        digit = np.zeros(len(active), np.uint64)
        for i in range(min(8, width - depth)):
            digit = digit << np.uint64(8) | padded[at[order[active]] + depth + i]
        group = np.cumsum(new)[active]
        by = np.lexsort((digit, group))
        order[active] = order[active][by]
        digit, group = digit[by], group[by]
        new[active[1:]] |= (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
    return order, new


def symbols(texts: Texts) -> Symbols:
    return Symbols(texts.data, texts.starts)


def values(raw: np.ndarray) -> np.ndarray:
    return _BYTES.values[raw]


def _cover(texts: Texts, owner: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Covered bytes, and for each text their number and the number of runs."""
    size = len(texts.data)
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, runs[:, 0] + texts.starts[owner], 1)
    np.add.at(depth, runs[:, 1] + texts.starts[owner], -1)
    covered = np.cumsum(depth[:-1]) > 0
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    heads = texts.starts[:-1][texts.starts[:-1] < size]
    opens[heads] |= covered[heads]
    total = [np.diff(np.concatenate([[0], np.cumsum(x)])[texts.starts]).tolist() for x in (covered, opens)]
    return covered, total[0], total[1]


def _kept(texts: Texts, covered: np.ndarray, removed: list[int]) -> list[bytes]:
    kept = texts.data[~covered]
    ends = np.cumsum(np.diff(texts.starts) - np.array(removed, np.int64))
    return [kept[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def texts_left(texts: Texts, owner: np.ndarray, runs: np.ndarray) -> list:
    covered, removed, spans = _cover(texts, owner, runs)
    return [np.diff(texts.starts).tolist(), removed, spans, _kept(texts, covered, removed)]


def digests_left(texts: Texts, owner: np.ndarray, runs: np.ndarray) -> list:
    *numbers, kept = texts_left(texts, owner, runs)
    return [*numbers, [hashlib.sha256(k).hexdigest() for k in kept]]


def drop_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                        grain: int = GRAIN, digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans (maximal removed runs), kept.

    Bytes go that a string of ``width`` bytes covers which also starts in a row
    with a smaller key; see remove_repeats for keys, nulls and repeated rows.
    ``kept`` are the remaining bytes (a cut may split a character). With
    ``digests`` there is kept_sha256 instead, so that the texts need not be
    written once more. Texts shorter than ``width`` are untouched.
    """
    last = "kept_sha256 string" if digests else "kept binary"
    return remove_repeats(docs, Method(
        width, grain, 1, symbols, values, radix_groups, radix_order, digests_left if digests else texts_left,
        f"n_bytes long, n_removed long, n_spans long, {last}"), key, text)
