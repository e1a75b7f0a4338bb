"""Windows that also start in an earlier text, found without ordering every suffix.

The windows (runs of ``width`` symbols) of a text are dealt to anchors: a window's
anchor is the run of ``grain`` symbols in it whose hash is least. Equal windows
have equal anchors, and neighbouring windows mostly share one, so a *context* -
the windows of one anchor, one after the other - is what is compared, in passes:

1. by anchor and then by context: a context that also is in an earlier text is
   repeated as a whole; an anchor with one context, or in one text, is done;
2. what is left, contexts that differ around a shared anchor, by whole windows:
   the symbols of an anchor's contexts meet and are ordered to the window's
   length; windows of an anchor with very many contexts meet by hash.

Records and texts go to buckets of bounded size by hash, many packed in one row.
A task sends at most the earliest of equal contexts, and those of an anchor that
has very many by context instead, so no frequent passage fills a bucket where keys
differ. Rows alike in key and text go through as one. Rows of one key whose texts
differ and share a passage are all sent: a bucket then grows with their number.
"""

from __future__ import annotations

import pickle
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.batch import RunHash, Texts, mix, pieces, sliding_min, spread, texts_of
from txflow.llm.common import quoted, stored

#: Records held by a task before it sends them, records and text bytes of a bucket, least number of buckets.
FLUSH, BUCKET_RECORDS, BUCKET_BYTES, LEAST_BUCKETS = 500_000, 500_000, 16 << 20, 16
#: Distinct contexts of one anchor from which they are sent on by context: within a task, and of all that meet.
WIDE, WIDEST = 32, 1000
#: Symbols handled at a time, however long a text is.
STRETCH = 1 << 20
#: Symbols of contexts in question that a task holds before it sends them.
HELD_SYMBOLS = 4 << 20
#: Keys are ordered as 64-bit integers; null is larger than any.
NULL_KEY = (1 << 63) - 1

_RECORDS, _COVERED, _MARKS, _WIDE, _CONTEXTS_, _TEXTS, _STATE, _RESULT = range(8)
#: Runs of windows: covered, in question, in question and to be compared one by one.
GONE, OPEN, ALONE = range(3)
_HEAD, _HEAD_BYTES = "<III", 12
_PART = "bucket int, kind int, blob binary"


class Symbols(NamedTuple):
    """Symbols of some texts end to end; text t has first[t] to first[t + 1] - 1."""

    raw: np.ndarray
    first: np.ndarray


class Found(NamedTuple):
    """Runs of windows by text: key and version of the text, first window, number of windows, state, anchor."""

    key: np.ndarray
    version: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    state: np.ndarray
    anchor: np.ndarray


class Method(NamedTuple):
    """What an operator brings along; the functions run in tasks."""

    width: int                                    # symbols of a window
    grain: int                                    # symbols of an anchor
    bytes_per_symbol: int                         # roughly, to choose the number of buckets
    symbols: Callable[[Texts], Symbols]
    values: Callable[[np.ndarray], np.ndarray]    # a random 64-bit value for each raw symbol
    group: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]  # equal pairs: order, flags of first ones
    order: Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]  # the same for runs of raw symbols
    finish: Callable[[Texts, np.ndarray, np.ndarray], list]  # removed symbol runs by text -> result columns
    columns: str                                  # their types


_GRAINS, _CONTEXTS, _WINDOWS = RunHash(31), RunHash(32), RunHash(33)


def group_sorted(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal (high, low) together, and where each group begins in it."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order, new


def contexts(symbols: Symbols, values_of: Callable, width: int, grain: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, text, first window, windows) of every context, long texts in stretches."""
    parts = []
    windows = np.maximum(np.diff(symbols.first) - width + 1, 0)
    begin = 0
    total = len(symbols.raw) - width + 1
    has = np.flatnonzero(windows)
    starts, owner = symbols.first[has], has
    while begin < total:
        upto = min(begin + STRETCH, total)
        values = values_of(symbols.raw[begin:upto + width - 1])
        grains = _GRAINS.windows(_GRAINS.sums(values), grain)
        # The least hash, the first of equal ones; ties are broken alike wherever the window stands.
        place = np.arange(len(grains), dtype=np.uint64)
        low = np.uint64((1 << 24) - 1)
        anchor = (sliding_min((grains & ~low) | place, width - grain + 1) & low).astype(np.int64)
        # Windows that start in this stretch and end within their text.
        a = np.clip(starts - begin, 0, upto - begin)
        b = np.clip(starts + windows[has] - begin, 0, upto - begin)
        valid = spread(a, b - a)
        text = np.repeat(owner, b - a)
        if len(valid):
            mine = anchor[valid]
            new = np.ones(len(valid), bool)
            new[1:] = (mine[1:] != mine[:-1]) | (text[1:] != text[:-1])
            head = np.flatnonzero(new)
            count = np.diff(np.append(head, len(valid)))
            at = valid[head]
            context = _CONTEXTS.runs(_CONTEXTS.sums(values), at, at + count - 1 + width)
            parts.append((grains[mine[head]], context, text[head], at + begin - symbols.first[text[head]], count))
        begin = upto
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*parts))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, first all the lowest ones: small numbers then pack well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(packed: memoryview, dtype: type, count: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8, count * size).reshape(size, count).T).view(dtype).reshape(-1)


def pack(anchor: np.ndarray, context: np.ndarray, found: Found) -> bytes:
    """Records as bytes: 32 bits of the anchor, 40 of the context, then text and place, compressed."""
    n = len(found.key)
    if n:
        new = np.ones(n, bool)
        new[1:] = (found.key[1:] != found.key[:-1]) | (found.version[1:] != found.version[:-1])
        head = np.flatnonzero(new)
        keys, versions = found.key[head], found.version[head]
        counts = np.diff(np.append(head, n)).astype(np.uint32)
        steps = np.diff(found.begin, prepend=0).astype(np.int32)
        steps[head] = found.begin[head]
    else:
        keys = versions = np.zeros(0, np.int64)
        counts, steps = np.zeros(0, np.uint32), np.zeros(0, np.int32)
    tail = b"".join(map(_planes, (np.diff(keys, prepend=np.int64(0)), versions, counts, steps,
                                  found.count.astype(np.uint16), found.state.astype(np.uint8),
                                  found.anchor.astype(np.uint32))))
    small = zlib.compress(tail, 1)
    raw = (anchor & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
    raw += (context & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
    raw += (context >> np.uint64(32) & np.uint64(0xFF)).astype(np.uint8).tobytes()
    return struct.pack(_HEAD, n, len(keys), len(anchor)) + raw + small


def unpack(blob: memoryview) -> tuple[np.ndarray, np.ndarray, Found]:
    n, texts, marked = struct.unpack_from(_HEAD, blob)
    at = _HEAD_BYTES
    anchor = np.frombuffer(blob, np.uint32, marked, at)
    context = (np.frombuffer(blob, np.uint32, marked, at + 4 * marked).astype(np.uint64)
               | np.frombuffer(blob, np.uint8, marked, at + 8 * marked).astype(np.uint64) << np.uint64(32))
    tail = memoryview(zlib.decompress(blob[at + 9 * marked:]))
    out = []
    for dtype, count in ((np.int64, texts), (np.int64, texts), (np.uint32, texts), (np.int32, n), (np.uint16, n),
                         (np.uint8, n), (np.uint32, n)):
        out.append(_numbers(tail, dtype, count))
        tail = tail[count * np.dtype(dtype).itemsize:]
    keys, versions, counts, steps, count, state, name = out
    counts = counts.astype(np.int64)
    run = np.cumsum(steps, dtype=np.int64)
    heads = np.cumsum(counts) - counts
    begin = run - np.repeat(run[heads] - steps[heads], counts) if n else run
    return anchor, context, Found(np.repeat(np.cumsum(keys), counts), np.repeat(versions, counts), begin,
                                  count.astype(np.int64), state, name)


def _take(found: Found, which: np.ndarray) -> Found:
    return Found(*(column[which] for column in found))


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], ["bucket", "kind", "blob"])


def _send(bucket: np.ndarray, kind: int, anchor: np.ndarray, context: np.ndarray, found: Found) -> list[tuple]:
    """One row for each bucket, records by text and place."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    out = []
    for part in np.split(order, cuts) if len(order) else []:
        marked = part if len(anchor) else part[:0]
        mine = _take(found, part) if len(found.key) else found
        out.append((int(bucket[part[0]]), kind, pack(anchor[marked], context[marked], mine)))
    return out


_NONE = np.zeros(0, np.uint64)
_NOTHING = Found(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint8), np.zeros(0, np.uint32))


def _freeze(*parts: object) -> bytes:
    return zlib.compress(pickle.dumps(parts, 5), 1)


def _thaw(blob: pa.Scalar) -> tuple:
    return pickle.loads(zlib.decompress(blob.as_buffer()))  # noqa: S301  (written by _freeze in the same job)


def _join(parts: list[Found]) -> Found:
    return Found(*(np.concatenate(c) for c in zip(*parts))) if parts else _NOTHING


def _pass_on(anchor: np.ndarray, context: np.ndarray, found: Found, buckets: int, wide: int | None,
             group: Callable) -> list[tuple]:
    """What a task sends: of equal contexts the earliest text's, the others' places as already covered."""
    order, new = group(anchor, context)
    heads = np.flatnonzero(new)
    member = np.cumsum(new) - 1
    least = np.minimum.reduceat(found.key[order], heads) if len(heads) else found.key[:0]
    covered = np.zeros(len(order), bool)
    covered[order] = found.key[order] > least[member]
    far = np.zeros(len(order), bool)
    rows = []
    if wide is not None and len(heads):
        lead = anchor[order][heads]  # sorted: one entry for each distinct context
        first = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]]))
        many = lead[first[np.diff(np.append(first, len(lead))) > wide]]
        if len(many):
            far = np.isin(anchor, many)
            rows += _send((mix(many) >> np.uint64(32)) % np.uint64(buckets), _MARKS, mix(many), many * np.uint64(0), _NOTHING)
    name = mix(anchor)
    home = (name >> np.uint64(32)) % np.uint64(buckets)
    away = (mix(name ^ context) >> np.uint64(32)) % np.uint64(buckets)
    near = ~covered & ~far
    rows += _send(home[near], _RECORDS, name[near], context[near], _take(found, near))
    near = ~covered & far
    rows += _send(away[near], _WIDE, name[near], context[near], _take(found, near))
    rows += _send(_text_bucket(found.key[covered], found.version[covered], buckets), _COVERED, _NONE, _NONE,
                  _take(found, covered)._replace(state=np.full(int(covered.sum()), GONE, np.uint8)))
    return rows


def _text_bucket(key: np.ndarray, version: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(key.view(np.uint64) ^ mix(version.view(np.uint64))) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _meet(method: Method, text_buckets: int, table: pa.Table) -> pa.Table:
    """A bucket's records: which runs are covered, which are in question; sent on to the texts' buckets."""
    by_kind: dict[int, list] = {k: [] for k in (_RECORDS, _COVERED, _MARKS, _WIDE)}
    out = []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob")):
        if kind == _CONTEXTS_:
            by_kind.setdefault(kind, []).append(_thaw(blob))
        else:
            by_kind[kind].append(unpack(memoryview(blob.as_buffer())))
    out += [f for _, _, f in by_kind[_COVERED]]
    marks = np.concatenate([a for a, _, _ in by_kind[_MARKS]] or [np.zeros(0, np.uint32)])
    for kind in (_RECORDS, _WIDE):
        if not by_kind[kind]:
            continue
        anchor = np.concatenate([a for a, _, _ in by_kind[kind]])
        context = np.concatenate([c for _, c, _ in by_kind[kind]])
        found = _join([f for _, _, f in by_kind[kind]])
        by_kind[kind] = []
        order, new = method.group(anchor.astype(np.uint64), context)
        anchor, found = anchor[order], _take(found, order)
        heads, member = np.flatnonzero(new), np.cumsum(new) - 1
        covered = found.key > np.minimum.reduceat(found.key, heads)[member]
        state = np.full(len(anchor), ALONE, np.uint8)
        if kind == _RECORDS:
            lead = np.ones(len(anchor), bool)
            lead[1:] = anchor[1:] != anchor[:-1]
            first, owner = np.flatnonzero(lead), np.cumsum(lead) - 1
            several = np.add.reduceat(new.astype(np.int64), first)
            asks = (several > 1) & (np.minimum.reduceat(found.key, first) < np.maximum.reduceat(found.key, first))
            alone = np.isin(anchor[first], marks) | (several > WIDEST)
            state = np.where(alone, ALONE, np.where(asks, OPEN, GONE)).astype(np.uint8)[owner]
        state[found.state == GONE] = GONE  # only the first pass asks further
        state[covered] = GONE
        told = covered | (state != GONE)
        out.append(_take(found, told)._replace(state=state[told], anchor=anchor[told]))
    if _CONTEXTS_ in by_kind:
        out.append(_compare(method, by_kind[_CONTEXTS_]))
    found = _join(out)
    order = np.lexsort((found.begin, found.version, found.key))
    found = _take(found, order)
    return pa.Table.from_batches([_rows(
        _send(_text_bucket(found.key, found.version, text_buckets), _COVERED, _NONE, _NONE, found))])


def _compare(method: Method, parts: list[tuple]) -> Found:
    """Windows of the contexts of a bucket, ordered symbol by symbol; the runs of those that are covered."""
    raw = np.concatenate([p[0] for p in parts])
    key, version, begin, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
    size = count + method.width - 1
    owner = np.repeat(np.arange(len(count)), count)
    at = spread(np.cumsum(size) - size, count)
    order, new = method.order(raw, at, method.width)
    heads, member = np.flatnonzero(new), np.cumsum(new) - 1
    mine = key[owner]
    covered = np.zeros(len(at), bool)
    covered[order] = mine[order] > np.minimum.reduceat(mine[order], heads)[member]
    # Neighbouring covered windows of a context are one run.
    hit = np.flatnonzero(covered)
    head = np.ones(len(hit), bool)
    head[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
    first = hit[head]
    runs = np.diff(np.append(np.flatnonzero(head), len(hit)))
    place = first - (np.cumsum(count) - count)[owner[first]]
    which = owner[first]
    return Found(key[which], version[which], begin[which] + place, runs, np.full(len(first), GONE, np.uint8),
                 np.zeros(len(first), np.uint32))


def _identity(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """key as an order, a version that tells rows of one key apart, the text and how many rows are alike; whether any may be."""
    order = F.coalesce(F.col(quoted(key)).cast("long"), F.lit(NULL_KEY))
    rows = docs.select(order.alias("key"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))
    repeated = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return rows.select("key", F.lit(0).cast("long").alias("version"), "text", F.lit(1).cast("long").alias("copies")), False
    # Rows alike in key and text share their result, so one of them goes through the passes.
    alike = rows.groupBy("key", "text").agg(F.count("*").alias("copies"))
    return alike.select("key", F.xxhash64("text").alias("version"), "text", "copies"), True


def _each_copy(result: DataFrame) -> DataFrame:
    """A row for each of ``copies``, in portions that are spread over the tasks."""
    portions = result.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(copies - 1) div 10000"))))
    portions = portions.repartition(result.sparkSession.sparkContext.defaultParallelism * 4)
    rest = F.col("copies") - F.col("portion") * 10000
    return portions.withColumn("portion", F.explode(F.array_repeat(F.lit(0), F.least(rest, F.lit(10000)).cast("int")))).drop("portion")


def remove_repeats(docs: DataFrame, method: Method, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key and the columns of ``method.finish``.

    A symbol goes if a window that covers it also starts in a row with a smaller
    key. Windows are judged on the input. Keys are integers; null is larger than
    any key, and null rows don't count as earlier than each other, nor do rows
    that repeat a key. Null text is empty.
    """
    rows, alike = _identity(docs, key, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    records = 2 * size // (method.bytes_per_symbol * (method.width - method.grain + 2))
    buckets = max(LEAST_BUCKETS, records // BUCKET_RECORDS)
    text_buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    kind = docs.schema[key].dataType
    told = f"{_PART}, key long, copies long, {method.columns}"

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _first_pass(batches, method, buckets)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed_texts(batches, text_buckets)

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _second_pass(batches, method, buckets)

    def met(sent: DataFrame) -> DataFrame:
        return sent.groupBy("bucket").applyInArrow(lambda table: _meet(method, text_buckets, table), _PART)

    def applied(packed: DataFrame, found: DataFrame, schema: str) -> DataFrame:
        return packed.unionByName(found).groupBy("bucket").applyInArrow(lambda table: _apply(method, table), schema)

    first = stored(applied(rows.mapInArrow(texts, _PART), met(rows.mapInArrow(anchors, _PART)), told), "repeats-first")
    state = first.where(F.col("kind") == _STATE).select("bucket", "kind", "blob")
    second = applied(state, met(state.select("blob").mapInArrow(questions, _PART)), told)
    result = first.where(F.col("kind") == _RESULT).unionByName(second).drop("bucket", "kind", "blob")
    result = (_each_copy(result) if alike else result).drop("copies")
    back = F.when(F.col("key") != NULL_KEY, F.col("key")).cast(kind)
    return result.select(back.alias(key), *[c for c in result.columns if c != "key"])


class _Sender:
    """Holds records until there are enough, then sends them to their buckets."""

    def __init__(self, method: Method, buckets: int, wide: int | None):
        self.method, self.buckets, self.wide = method, buckets, wide
        self.held: list[tuple[np.ndarray, np.ndarray, Found]] = []
        self.size = 0

    def add(self, anchor: np.ndarray, context: np.ndarray, found: Found) -> None:
        self.held.append((anchor, context, found))
        self.size += len(anchor)

    def send(self) -> list[tuple]:
        if not self.size:
            return []
        anchor, context = (np.concatenate([h[i] for h in self.held]) for i in (0, 1))
        found = _join([h[2] for h in self.held])
        self.held, self.size = [], 0
        context &= np.uint64((1 << 40) - 1)
        return _pass_on(anchor, context, found, self.buckets, self.wide, self.method.group)


def _first_pass(batches: Iterator[pa.RecordBatch], method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    """Every context, to the bucket of its anchor."""
    sender = _Sender(method, buckets, WIDE)
    for batch in batches:
        key, version = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for a, _, cut in pieces(texts_of(batch.column(2))):
            anchor, context, text, begin, count = contexts(method.symbols(cut), method.values, method.width, method.grain)
            sender.add(anchor, context, Found(key[a + text], version[a + text], begin, count,
                                              np.full(len(text), OPEN, np.uint8), np.zeros(len(text), np.uint32)))
            if sender.size >= FLUSH:
                yield _rows(sender.send())
    yield _rows(sender.send())


def _second_pass(batches: Iterator[pa.RecordBatch], method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    """What is in question: contexts with all their symbols by anchor, or window by window."""
    sender = _Sender(method, buckets, None)
    held: list[tuple] = []
    size = 0

    def contexts_out() -> list[tuple]:
        raw, keys, versions, begins, counts, names = (np.concatenate(c) for c in zip(*held))
        held.clear()
        home = (mix(names.astype(np.uint64)) >> np.uint64(32)) % np.uint64(buckets)
        length = counts + method.width - 1
        first = np.cumsum(length) - length
        order = np.argsort(home, kind="stable")
        return [(int(home[part[0]]), _CONTEXTS_, _freeze(
            raw[spread(first[part], length[part])], keys[part], versions[part], begins[part], counts[part]))
            for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(part)]

    for batch in batches:
        for blob in batch.column(0):
            key, version, _, starts, data, _, (text, begin, count, state, name) = _thaw(blob)
            for a, b, cut in pieces(Texts(np.frombuffer(data, np.uint8), starts)):
                symbols = method.symbols(cut)
                low, high = np.searchsorted(text, (a, b))
                mine = slice(low, high)
                at = begin[mine] + symbols.first[text[mine] - a]
                alone = state[mine] == ALONE
                single = spread(at[alone], count[mine][alone])
                if len(single):
                    owner = np.repeat(text[mine][alone], count[mine][alone])
                    values = method.values(symbols.raw)
                    names = [h.runs(h.sums(values), single, single + method.width) for h in (_WINDOWS, _CONTEXTS)]
                    sender.add(*names, Found(key[owner], version[owner], single - symbols.first[owner - a],
                                             np.ones(len(single), np.int64), np.full(len(single), GONE, np.uint8),
                                             np.zeros(len(single), np.uint32)))
                    if sender.size >= FLUSH:
                        yield _rows(sender.send())
                raw = symbols.raw[spread(at[~alone], count[mine][~alone] + method.width - 1)]
                owner = text[mine][~alone]
                held.append((raw, key[owner], version[owner], begin[mine][~alone], count[mine][~alone], name[mine][~alone]))
                size += len(raw)
                if size >= HELD_SYMBOLS:
                    yield _rows(contexts_out())
                    size = 0
    if held:
        yield _rows(contexts_out())
    yield _rows(sender.send())


def _packed_texts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts by bucket, many compressed together."""
    for batch in batches:
        key, version, copies = (batch.column(i).to_numpy() for i in (0, 1, 3))
        for a, b, cut in pieces(texts_of(batch.column(2)), BUCKET_BYTES):
            home = _text_bucket(key[a:b], version[a:b], buckets)
            order = np.argsort(home, kind="stable")
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                size = cut.starts[part + 1] - cut.starts[part]
                rows.append((int(home[part[0]]), _TEXTS, _freeze(
                    key[a + part], version[a + part], copies[a + part], np.concatenate([[0], np.cumsum(size)]),
                    cut.data[spread(cut.starts[part], size)].tobytes(), None, None)))
                if len(rows) == 64:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


def _apply(method: Method, table: pa.Table) -> pa.Table:
    """A bucket's texts and what was found about them: finished rows, and texts of which something is in question."""
    kinds = table.column("kind").to_pylist()
    blobs = table.column("blob")
    found = _join([unpack(memoryview(b.as_buffer()))[2] for k, b in zip(kinds, blobs) if k == _COVERED])
    # Rows with the same key and version have the same text and get the same runs.
    name = mix(found.key.view(np.uint64) ^ mix(found.version.view(np.uint64)))
    order = np.lexsort((found.begin, name))
    found, name = _take(found, order), name[order]
    columns: list[list] = [[] for _ in method.columns.split(",")]
    keys, alike, states = [], [], []
    for kind, blob in zip(kinds, blobs):
        if kind == _COVERED:
            continue
        key, version, copies, starts, data, earlier, _ = _thaw(blob)
        texts = Texts(np.frombuffer(data, np.uint8), starts)
        mine = mix(key.view(np.uint64) ^ mix(version.view(np.uint64)))
        low, high = np.searchsorted(name, mine), np.searchsorted(name, mine, "right")
        which, text = spread(low, high - low), np.repeat(np.arange(len(key)), high - low)
        state = found.state[which]
        gone = state == GONE
        end = found.begin[which] + found.count[which] - 1 + method.width
        runs = np.stack([found.begin[which], end], axis=1)[gone]
        owner = text[gone]
        if earlier is not None:
            owner, runs = np.concatenate([earlier[0], owner]), np.concatenate([earlier[1], runs])
            by = np.argsort(owner, kind="stable")
            owner, runs = owner[by], runs[by]
        waits = np.zeros(len(key), bool)
        waits[text[~gone]] = True
        for a, b, cut in pieces(texts):
            done = np.flatnonzero(~waits[a:b])
            if not len(done):
                continue
            few = Texts(cut.data[spread(cut.starts[done], (cut.starts[1:] - cut.starts[:-1])[done])],
                        np.concatenate([[0], np.cumsum((cut.starts[1:] - cut.starts[:-1])[done])]))
            lo, hi = np.searchsorted(owner, (a, b))
            ours = ~waits[owner[lo:hi]]
            renumbered = np.searchsorted(done, owner[lo:hi][ours] - a)
            keys.append(key[a + done])
            alike.append(copies[a + done])
            for column, values in zip(columns, method.finish(few, renumbered, runs[lo:hi][ours])):
                column += values
        if waits.any():
            rest = np.flatnonzero(waits)
            size = (starts[1:] - starts[:-1])[rest]
            kept, asked = waits[owner], ~gone
            states.append(_freeze(
                key[rest], version[rest], copies[rest], np.concatenate([[0], np.cumsum(size)]),
                texts.data[spread(starts[rest], size)].tobytes(),
                (np.searchsorted(rest, owner[kept]), runs[kept].astype(np.int32)),
                (np.searchsorted(rest, text[asked]), found.begin[which][asked], found.count[which][asked],
                 state[asked], found.anchor[which][asked])))
    bucket = table.column("bucket")[0].as_py()
    flat, times = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (keys, alike))
    size, more = len(flat), len(states)
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in method.columns.split(",")]
    return pa.Table.from_arrays(
        [pa.array([bucket] * (size + more), pa.int32()), pa.array([_RESULT] * size + [_STATE] * more, pa.int32()),
         pa.array([None] * size + states, pa.binary()), pa.array([*flat.tolist(), *[None] * more], pa.int64()),
         pa.array([*times.tolist(), *[None] * more], pa.int64()),
         *(pa.array([*c, *[None] * more], types[t]) for c, (_, t) in zip(columns, fields))],
        ["bucket", "kind", "blob", "key", "copies", *(n for n, _ in fields)])
