"""Near-duplicate classes by DartMinHash signatures and banded joining.

Every distinct shingle of a document is a region as high as its weight, at
which hashed darts are thrown. A dart has a rank (when it lands) and a
coordinate; each coordinate of the signature keeps its earliest dart. The darts
of a shingle are the same in every document, so two documents agree on a
coordinate as often as their weights overlap (weighted Jaccard similarity), and
only about as many darts are thrown as the signature needs.

Texts with the same shingles are one node. Nodes that agree on a whole band meet
in a bucket. Its members are compared with a pivot, the one that meets most other
nodes. Members of buckets that this doesn't connect, and that share enough
shingles with other components at all, are dealt anew, to a bucket for each of
their rarest shingles: nodes alike share one of these. Such buckets have pivots
outside their largest component, ever more of them until the bucket is connected
or all have been. So pairs within a group of copies, or of variants that are only
somewhat alike, are not listed, and no link is left out. The comparison is exact,
on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.batch import RunHash, Texts, mix, pieces, spread, texts_of, tidy, words_of
from txflow.llm.common import quoted, stored
from txflow.llm.decontaminate import WORD_BYTES

#: Words of a shingle, least similarity, bands and coordinates of a band.
SHINGLE, SIMILARITY, BANDS, WIDTH = 5, 0.8, 20, 4
#: Nodes up to which the list of those to compare is broadcast (8 bytes each); beyond it they are joined by a shuffle.
BROADCAST_NODES = 1_000_000

#: Bytes of text described at a time: each piece needs as many rounds of darts as its shortest text.
_PIECE = 1 << 19
_WORDS, _SHINGLES = RunHash(21).folded(), RunHash(22)


def shingles(texts: Texts, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, where each text's begin, and how often each occurs.

    A text of fewer words, but not none, is one shingle.
    """
    words = words_of(texts, WORD_BYTES)
    hashes = _WORDS.runs(_WORDS.sums(_WORDS.values[texts.data]), words.begin, words.end)
    count = np.diff(words.first)
    runs = np.where(count > 0, np.maximum(count - width + 1, 1), 0)
    begin = spread(words.first[:-1], runs)
    row = np.repeat(np.arange(len(runs)), runs)
    value = _SHINGLES.runs(_SHINGLES.sums(hashes), begin, np.minimum(begin + width, words.first[row + 1]))
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    place = np.flatnonzero(new)
    return value[place], np.searchsorted(row[place], np.arange(len(runs) + 1)), np.diff(np.append(place, len(value)))


def signatures(elements: np.ndarray, first: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """[set, coordinate] values for weighted sets laid end to end; a set without elements has zeros.

    ``weights`` are positive numbers. An element of weight w is cut into strips
    of height 1, the last one lower; each strip has its own endless sequence of
    darts with exponential gaps, and a dart above a low strip's top misses.
    """
    sets = len(first) - 1
    out = np.zeros((sets, size), np.uint64)
    strips = np.ceil(weights).astype(np.int64)
    nth = spread(np.zeros(len(elements), np.int64), strips)
    strip = mix(np.repeat(elements, strips) + mix(nth.astype(np.uint64)))
    top = np.minimum(np.repeat(weights, strips) - nth, 1.0)
    ends = np.concatenate([[0], np.cumsum(strips)])[first]
    owner = np.repeat(np.arange(sets), np.diff(ends))
    total = np.concatenate([[0.0], np.cumsum(weights)])
    total = total[first[1:]] - total[first[:-1]]
    open_ = np.flatnonzero(total > 0)
    # Enough darts for every coordinate to be hit, but for about one set in a hundred, which takes twice as many.
    darts = size * (np.log(size) + 5.0)
    while len(open_):
        reach = np.zeros(sets)
        reach[open_] = darts / total[open_]
        best = np.full(sets * size, np.inf)
        value = np.zeros(sets * size, np.uint64)
        live = np.flatnonzero(reach[owner] > 0)
        rank = np.zeros(len(live))
        throw = 0
        while len(live):
            dart = mix(strip[live] ^ mix(np.array([throw + 1], np.uint64)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53)
            near = rank < reach[owner[live]]
            live, rank, dart = live[near], rank[near], dart[near]
            where = mix(dart + np.uint64(1))
            inside = (mix(dart + np.uint64(2)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < top[live]
            cell = owner[live[inside]] * size + (where[inside] % np.uint64(size)).astype(np.int64)
            np.minimum.at(best, cell, rank[inside])
            won = best[cell] == rank[inside]
            value[cell[won]] = dart[inside][won]
            throw += 1
        full = np.isfinite(best.reshape(sets, size)).all(axis=1)
        done = open_[full[open_]]
        out[done] = value.reshape(sets, size)[done]
        open_ = open_[~full[open_]]
        darts *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int, width: int) -> np.ndarray:
    """One value for each band of each signature."""
    parts = signature.reshape(len(signature), bands, width)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(width):
        out = mix(out + parts[:, :, i])
    return out


def _node(elements: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits that name each set, None for an empty one."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (1, 2)]
    names = np.stack([s[first[1:]] - s[first[:-1]] for s in sums], axis=1)
    return [n.tobytes() if k else None for n, k in zip(names, np.diff(first).tolist())]


def _by_pieces(batches: Iterator[pa.Array], of_piece: Callable[[Texts], pa.Array]) -> Iterator[pa.Array]:
    """What ``of_piece`` makes of each piece, handed on by itself: no worker holds the results of a whole batch."""
    for column in batches:
        yield from tidy(of_piece(cut) for _, _, cut in pieces(texts_of(column), _PIECE))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                 shingle: int = SHINGLE, bands: int = BANDS, width: int = WIDTH, counted: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, class_id, class_size, kept.

    A class is a set of documents connected by pairs of at least ``similarity``:
    Jaccard similarity of their sets of word shingles, or with ``counted`` the
    weighted similarity of how often each occurs. class_id is the smallest key
    of the class (null only if all are null) and one row of that key is kept.
    Null texts and texts without words are alike to nothing: each is a class of
    its own. Repeated rows are alike to each other. Other columns don't matter.
    """
    rows = _classified(docs, key, text, similarity, shingle, bands, width, counted)
    return rows.select(F.col("id").alias(key), "class_id", "class_size", "kept")


def near_unique(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                shingle: int = SHINGLE, bands: int = BANDS, width: int = WIDTH, counted: bool = False) -> DataFrame:
    """``docs`` with one row of each class of near_classes() left."""
    rows = stored(_classified(docs, key, text, similarity, shingle, bands, width, counted), "near-classes")
    # A row is named by key and a hash of its text; repeated rows share a name.
    names = rows.groupBy("id", "version").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = names.where(~F.col("kept")).select(F.col("id").alias("_id"), F.col("version").alias("_version"))
    if gone.count() <= BROADCAST_NODES:
        gone = F.broadcast(gone)
    own = [F.col(quoted(c)).alias(f"_own{i}") for i, c in enumerate(docs.columns)]
    named = docs.select(*own, F.col(quoted(key)).alias("_key"), F.xxhash64(F.col(quoted(text)).cast("string")).alias("_text"))
    left = named.join(gone, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_version")), "left_anti")
    if not names.where("n > 1 AND kept").isEmpty():
        # Repeated rows of one class: of texts with words one row stays, without words all do.
        wordless = rows.where(F.col("node").isNull()).select(F.col("id").alias("_id"), F.col("version").alias("_version")).distinct()
        same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_version"))
        left = left.join(wordless, same, "left_anti").dropDuplicates(["_key", "_text"]).unionByName(
            left.join(wordless, same, "left_semi"))
    return left.select(*[F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns)])


def _classified(docs: DataFrame, key: str, text: str, similarity: float, shingle: int, bands: int, width: int,
                counted: bool) -> DataFrame:
    """id, version (hash of the text), node, class_id, class_size, kept for every row."""
    rows = stored(_described(docs, key, text, shingle, bands, width, counted), "near-rows")
    nodes = stored(rows.where(F.col("node").isNotNull()).groupBy("node")
                   .agg(F.min("id").alias("id"), F.any_value("bands").alias("bands")), "near-nodes")
    links = _links(docs, nodes, key, text, similarity, shingle, counted)
    # Rows without words are classes of their own, told apart by their place in the stored table.
    own = F.coalesce(F.hex("node"), F.concat(F.lit("row "), F.col("ordinal").cast("string")))
    rows = rows.select("id", "version", "ordinal", "node", own.alias("own"))
    if links is not None:
        rows = rows.join(links.withColumnRenamed("label", "linked"), "node", "left")
        rows = rows.select("id", "version", "ordinal", "node", F.coalesce(F.hex("linked"), "own").alias("class"))
    else:
        rows = rows.select("id", "version", "ordinal", "node", F.col("own").alias("class"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "ordinal")).alias("first")
    classes = rows.groupBy("class").agg(first, F.count("*").alias("class_size"))
    return rows.join(classes, "class").select(
        "id", "version", "node", F.col("first.id").alias("class_id"), "class_size",
        (F.col("ordinal") == F.col("first.ordinal")).alias("kept"))


def _described(docs: DataFrame, key: str, text: str, shingle: int, bands: int, width: int, counted: bool) -> DataFrame:
    def of_piece(cut: Texts) -> pa.Array:
        elements, first, times = shingles(cut, shingle)
        weights = times.astype(np.float64) if counted else np.ones(len(elements))
        marks = elements ^ mix(times.astype(np.uint64)) if counted else elements
        flat = band_hashes(signatures(elements, first, weights, bands * width), bands, width).view(np.int64).reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(_node(marks, first), pa.binary()), lists], ["node", "bands"])

    @F.arrow_udf("struct<node:binary,bands:array<long>>")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _by_pieces(batches, of_piece)

    return docs.select(
        F.col(quoted(key)).alias("id"), F.xxhash64(F.col(quoted(text)).cast("string")).alias("version"),
        F.monotonically_increasing_id().alias("ordinal"), describe(F.col(quoted(text)).cast("string")).alias("d")
    ).select("id", "version", "ordinal", "d.node", "d.bands")


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame, shingle: int, counted: bool) -> DataFrame:
    """(node, elements) of the wanted nodes, read again from their texts."""
    def of_piece(cut: Texts) -> pa.Array:
        found, first, times = shingles(cut, shingle)
        names = _node(found ^ mix(times.astype(np.uint64)) if counted else found, first)
        if counted:  # the n-th occurrence of a shingle is an element by itself
            ends = np.concatenate([[0], np.cumsum(times)])
            found = mix(np.repeat(found, times) + spread(np.zeros(len(times), np.int64), times).astype(np.uint64))
            first = ends[first]
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found.view(np.int64)))
        return pa.StructArray.from_arrays([pa.array(names, pa.binary()), lists], ["node", "elements"])

    @F.arrow_udf("struct<node:binary,elements:array<long>>")
    def elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _by_pieces(batches, of_piece)

    ids = wanted.select(F.col("id").alias("_id")).distinct()
    if wanted.count() <= BROADCAST_NODES:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(quoted(key)).alias("_key"), F.col(quoted(text)).cast("string").alias("_text"))
    texts = texts.join(ids, F.col("_key").eqNullSafe(F.col("_id")), "left_semi")
    found = texts.select(elements("_text").alias("d")).select("d.node", "d.elements").where(F.col("node").isNotNull())
    # Rows that share a key may bring nodes nobody asked for, or one node twice.
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _links(docs: DataFrame, nodes: DataFrame, key: str, text: str, similarity: float, shingle: int,
           counted: bool) -> DataFrame | None:
    """(node, label) for all nodes that have a link: the label is the same for connected nodes. None without links."""
    filled = nodes.select("node", "id", F.posexplode("bands").alias("band", "hash"))
    shared = filled.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1")
    active = filled.join(shared, ["band", "hash"])
    popular = active.groupBy("node").agg(F.sum("n").alias("popular"))
    active = stored(active.join(popular, "node"), "near-buckets")
    sets = stored(_sets(docs, key, text, active.select("node", "id").distinct(), shingle, counted), "near-sets")
    # The member that meets most others, such as the original among its copies, is compared with all of its bucket.
    pivots = active.groupBy("band", "hash").agg(F.max_by("node", F.struct("popular", "node")).alias("pivot"))
    pairs = active.select("band", "hash", "node").join(pivots, ["band", "hash"]).where("node <> pivot")
    alike = stored(_alike(pairs.select("node", "pivot").distinct(), sets, similarity), "near-links")
    labels = None if alike.isEmpty() else _components(alike)
    # What this leaves apart in a bucket is dealt anew, by rarest elements.
    active = _open(_with_labels(active.select("band", "hash", "node"), labels))
    active = _rarest(_able(stored(active, "near-open"), sets, similarity), sets)
    chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("others")
    most = 1
    while True:
        active = stored(_others(_open(active)), "near-buckets")
        if active.isEmpty():
            return labels
        # Pivots are members outside the bucket's largest component, each time four times as many, until all have been.
        most *= 4
        pivots = active.where((F.col("label") != F.col("main")) & (chance < most)).select(
            "band", "hash", F.col("node").alias("pivot"), F.col("label").alias("_label"))
        pairs = active.select("band", "hash", "node", "label").join(pivots, ["band", "hash"]).where("label <> _label")
        ends = [F.least("node", "pivot").alias("node"), F.greatest("node", "pivot").alias("pivot")]
        alike = stored(_alike(pairs.select(*ends).distinct(), sets, similarity), "near-links")
        active = active.where(F.col("others") > most).select("band", "hash", "node", "label")
        if not alike.isEmpty():
            labels = _components(alike) if labels is None else _united(labels, alike)
            active = _with_labels(active.drop("label"), labels)


def _with_labels(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    return rows.withColumn("label", F.col("node")) if labels is None else _labelled(rows, labels, "node", "label")


def _open(rows: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    several = rows.groupBy("band", "hash").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return rows.join(several.select("band", "hash"), ["band", "hash"])


def _others(rows: DataFrame) -> DataFrame:
    """With each bucket's largest component (main) and how many members are outside of it (others)."""
    sizes = rows.groupBy("band", "hash", "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band", "hash").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), (F.sum("n") - F.max("n")).alias("others"))
    return rows.join(main, ["band", "hash"])


def _able(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Members that may be alike to a node of another component, and how many elements they then share at least.

    Sets A and B are alike only if they share at least s / (1 + s) x (|A| + |B|)
    elements, and |B| is neither below s x |A| nor below the least of the bucket.
    So a node with too few elements that occur in another component at all, such
    as a copy with many changes of its own, needs no comparison.
    """
    nodes = rows.select("node", "label").distinct().join(sets, "node")
    elements = nodes.select("node", "label", F.size("elements").alias("size"), F.explode("elements").alias("element"))
    mixed = (elements.groupBy("element").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low <> high").select("element"))
    support = elements.join(mixed, "element").groupBy("node").agg(
        F.first("size").alias("size"), F.count("*").alias("shared"))
    known = rows.join(support, "node")
    least = known.groupBy("band", "hash").agg(F.min("size").alias("least"))
    needed = similarity / (1 + similarity) * (F.col("size") + F.greatest(F.col("size") * similarity, F.col("least"))) - 1e-6
    able = known.join(least, ["band", "hash"]).withColumn("needed", needed)
    return able.where(F.col("shared") >= F.col("needed")).select(*rows.columns, "needed")


def _rarest(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The members dealt to a bucket for each of their rarest elements.

    Let all elements be in one order. Sets that share k elements share one even
    among the first |A| - k + 1 of each (prefix filter). Elements of a single
    component come first, as nobody is to be found by them, then those that
    occur least.
    """
    open_ = stored(_open(rows), "near-able").groupBy("node").agg(F.any_value("label").alias("label"), F.min("needed").alias("needed"))
    nodes = open_.join(sets, "node")
    ahead = (F.size("elements") - F.ceil("needed") + 1).cast("int")
    elements = nodes.select("node", "label", ahead.alias("ahead"), F.explode("elements").alias("element"))
    known = elements.groupBy("element").agg(
        (F.min("label") != F.max("label")).alias("mixed"), F.count("*").alias("times"))
    placed = elements.join(known, "element").groupBy("node").agg(
        F.first("label").alias("label"), F.first("ahead").alias("ahead"),
        F.sort_array(F.collect_list(F.struct("mixed", "times", "element"))).alias("order"))
    first = placed.select("node", "label", F.explode(F.slice("order", 1, "ahead")).alias("e")).where("e.mixed")
    return first.select(F.lit(-1).alias("band"), F.col("e.element").alias("hash"), "node", "label")


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """The label of a node column, the node itself if it has none."""
    known = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    joined = rows.join(known, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(name, F.coalesce("_label", column)).drop("_node", "_label")


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are similar enough, compared element by element."""
    mine = sets.select(F.col("node"), F.col("elements").alias("mine"))
    theirs = sets.select(F.col("node").alias("pivot"), F.col("elements").alias("theirs"))
    sizes = [F.size("mine"), F.size("theirs")]
    common = F.size(F.array_intersect("mine", "theirs"))
    return (pairs.join(mine, "node").join(theirs, "pivot")
            .where(F.least(*sizes) >= F.lit(similarity) * F.greatest(*sizes))
            .where(common >= F.lit(similarity) * (sizes[0] + sizes[1] - common)).select("node", "pivot"))


def _united(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only the components these connect are gone through again."""
    ends = links.select("node").unionByName(links.select(F.col("pivot").alias("node"))).distinct()
    known = labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    between = _labelled(_labelled(links, labels, "node", "a"), labels, "pivot", "b").select(
        F.col("a").alias("node"), F.col("b").alias("pivot")).distinct()
    moved = _components(between).select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return stored(known.join(moved, "label", "left").select("node", F.coalesce("_to", "label").alias("label")), "near-labels")


def _components(links: DataFrame) -> DataFrame:
    """(node, label): least node of each connected component, by spreading labels and jumping to the label's label."""
    edges = links.select("node", F.col("pivot").alias("other"))
    edges = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    labels = stored(edges.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")),
                    "near-labels")
    while True:
        heard = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
        spread_ = labels.unionByName(heard).groupBy("node").agg(F.min("label").alias("label"))
        jump = spread_.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
        after = stored(jump.select("node", F.least("label", F.coalesce("next", "label")).alias("label")), "near-labels")
        changed = after.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old")
        if changed.isEmpty():
            return after
        labels = after
