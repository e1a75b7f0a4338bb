"""The operators on training text, each against a brute-force version or an exact round trip."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from txflow.llm import bpe, byte_dedup, decontaminate, language, line_dedup, near_dedup, repeats, sharding, warc, word_dedup
from txflow.llm.batch import texts_of, words_of
from txflow.llm.common import table
from txflow.llm.exact_dedup import exact_classes, frequent
from txflow.llm.queries import QUERIES, ranks_file

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names could clash with those that operators use inside.
EXTRA = ("id", "key", "version", "ordinal", "node", "bucket", "digest", "kept", "_key", "_text", "n_lines")
LONG = "lorem ipsum dolor sit amet " * 40_000


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and repeated keys."""
    passage = " ".join(f"word{i}" for i in range(70))
    lines = "\n".join(f"a line of text number {i}" for i in range(9))
    texts = [None, "", " \n\t ", passage, passage, "x " + passage + " y", LONG, LONG[:-1], lines, "top\n" + lines + "\nend",
             "é" * 60, "é" * 60, "aaaa" * 40, "!?!", "one two", "one  two", "ONE two", passage[:200] + " but then it ends otherwise"]
    rows = [(i, t, "en" if i % 3 else None, "s", 1) for i, t in enumerate(texts)]
    return rows + [(5, passage, None, None, None), (5, "x " + passage + " y", None, None, None), (5, "x " + passage + " y", None, None, None),
                   (None, passage, None, None, None), (None, None, None, None, None), (None, lines, "de", "t", 2), (None, lines, "de", "t", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), DOCS)
    for name in EXTRA:
        df = df.withColumn(name, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- repeated byte strings and word runs -------------------------------------------------------------------------

NULLS = 1 << 63


def covered(items, width):
    """For each (key, symbols): which symbols a window that starts under a smaller key covers."""
    first = {}
    for key, symbols in items:
        for i in range(len(symbols) - width + 1):
            window = tuple(symbols[i:i + width])
            first[window] = min(first.get(window, NULLS), key)
    for key, symbols in items:
        gone = [False] * len(symbols)
        for i in range(len(symbols) - width + 1):
            if first[tuple(symbols[i:i + width])] < key:
                gone[i:i + width] = [True] * width
        yield key, symbols, gone


def brute_bytes(rows, width):
    items = [(NULLS - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    out = Counter()
    for key, symbols, gone in covered(items, width):
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(s for s, g in zip(symbols, gone) if not g)
        out[None if key == NULLS - 1 else key, len(symbols), sum(gone), spans, kept] += 1
    return out


def brute_words(rows, width):
    items = [(NULLS - 1 if k is None else k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    out = Counter()
    for key, symbols, gone in covered(items, width):
        kept = " ".join(s for s, g in zip(symbols, gone) if not g).encode()
        out[None if key == NULLS - 1 else key, len(symbols), sum(gone), kept] += 1
    return out


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["docs", "short", "none"])
def test_repeated_bytes(request, name):
    df = request.getfixturevalue("odd").where("text IS NULL OR length(text) < 2000") if name == "short" else request.getfixturevalue(name)
    got = byte_dedup.drop_repeated_bytes(df)
    found = Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect())
    assert found == brute_bytes(pairs_of(df), 50)


@pytest.mark.parametrize("name", ["docs", "short", "none"])
def test_repeated_words(request, name):
    df = request.getfixturevalue("odd").where("text IS NULL OR length(text) < 2000") if name == "short" else request.getfixturevalue(name)
    got = word_dedup.drop_repeated_words(df)
    found = Counter((r[0], r[1], r[2], bytes(r[3])) for r in got.collect())
    assert found == brute_words(pairs_of(df), 50)


def test_long_texts_lose_their_repeats(spark):
    rows = [(1, LONG), (2, "before " + LONG + " after"), (3, "unlike the others")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in byte_dedup.drop_repeated_bytes(df).collect():
        # One blank more than the text itself: the string from there on also is in its middle.
        assert r.n_removed == (len(LONG) + 1 if r.doc_id == 2 else 0)
        assert bytes(r.kept) == {1: LONG.encode(), 2: b"before after", 3: b"unlike the others"}[r.doc_id]
    for r in word_dedup.drop_repeated_words(df).collect():
        assert bytes(r.kept) == {1: LONG.strip().encode(), 2: b"before after", 3: b"unlike the others"}[r.doc_id]



def test_rows_alike_go_through_the_passes_once(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(70))
    rows = [(1, passage + " first")] + [(None, "x " + passage)] * 25_001 + [(7, "twice " + passage)] * 3 + [(7, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, store = [], repeats.stored

    def stored(frame, label):
        kept.append(store(frame, label))
        return kept[-1]

    monkeypatch.setattr(repeats, "stored", stored)
    found = Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in word_dedup.drop_repeated_words(df).collect())
    assert found == {(1, 71, 0, (passage + " first").encode()): 1, (None, 71, 70, b"x"): 25_001,
                     (7, 71, 70, b"twice"): 3, (7, 1, 0, b"other"): 1}
    assert kept[0].where(F.col("kind") == repeats._RESULT).count() <= 4


def test_hot_passages_take_the_wide_way(spark, monkeypatch):
    """One passage between different words in very many texts; contexts go on by context, stretches are short."""
    monkeypatch.setattr(repeats, "WIDE", 2)
    monkeypatch.setattr(repeats, "STRETCH", 256)
    monkeypatch.setattr(repeats, "FLUSH", 500)
    rng = np.random.default_rng(5)
    hot = " ".join(f"hot{i}" for i in range(60))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 30)) + " " + hot[:int(rng.integers(60, len(hot)))] + " "
             + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 30)) for _ in range(150)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in byte_dedup.drop_repeated_bytes(df).collect())
    assert found == brute_bytes(rows, 50)
    found = Counter((r[0], r[1], r[2], bytes(r[3])) for r in word_dedup.drop_repeated_words(df, width=20, grain=6).collect())
    assert found == brute_words(rows, 20)


def test_radix_groups_equal_keys():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 50, 3000).astype(np.uint64) << np.uint64(14), rng.integers(0, 9, 3000).astype(np.uint64) << np.uint64(31)
    order, new = byte_dedup.radix_groups(high, low)
    groups = defaultdict(set)
    for g, i in zip(np.cumsum(new), order):
        groups[int(g)].add((int(high[i]), int(low[i])))
    assert sorted(order) == list(range(3000)) and all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(zip(high.tolist(), low.tolist())))


# --- lines -------------------------------------------------------------------------------------------------------

def brute_lines(rows):
    """Rows are (key, text); null keys come first, then by key."""
    from xxhash import xxh64

    def signed(t):
        x = xxh64(t.encode(), seed=42).intdigest()
        return x - (1 << 64) if x >> 63 else x

    def place(k, t, i):
        return (k is not None, k or 0, signed(t), i)

    first = {}
    for k, t in rows:
        lines = t.split("\n") if t is not None else []
        for i in range(len(lines) - 2):
            run = tuple(lines[i:i + 3])
            first[run] = min(first.get(run, place(k, t, i)), place(k, t, i))
    out = Counter()
    for k, t in rows:
        lines = t.split("\n") if t is not None else []
        gone = set()
        for i in range(len(lines) - 2):
            if first[tuple(lines[i:i + 3])] != place(k, t, i):
                gone |= {i, i + 1, i + 2}
        out[k, None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)] += 1
    return out


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_lines(request, name):
    df = request.getfixturevalue(name)
    got = line_dedup.line_dedup(df, counts=("total", "gone"))
    assert got.columns == [*df.columns, "total", "gone"]
    assert rows_of(got, "doc_id", "text", "total", "gone") == brute_lines(pairs_of(df))


# --- shards ------------------------------------------------------------------------------------------------------

def brute_shard(key, shards):
    def draw(at):
        seed = 42 if key is None else xxhash.xxh64(int(key).to_bytes(8, "little", signed=True), seed=42).intdigest()
        return xxhash.xxh64(int(at).to_bytes(8, "little", signed=True), seed=seed).intdigest() >> 33

    at, ahead = 0, 0
    while ahead < shards:
        at = ahead
        ahead = int((at + 1) * ((1 << 31) / (draw(at) + 1)))
    return at


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_shards(request, name):
    df = request.getfixturevalue(name)
    got = sharding.assign_shards(df, 16, cells=8, cell_rows=5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in pairs_of(df))
    slots = defaultdict(list)
    for r in got:
        assert (r.law, r.shard, r.grown_shard) == ("key", brute_shard(r.doc_id, 16), brute_shard(r.doc_id, 17))
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even_and_many(spark):
    keys = spark.range(20_000)
    counts = [r["count"] for r in keys.groupBy(sharding.jump_shard(F.col("id"), 10)).count().collect()]
    assert len(counts) == 10 and 1800 < min(counts) and max(counts) < 2200
    some = keys.limit(200).select("id", sharding.jump_shard(F.col("id"), 300).alias("s")).collect()
    assert all(r.s == brute_shard(r.id, 300) for r in some)


# --- benchmark ---------------------------------------------------------------------------------------------------

def brute_contamination(texts, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i:i + width])].add(item)
    out = Counter()
    for key, text in texts:
        w, hit, found = words(text), set(), set()
        for window, names in windows.items():
            for i in range(len(w) - len(window) + 1):
                if w[i] == window[0] and tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= names
        out[key, len(w), len(hit), tuple(sorted(str(f) for f in found if f is not None))] += 1
    return out


@pytest.mark.parametrize("block", [1 << 24, 300])
def test_contamination(spark, odd, block):
    small = odd.where("text IS NULL OR length(text) < 2000")
    items = [(1, "Word3 word4, WORD5 word6 word7 word8 word9 word10 word11 word12 word13"), (2, "one two"), (3, None), (4, "?!"),
             (None, "line of text number 3"), (2, "é" * 60), (7, "one two"), (8, "absent words here"), (10, "word1 word2")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("clash"))
    got = decontaminate.contamination(small, bench, name="found", block_bytes=block)
    found = Counter((r.doc_id, r.found.n_words, r.found.n_hit, tuple(r.found["items"])) for r in got.collect())
    assert found == brute_contamination(pairs_of(small), items)


def test_contamination_by_items_of_few_words(spark):
    """Items and texts of digits: very many windows share their rarest word, and no pair of them is made."""
    draw = random.Random(4)
    digits = lambda n: " ".join(draw.choice("0123456789") for _ in range(n))
    items = [(f"i{i}", digits(200)) for i in range(12)]
    texts = [(0, digits(2000)), (1, digits(50) + " " + items[7][1][60:120] + " " + digits(50)), (2, "1 " * 1000), (3, "4 2")]
    items += [("short", "4 2"), ("same", "1 " * 12)]
    got = decontaminate.contamination(
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string"), name="found")
    found = Counter((r.doc_id, r.found.n_words, r.found.n_hit, tuple(r.found["items"])) for r in got.collect())
    assert found == brute_contamination(texts, items)


def test_stretches_change_nothing(monkeypatch):
    draw = random.Random(5)
    item = [" ".join(draw.choice("abc") for _ in range(60)) for _ in range(3)]
    column = texts_of(pa.array([" ".join(draw.choice("abc") for _ in range(5000)), item[1], ""]))
    places = words_of(column, decontaminate.WORD_BYTES)
    block = decontaminate.Windows(["x", "y", "z"], item, 4)
    hashes = block.hashing.runs(block.hashing.sums(block.hashing.values[column.data]), places.begin, places.end)
    block.order(np.ones(len(block.vocabulary), np.int64))
    whole = sorted(zip(*(a.tolist() for a in block.occurrences(column, places, hashes))))
    monkeypatch.setattr(decontaminate, "STRETCH", 7)
    assert sorted(zip(*(a.tolist() for a in block.occurrences(column, places, hashes)))) == whole and len(whole) > 1000


def test_contamination_of_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert all(r.c.n_hit == 0 for r in decontaminate.contamination(odd, bench, name="c").collect())
    assert decontaminate.contamination(none, table(spark, SF, "benchmark")).count() == 0


# --- language ----------------------------------------------------------------------------------------------------

def brute_grams(text):
    import unicodedata

    line = "".join(c.lower()[0] if unicodedata.category(c)[0] == "L" else " " for c in text or "")
    line = " " + re.sub(" +", " ", line).strip() + " " if line.strip() else ""
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            gram = line[i:i + n]
            if gram != " " and not (n == 3 and gram[1] == " "):
                out[gram] += 1
    return out


def test_grams_are_those_of_the_rule():
    texts = ["", "Ab, cd!", "é1x", "  a b  ", "ÀÉ-ß", "none\nleft", "!!", "日本 語"]
    cell, first = language.grams(texts_of(pa.array(texts)), language._letters())
    for i, text in enumerate(texts):
        mine = Counter(cell[first[i]:first[i + 1]].tolist())
        assert sorted(mine.values()) == sorted(brute_grams(text).values())


def brute_cell(gram):
    """The cell of an n-gram, in plain integers."""
    code = sum((0 if c == " " else ord(c)) << 21 * i for i, c in enumerate(gram)) | (len(gram) == 2) << 63
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        code = (code ^ code >> shift) * by % 2**64
    return (code ^ code >> 31) >> 64 - 17


def brute_languages(docs, place):
    """Key to predicted language and score; ``place`` is what an n-gram is counted under, which also orders ties."""
    def top(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:400]]

    def counted(text):
        out = Counter()
        for gram, n in brute_grams(text).items():
            out[place(gram)] += n
        return out

    seen = {r.doc_id: counted(r.text) for r in docs}
    learned = {}
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned.setdefault(r.lang, Counter()).update(seen[r.doc_id])
    profiles = {lang: {g: i for i, g in enumerate(top(counts))} for lang, counts in learned.items()}
    out = {}
    for r in docs:
        mine = top(seen[r.doc_id])
        if not mine:
            out[r.doc_id] = ("und", 0.0)
            continue
        off = {lang: sum(abs(profile[g] - i) if g in profile else 400 for i, g in enumerate(mine)) for lang, profile in profiles.items()}
        best = min(sorted(off), key=off.get)
        out[r.doc_id] = (best, 1 - off[best] / (400 * len(mine)))
    return out


def test_languages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows, got = docs.collect(), {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    theirs = brute_languages(rows, brute_cell)
    assert got.keys() == theirs.keys() and len(got) == len(rows)
    for key, (lang, score) in theirs.items():
        assert got[key][0] == lang and abs(got[key][1] - score) < 1e-12
    # Hashing to cells costs nothing: the n-grams themselves give the same languages.
    plain = brute_languages(rows, lambda gram: gram)
    assert sum(plain[key][0] == got[key][0] for key in plain) >= 0.999 * len(plain)


def test_language_of_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language.identify(docs).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    mine = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in mine) >= 0.99 * len(mine)


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    hidden = docs.withColumn("lang", F.when(~language.held_out(F.col("doc_id")), F.col("lang")).otherwise("xx"))
    assert rows_of(language.identify(docs), "doc_id", "lang_pred", "score") == rows_of(language.identify(hidden), "doc_id", "lang_pred", "score")


def test_language_of_odd_rows(odd, none):
    for r in language.identify(odd).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        if r.text is None or not re.search(r"[^\W\d_]", r.text):
            continue
        assert r.lang_pred in ("en", "de")
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd).collect()}
    assert {(0, "und"), (1, "und"), (13, "und")} <= got
    assert language.identify(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


# --- BPE ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(ranks_file())


@pytest.fixture(scope="module")
def reference_encoding():
    import tiktoken

    with open(ranks_file(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(vocab, reference_encoding):
    rng = np.random.default_rng(2)
    alphabet = list("aab 'sстrevlmd\n\t 1２é!?.   ")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(list("atheinor"), rng.integers(0, 300))) for _ in range(300)]
    texts += ["x" * 5000, "don't we'll I'm 's 'sabc 're", "  a\n\n b \t\tc   ", "\n's 'v", "\r\n\r\n x", "日本語 12٣ ½ Ⅷ", "a\x1cb \x85c", ""]
    ids, first = bpe.encode_batch(texts_of(pa.array(texts)), vocab)
    for i, text in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == reference_encoding.encode_ordinary(text)


def test_bpe_round_trip_and_clashing_hashes(odd, none, vocab, reference_encoding, monkeypatch):
    df = odd.withColumn("ids", bpe.encode(F.col("text"), vocab)).withColumn("bytes", bpe.decode(F.col("ids"), vocab))
    df = df.withColumn("both", bpe.round_trip(F.col("text"), vocab))
    for r in df.collect():
        assert bytes(r.bytes) == (r.text or "").encode()
        if r.text is None or len(r.text) < 2000:
            assert list(r.ids) == reference_encoding.encode_ordinary(r.text or "")
        assert (r.both.ids, r.both.bytes) == (r.ids, r.bytes)
    assert none.select(bpe.encode(F.col("text"), vocab), bpe.round_trip(F.col("text"), vocab)).collect() == []
    # A hash that sends different words to one value is noticed by decoding, and another one is taken.
    plain = bpe.RunHash

    def poor(seed):
        h = plain(seed)
        if seed == 1:
            h.values[:] = h.values[0]
        return h

    monkeypatch.setattr(bpe, "RunHash", poor)
    ids, _ = bpe.encode_batch(texts_of(pa.array(["abc abd xyz"])), vocab)
    assert ids.tolist() == reference_encoding.encode_ordinary("abc abd xyz")


def test_bpe_reads_broken_utf8_as_replacement(spark, vocab, reference_encoding):
    df = spark.sql("SELECT CAST(x'61ff62' AS STRING) AS text").select(bpe.encode(F.col("text"), vocab).alias("ids"))
    assert list(df.first().ids) == reference_encoding.encode_ordinary("a�b")


# --- near duplicates ---------------------------------------------------------------------------------------------

def brute_classes(rows, least=0.8):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= least * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        classes[root(i)].append(k)
    out = Counter()
    for keys in classes.values():
        known = [k for k in keys if k is not None]
        for k in keys:
            out[k, min(known) if known else None, len(keys)] += 1
    return out, len(classes)


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_near_classes(request, name):
    df = request.getfixturevalue(name)
    expected, classes = brute_classes(pairs_of(df))
    got = near_dedup.near_classes(df).cache()
    assert rows_of(got, "doc_id", "class_id", "class_size") == expected
    assert got.where("kept").count() == classes
    left = near_dedup.near_unique(df)
    assert left.columns == df.columns and left.count() == classes


def test_near_classes_of_many_variants(spark):
    """A large group of near copies, of which not all are alike to one pivot."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            copy[at] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(f"y{x}" for x in rng.integers(0, 10**6, 80))) for i in range(20)]
    expected, classes = brute_classes(rows)
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "class_id", "class_size") == expected


def test_variants_alike_to_few_are_not_compared_with_all(spark, monkeypatch):
    """Variants whose changes recur in others, most of them below the least similarity: comparisons grow with the group, not its square."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        copy = [f"w{j}" for j in range(120)]
        for at in rng.integers(0, 120, 6 if i % 3 else 2):
            copy[at] = f"x{rng.integers(5)}"
        rows.append((i, " ".join(copy)))
    compared, alike = [], near_dedup._alike

    def counting(pairs, sets, similarity):
        compared.append(pairs.count())
        return alike(pairs, sets, similarity)

    monkeypatch.setattr(near_dedup, "_alike", counting)
    expected, classes = brute_classes(rows)
    assert classes > 20
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "class_id", "class_size") == expected
    assert sum(compared) < 40 * len(rows), compared


def test_results_are_handed_on_by_pieces():
    """A worker holds what it made of half a megabyte of text, not of a whole batch."""
    texts = ["some words " * 30_000] * 5 + ["", None]
    got = list(near_dedup._by_pieces(iter([pa.array(texts), pa.array([], pa.string())]), lambda cut: pa.array(np.diff(cut.starts))))
    assert len(got) > 2
    assert [n for part in got for n in part.to_pylist()] == [len(t or "") for t in texts]


@pytest.mark.parametrize("counted", [False, True])
def test_signatures_estimate_similarity(counted):
    rng = np.random.default_rng(4)
    for share in (0.3, 0.6, 0.9):
        a = rng.integers(1, 2**62, 400).astype(np.uint64)
        b = np.concatenate([a[:int(400 * share)], rng.integers(1, 2**62, 400 - int(400 * share)).astype(np.uint64)])
        w = rng.uniform(0.2, 3.0, 400) if counted else np.ones(400)
        first = np.array([0, 400, 800])
        s = near_dedup.signatures(np.concatenate([a, b]), first, np.concatenate([w, w]), 2000)
        same = w[:int(400 * share)].sum()
        assert abs((s[0] == s[1]).mean() - same / (2 * w.sum() - same)) < 0.05


def test_counted_shingles(spark):
    twice = "a b c d e f g h " * 30
    rows = [(1, twice), (2, "a b c d e f g h " * 28), (3, "a b c d e f g h " * 4)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(
        spark.createDataFrame(rows, "doc_id long, text string"), counted=True).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


# --- WARC --------------------------------------------------------------------------------------------------------

def page_rows():
    big = "".join(f"<p>paragraph {i} é</p>\r\n\r\n" for i in range(3000))
    same = "<html>" + "same " * 300 + "</html>"
    return [(1, "http://a/", same), (2, "http://b/", same), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "u", "short"), (6, "u", "short"),
            (7, "u", big), (8, "u", big), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 50), (None, "n", same), (9, "u", same[:999]),
            (2, "http://b/", same)]


def brute_pages(rows):
    out = Counter()
    groups = defaultdict(list)
    for k, _, h in rows:
        groups[h or ""].append(k)
    for k, _, h in rows:
        body = (h or "").encode()
        largest = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(body) >= 1000 and k != largest
        out[k, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", largest if revisit else None] += 1
    return out


@pytest.mark.parametrize("segment,chunk", [(1 << 20, 1 << 18), (700, 256), (100, 10_000)])
def test_archives(spark, folder, segment, chunk):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    warc.write_archives(warc.plan_records(pages), folder, segment=segment)
    rows = warc.read_archives(spark, folder, chunk=chunk).cache()
    last = rows.where("last").collect()
    assert all(r.intact for r in last)
    assert Counter((int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_digest, r.record_type,
                    int(r.refers_to) if r.refers_to else None) for r in last) == brute_pages(page_rows())
    whole = rows.where("record_type = 'response' AND page_id = '8'").orderBy("chunk").collect()
    assert [r.chunk for r in whole] == list(range(len(whole))) and all(len(r.data) <= chunk for r in whole)
    assert b"".join(bytes(r.data) for r in whole).decode() == page_rows()[7][2]


def test_archives_of_no_pages(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.plan_records(pages), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_broken_archive_is_an_error():
    import gzip

    whole = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 500\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 400\r\n\r\nxx")
    with pytest.raises((ValueError, KeyError)):
        list(warc._records(warc.Stream(pa.py_buffer(whole)), 100))


# --- exact copies ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["docs", "odd", "none"])
@pytest.mark.parametrize("limits", [{}, {"counters": 3}, {"counters": 3, "rows": 2, "most": 1}])
def test_exact_classes(request, name, limits):
    df = request.getfixturevalue(name)
    groups = defaultdict(list)
    for k, t in pairs_of(df):
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(k)
    expected = Counter()
    for digest, keys in groups.items():
        known = [k for k in keys if k is not None]
        for k in keys:
            expected[k, min(known) if known else None, len(keys), digest] += 1
    got = exact_classes(df, **limits).cache()
    assert rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256") == expected
    assert Counter(r.text_sha256 for r in got.where("kept").collect()) == Counter(groups.keys())


def test_frequent_values_are_found(spark):
    values = [b"a"] * 500 + [b"b"] * 300 + [bytes([i % 256, i // 256]) for i in range(1200)]
    df = spark.createDataFrame([(v,) for v in values], "digest binary").repartition(6)
    found = {bytes(r.digest) for r in frequent(df, len(values), 15).collect()}
    assert {b"a", b"b"} <= found and len(found) <= 16


def test_ordinary_digests_are_bounded_by_rows(spark):
    """With many rare texts a digest that is rare by its share, but not by its rows, is still among the frequent ones."""
    texts = ["many"] * 40 + [f"text {i}" for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    total = len(texts)
    digest = df.select(F.sha2("text", 256).alias("digest"))
    many = hashlib.sha256(b"many").hexdigest()
    assert many in {r.digest for r in frequent(digest, total, -(-2 * total // 39)).collect()}
    got = exact_classes(df, counters=8, rows=39).where("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 40)} and sum(r.kept for r in got) == 1 and len(got) == 40


# --- pipeline ----------------------------------------------------------------------------------------------------

def test_stages_keep_the_columns(spark, odd, none):
    for df in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, SF).columns == df.columns, name
        assert set(corpus_pipeline.STAGES[-1][1](spark, df, SF).columns) >= {"doc_id", "n_tokens"}


def test_pipeline_is_its_stages_by_brute_force(spark, docs, reference_encoding):
    rows = {r.doc_id: r.text for r in docs.collect()}
    guess = {r.doc_id: r for r in language.identify(docs).collect()}
    rows = {k: t for k, t in rows.items() if guess[k].lang_pred != "und" and guess[k].score >= corpus_pipeline.LEAST_SCORE}
    lines = {k: (t, n, gone) for k, t, n, gone in brute_lines(list(rows.items()))}
    rows = {k: t for k, (t, n, gone) in lines.items() if not gone or gone < n}
    classes, _ = brute_classes(list(rows.items()))
    rows = {k: rows[k] for k, first, _ in classes if k == first}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    hit = {k for k, _, n, _ in brute_contamination(list(rows.items()), items) if n}
    expected = set()
    for k, t in rows.items():
        if k not in hit:
            ids = reference_encoding.encode_ordinary(t)
            expected.add((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected and len(hit) > 0


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}


def test_bpe_results_go_on_cut_by_cut(vocab, monkeypatch):
    monkeypatch.setattr(bpe, "MERGED_BYTES", 1000)
    texts = [f"text {i} " * 30 for i in range(40)] + [None, ""]
    parts = list(bpe._by_cuts(iter([pa.array(texts), pa.array([], pa.string())]), lambda cut: bpe._lists(*bpe.encode_batch(cut, vocab))))
    assert len(parts) >= 10 and max(len(part) for part in parts) <= 8
    ids = [row for part in parts for row in part.to_pylist()]
    assert ids == bpe._lists(*bpe.encode_batch(texts_of(pa.array(texts)), vocab)).to_pylist()
