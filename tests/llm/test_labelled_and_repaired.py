"""Toxicity, conversation repair and spelling variants, against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txflow.llm import conversations, spelling, toxicity
from txflow.llm.common import table

SF = "/root/testdata/sf0.001"
EXTRA = ("id", "key", "word", "n", "near", "conv", "place", "block", "gone_", "order", "y", "cells", "score", "held_out")


# --- conversations -----------------------------------------------------------------------------------------------


def cheapest(rows):
    """All edits of a few rows that end well formed, the cheapest and then least first."""
    best = [None]

    def go(i, roles, cost, audit, inserts):
        if (best[0] and cost > best[0][0]) or not re.fullmatch("s?(ua)*u?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best[0] = min(filter(None, (best[0], (cost, audit))))
        if inserts < 2:
            for role in "ua":
                go(i, roles + role, cost + 3, audit + "I", inserts + 1)
        if i < len(rows):
            initial, fault = rows[i][:2]
            go(i + 1, roles, cost + 4, audit + "D", 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                go(i + 1, roles + (initial or "?"), cost + more, audit + "K", 0)
                for role in "ua":
                    go(i + 1, roles + role, cost + more + 3, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best[0]


def some_rows(seed, count, most):
    pick = random.Random(seed)
    for _ in range(count):
        yield [conversations.Row(pick.choice("suauax") if pick.random() < 0.95 else "",
                                 pick.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(pick.randint(0, most))]


def test_ways_are_the_cheapest():
    for rows in some_rows(1, 150, 4):
        found = conversations.ways(rows, conversations.START, ended=True)
        ends = [found[s] for s in (conversations.START, conversations.ASSISTANT) if s in found]
        assert min((w.cost, w.audit) for w in ends) == cheapest(rows)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_join_to_the_whole(size):
    for rows in some_rows(size, 100, 14):
        found = conversations.ways(rows, conversations.START, ended=True)
        whole = min((found[s] for s in (conversations.START, conversations.ASSISTANT) if s in found),
                    key=lambda w: (w.cost, w.audit))
        join = conversations.Join()
        for at in range(0, len(rows), size):
            join.add({(entry, leave): way for entry in range(4) for leave, way in conversations.ways(rows[at:at + size], entry).items()})
        assert join.end()[0] == whole


def test_runs_are_rows_repeated():
    pick = random.Random(5)
    for rows in some_rows(5, 100, 6):
        runs = [r._replace(n=pick.randint(1, 3)) for r in rows]
        each = [one for r in runs for one in [r._replace(n=1)] + [conversations.Row(r.initial, "duplicate")] * (r.n - 1)]
        assert conversations.ways(runs, 0, ended=True) == conversations.ways(each, 0, ended=True)


def repaired(rows):
    """What the query returns for each conversation, from lists of rows."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        groups[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, some in groups.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, listed = set(), []
        for _, role, text in some:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            listed.append((role[:1], fault))
        turns = {t for t, _, _ in some if t is not None}
        cost, audit = cheapest(listed)
        lines, left, roles = [], iter(some), []
        for letter in audit:
            row = next(left) if letter != "I" else None
            if letter != "D":
                role = row[1] if letter == "K" else "assistant" if roles and roles[-1] == "u" else "user"
                roles.append(role[:1])
                lines.append(role + ":" + (row[2] if row else ""))
        faults = Counter(f for _, f in listed)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        yield (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"],
               faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def talks(spark):
    pick = random.Random(2)
    rows = [(conv, pick.choice([None, 1, 2, 2, 3, 7]), pick.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
             pick.choice(["So it is.", "well", None, "", " \n", "ok!  ", "ok!  ", "é."]))
            for conv in (1, 2, 3, 4, 5, None, 7) for _ in range(pick.randint(1, 6))]
    rows += [(8, 1, "user", "word. " * 50_000), (8, 2, "assistant", "x" * 300_000), (9, None, "user", "a."), (9, None, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in EXTRA:
        df = df.withColumn(name, F.lit("clash"))
    return rows, df.cache()


def result(rows, **how):
    return conversations.text_digests(conversations.repair(conversations.damaged(rows), **how)).select(
        "conv_id", "report.*", "repaired_sha256")


@pytest.mark.parametrize("how", [{}, {"most_rows": 0, "block": 2}])
def test_conversations(talks, how):
    rows, df = talks
    assert Counter(tuple(r) for r in result(df, **how).collect()) == Counter(repaired(rows))


@pytest.mark.parametrize("how", [{}, {"most_rows": 0}])
def test_no_conversations(talks, how):
    assert result(talks[1].where("false"), **how).collect() == []


def test_one_conversation_of_many_rows(spark):
    """Most rows of one conversation equal each other, and none of it meets in one task but for its digest."""
    rows = spark.range(30_000).select(
        F.lit(1).alias("conv_id"), F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 3 > 0, "again.").otherwise(F.concat(F.lit("turn "), "id", F.lit("."))).alias("text"))
    found = conversations.text_digests(conversations.repair(rows, block=512)).select("report.*", "repaired_sha256").collect()
    listed, seen, lines = [], set(), []
    some = sorted(rows.collect(), key=lambda r: (r.turn, r.role, r.text))
    for r in some:
        listed.append(conversations.Row(r.role[:1], "duplicate" if (r.role, r.text) in seen else ""))
        seen.add((r.role, r.text))
    way = min((w for s, w in conversations.ways(listed, 0, ended=True).items() if s in (0, 3)), key=lambda w: (w.cost, w.audit))
    for row, edits in zip([*some, None], conversations.follow(way.audit, 0, [r.initial for r in listed])):
        for letter, state in edits:
            if state is not None:
                lines.append(("user" if state == 2 else "assistant") + ":" + ("" if letter == "I" else row.text))
    assert [(r.cost, r.audit, r.repaired_sha256) for r in found] == [
        (way.cost, way.audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())]


# --- spelling ----------------------------------------------------------------------------------------------------


def variants(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    beside = {w: [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size[size] if near(v, w)] for w in words}
    form = {}
    for w, some in beside.items():
        top = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n, len(beside[w]), words.get(form[w])


def spellings(df, **how):
    return Counter(tuple(r) for r in spelling.spelling_variants(df, **how).collect())


def test_spelling_of_documents(spark):
    docs = table(spark, SF, "documents")
    assert spellings(docs) == Counter(variants([(r.doc_id, r.text) for r in docs.collect()]))


@pytest.fixture(scope="module")
def spelt(spark):
    pick = random.Random(4)
    words = ["abcdef"] * 40 + ["abcdex"] * 18 + ["abcdx"] * 8 + ["abxdx"] * 3 + ["ÀÉÎõü", "ààààà", "aààààà", "zzzzz", "zzzzzz", "éabcdef"]
    rows = [(i, " ".join(pick.choice([str.upper, str.lower, str])(w) if w.isascii() else w for w in pick.choices(words, k=60))) for i in range(20)]
    long = "lang" * 2_000
    rows += [(None, None), (50, ""), (51, "!?! 12 ß"), (None, "abcdef abcdef"), (52, "plain words " * 20_000), (52, "plain"), (52, "plain")]
    rows += [(60 + i, f"{long} {long}x") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in EXTRA:
        df = df.withColumn(name, F.lit("clash"))
    return rows, df.cache()


@pytest.mark.parametrize("symbols", [2, 12])
def test_spelling_of_odd_rows(spelt, symbols, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3000)
    monkeypatch.setattr(spelling, "STRETCH", 1000)
    rows, df = spelt
    assert spellings(df, symbols=symbols) == Counter(variants(rows))


def test_spelling_of_nothing(spelt):
    assert spellings(spelt[1].where("false")) == Counter()


def test_chains_of_forms(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(23)], "word string, form string")
    assert {(r.word, r.root) for r in spelling.roots(chain).collect()} == {(f"w{i}", "w23") for i in range(23)}


def test_bitmap_holds_back_no_word(spark):
    words = spelling.vocabulary(spelling.occurrences(table(spark, SF, "documents")), 3, 12)
    pairs = [{tuple(r) for r in spelling.near_words(words, 12, bits).collect()} for bits in (6, 16)]
    assert pairs[0] == pairs[1] != set()


# --- toxicity ----------------------------------------------------------------------------------------------------


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    judged = toxicity.scores(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    good, bad = ([r.score for r in judged if r.toxic == y] for y in (0, 1))
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(good) * len(bad))
    assert above > 0.95
    assert sum(r.predicted == r.toxic for r in judged) > 0.95 * len(judged)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in judged)


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    first, second = (sorted(map(tuple, toxicity.scores(d, l).collect())) for d, l in ((docs, labels), (other, turned)))
    assert first == second


def grams(text):
    words = [bytes(b + 32 if 65 <= b < 91 else b for b in w) for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    out = {("one", w) for w in words}
    for gap in (1, 2, 3):
        out |= {(gap, a, b) for a, b in zip(words, words[gap:])}
    return out | {("three", *w) for w in zip(words, words[1:], words[2:])}


def test_features_are_words_pairs_triples_and_skips():
    from txflow.llm.batch import texts_of
    import pyarrow as pa

    texts = ["You are, you ARE a clown", "", "é idiot!", "one", "a b", "a b c a b c a b d " * 30]
    cells = toxicity.Features(31)
    found = [set(c.tolist()) for c in cells.cells(texts_of(pa.array(texts)))]
    assert [len(c) for c in found] == [len(grams(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(found[i] & found[j]) == len(grams(a) & grams(b))


def brute_weights(rows, epochs):
    """FTRL-proximal over dictionaries, as its authors write it down."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0 if i == -1 else toxicity.L1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - l1 * (1 if z[i] > 0 else -1)) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for y, cells in rows:
            w = {i: weight(i) for i in [*cells, -1]}
            g = 1 / (1 + 2.718281828459045 ** -sum(w.values())) - y
            for i in w:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


def test_weights_are_those_of_the_rule(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "L1", 0.7)
    pick = random.Random(6)
    rows = [(k, int(k % 3 == 0), sorted(pick.sample(range(40), 5) + [50 + k % 3])) for k in range(60)]
    found = toxicity.learn(spark.createDataFrame(rows, "order long, y int, cells array<int>").repartition(5), epochs=3)
    expected = brute_weights([r[1:] for r in rows], 3)
    assert found.constant == pytest.approx(expected.pop(-1, 0.0))
    assert dict(zip(found.cells.tolist(), found.values.tolist())) == pytest.approx(expected)


def test_toxicity_of_odd_rows(spelt, spark):
    rows, df = spelt
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(None, 1, 1), (50, 1, None), (0, 0, 0), (1, 0, 1), (1, 0, 1), (2, 0, 7), (999, 1, 1)], none.schema)
    assert {(r.score, r.predicted) for r in toxicity.scores(df, none).collect()} == {(0.5, 1)}
    judged = toxicity.scores(df, few).collect()
    assert Counter(r.doc_id for r in judged) == Counter(key for key, _ in rows)
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in judged)
    assert toxicity.scores(df.where("false"), few).collect() == []
