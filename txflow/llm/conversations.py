"""Repair of conversation structure: the cheapest edits after which turns alternate as they should.

A conversation is well formed if its role initials are empty or an optional
system turn followed by one or more pairs of user and assistant. Rows are kept,
given another role or deleted, and empty turns inserted. Edits are found as
the shortest path of an acyclic graph whose weights are single big integers:
the high digits are the cost, the low digits, one octal digit at a fixed place
for each edit, its letter in the audit trail, with zeros after the last. The
ordinary minimum of integers then decides both the cost and the ties.

Prefixes that have consumed the same rows at the same cost differ before either
ends, so what follows can't change which is less: minima may be taken row by
row, and also block by block. Conversations of more than ROWS rows or BYTES
bytes of text are never gathered: blocks of their rows become tables of the
cheapest ways from each state to each, and those are joined in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow import skew
from txflow.llm.common import quoted, stored

#: What edits cost (fixed values). A row whose text breaks off costs BROKEN more unless it is deleted.
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3
#: White space, and the marks that end a text (fixed values).
SPACE, MARKS = " \t\n\x0b\x0c\r", (".", "!", "?")
#: A longer conversation goes through in blocks of BLOCK rows; so many such may be broadcast.
ROWS, BYTES, BLOCK, FEW = 4096, 1 << 23, 1024, 100_000

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_LETTERS = "DIKR"  # in order of their character codes
_TO_LETTERS = str.maketrans("1234", _LETTERS)
_TO_DIGITS = str.maketrans(_LETTERS, "1234")

_TURNS = "array<struct<edit:string,role:string,text:string>>"
_REPORT = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"


class Row(NamedTuple):
    """What edits depend on; ``n`` equal rows in a run, of which all but the first repeat an earlier one."""

    initial: str
    fault: str  # blank, duplicate, truncated or nothing
    n: int = 1


class Way(NamedTuple):
    """The cheapest edits from one state to another."""

    cost: int
    audit: str


# --- the shortest path --------------------------------------------------------------------------------------------


def ways(rows: Sequence[Row], entry: int, ended: bool = False) -> dict[int, Way]:
    """The cheapest edits of ``rows`` from ``entry`` to every state that can be reached.

    Inserts come before the row they precede. Those after the last row are only
    made if it ``ended`` the conversation.
    """
    width = sum(row.n for row in rows) + 2 * len(rows) + 2  # never more than two inserts in one place
    unit = 1 << 3 * width

    def step(path: tuple[int, int] | None, cost: int, letter: str, n: int = 1) -> tuple[int, int] | None:
        if path is None:
            return None
        weight, size = path
        digits = (_LETTERS.index(letter) + 1) * ((1 << 3 * n) - 1) // 7
        return weight + cost * unit + (digits << 3 * (width - size - n)), size + n

    def least(*paths: tuple[int, int] | None) -> tuple[int, int] | None:
        return min((p for p in paths if p is not None), default=None)

    def inserted(at: list) -> list:
        user = least(at[USER], *[step(at[s], INSERT, "I") for s in (START, SYSTEM, ASSISTANT)])
        return [at[START], at[SYSTEM], user, least(at[ASSISTANT], step(user, INSERT, "I"))]

    at: list[tuple[int, int] | None] = [None] * 4
    at[entry] = (0, 0)
    for initial, fault, n in rows:
        before = inserted(at)
        # Deletions need no inserts before them: those sort after them.
        deleted = [step(path, DELETE * n, "D", n) for path in at]
        if fault in ("blank", "duplicate"):
            at = deleted
            continue
        more = BROKEN if fault == "truncated" else 0
        kept: list[tuple[int, int] | None] = [None] * 4
        if initial == "s":
            kept[SYSTEM] = step(before[START], more, "K")
        to_user = least(before[START], before[SYSTEM], before[ASSISTANT])
        kept[USER] = step(to_user, more, "K") if initial == "u" else step(to_user, more + REROLE, "R")
        kept[ASSISTANT] = step(before[USER], more, "K") if initial == "a" else step(before[USER], more + REROLE, "R")
        if n > 1:
            kept = [step(path, DELETE * (n - 1), "D", n - 1) for path in kept]
        at = [least(*some) for some in zip(deleted, kept)]
    if ended:
        at = inserted(at)

    def read(path: tuple[int, int]) -> Way:
        weight, size = path
        return Way(weight >> 3 * width, format(weight & (unit - 1), "o").zfill(width)[:size].translate(_TO_LETTERS))

    return {state: read(path) for state, path in enumerate(at) if path is not None}


def follow(audit: str, state: int, initials: Sequence[str], runs: Sequence[int] | None = None) -> list[list[tuple[str, int | None]]]:
    """For each row the edits up to and with its own, each with the state it leads to (None: the row goes).

    The edits after the last row come as one list more.
    """
    out: list[list[tuple[str, int | None]]] = []
    edits, row, left = [], 0, 0
    for letter in audit:
        if letter == "I" or letter == "R" or letter == "K":
            state = SYSTEM if letter == "K" and initials[row] == "s" and state == START else _FOLLOWS[state]
        edits.append((letter, None if letter == "D" else state))
        if letter != "I":
            left = left or (runs[row] if runs else 1)
            left -= 1
            if not left:
                out.append(edits)
                edits, row = [], row + 1
    return [*out, edits]


class Join:
    """The cheapest ways through blocks taken one after the other, for one conversation."""

    def __init__(self):
        self.front: dict[int, Way] = {START: Way(0, "")}
        self.settled: list[str] = []
        self.steps: list[dict[int, tuple[int, str]]] = []

    def add(self, block: dict[tuple[int, int], Way]) -> None:
        """``block`` has a way for each pair of states that it can lead between."""
        found: dict[int, tuple[Way, int, str]] = {}
        for (entry, leave), way in block.items():
            if entry in self.front:
                before = self.front[entry]
                whole = Way(before.cost + way.cost, before.audit + way.audit)
                if leave not in found or _scalar(whole, found[leave][0]) < _scalar(found[leave][0], whole):
                    found[leave] = (whole, entry, way.audit)
        self.steps.append({leave: (entry, audit) for leave, (_, entry, audit) in found.items()})
        # What all remaining ways begin with is decided.
        audits = [whole.audit for whole, _, _ in found.values()]
        low, high = min(audits), max(audits)
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        self.settled.append(low[:same])
        self.front = {leave: Way(whole.cost, whole.audit[same:]) for leave, (whole, _, _) in found.items()}

    def end(self) -> tuple[Way, list[tuple[int, str]], str]:
        """The whole way, each block's entry state and edits, and the inserts after the last block."""
        last = {}
        for state, way in self.front.items():
            for to, more in ways([], state, ended=True).items():
                if to in (START, ASSISTANT):
                    last[state, to] = (Way(way.cost + more.cost, way.audit + more.audit), more.audit)
        best = None
        for at in last:
            if best is None or _scalar(last[at][0], last[best][0]) < _scalar(last[best][0], last[at][0]):
                best = at
        whole, inserts = last[best]
        state, taken = best[0], []
        for step in reversed(self.steps):
            entry, audit = step[state]
            taken.append((entry, audit))
            state = entry
        return Way(whole.cost, "".join(self.settled) + whole.audit), taken[::-1], inserts


def _scalar(way: Way, other: Way) -> int:
    """The weight of a way, with places for the longer of two."""
    width = max(len(way.audit), len(other.audit), 1)
    return (way.cost << 3 * width) + int(way.audit.translate(_TO_DIGITS).ljust(width, "0"), 8)


# --- tables -------------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The damage rule of the query: conv_id, turn, role, text, and whether the row is ``gone``.

    The checksum of ``conv_id:turn`` modulo 20 decides: 0 drops a row (it stays
    here, marked, so that its conversation is known), 1 empties its text, 2 takes
    out its end marks, 3 repeats it, 4 makes it the user's. Nulls read as one
    space, but for the conversation and the turn, which stay null.
    """
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    changed = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", ""))
               .when(kind == 0, "").otherwise(text("text")))
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"), changed.alias("text"), (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, twice).otherwise(once)).alias("_copy")).drop("_copy")


def repair(rows: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES, block: int = BLOCK) -> DataFrame:
    """Repair conversations: conv_id, place, turns, report.

    ``rows`` has conv_id (of any simple type), turn (long), role, text, and may
    have ``gone``: such a row only tells that its conversation exists. ``turns``
    are the turns that remain or are inserted, in order of ``place`` and then of
    the list; the row with place -1 has the ``report``: gaps in the numbering,
    rows with a blank, duplicate or truncated text (the first that is so counts),
    neighbours whose roles don't follow each other, cost, and audit trail.

    Rows go by turn, those without first; rows of one turn by role, then text,
    bytewise. A null role, text or conv_id reads as one space, as the empty text
    and as a conversation of its own. Equal rows are duplicates of each other.
    An empty table gives an empty result, other columns are ignored.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    rows = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "conv_id",
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), gone.alias("gone"))
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("size"))
    large = stored(sizes.where((F.col("n") > most_rows) | (F.col("size") > most_bytes)).select("conv"), "conversations-large")
    count = large.count()
    many, few = skew.split(rows, skew.Heavy("conv", large if count else None, False, count <= FEW))
    out = _repair_gathered(few)
    return out if many is None else out.unionByName(_repair_blocks(many, rows.schema["conv_id"].dataType, block))


def _faults(rows: DataFrame) -> DataFrame:
    """Adds whether a text is blank, and whether it is truncated."""
    bare = F.rtrim("text", F.lit(SPACE))
    return rows.withColumns({"blank": bare == "", "open": ~F.right(bare, F.lit(1)).isin(*MARKS)})


class Tally:
    """Counts over rows in order, or over blocks of them."""

    def __init__(self):
        self.turns: tuple[int, int, int] | None = None  # first, last, different ones
        self.ends: tuple[str, str] | None = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0

    def add(self, turns: tuple[int, int, int] | None, ends: tuple[str, str], faults: dict[str, int], illegal: int) -> None:
        if turns is not None:
            if self.turns is None:
                self.turns = turns
            else:
                first, last, different = self.turns
                self.turns = (first, turns[1], different + turns[2] - (turns[0] == last))
        if self.ends is not None:
            illegal += self.ends[1] + ends[0] not in ("su", "ua", "au")
        self.ends = (ends[0] if self.ends is None else self.ends[0], ends[1])
        self.illegal += illegal
        for name, n in faults.items():
            self.faults[name] += n

    def row(self, turn: int | None, row: Row) -> None:
        if row.n > 1:  # the others of a run are blank if the first is, else duplicates
            again = row.n - 1
            self.add(None if turn is None else (turn, turn, 1), (row.initial, row.initial),
                     {"blank" if row.fault == "blank" else "duplicate": again}, again)
            if row.fault:
                self.faults[row.fault] += 1
        else:
            self.add(None if turn is None else (turn, turn, 1), (row.initial, row.initial), {row.fault: 1} if row.fault else {}, 0)

    def report(self, way: Way) -> dict:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return {"gaps": gaps, **self.faults, "illegal": self.illegal, "cost": way.cost, "audit": way.audit}


def _repair_gathered(rows: DataFrame) -> DataFrame:
    """One conversation after the other; each is short."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, place long, turns {_TURNS}, report {_REPORT}"

    def solve(conv_id, some: list) -> dict:
        seen, listed, tally = set(), [], Tally()
        for turn, role, text, blank, open_ in some:
            twin = (role, hashlib.sha256(text.encode()).digest())
            row = Row(role[:1], "blank" if blank else "duplicate" if twin in seen else "truncated" if open_ else "")
            seen.add(twin)
            listed.append(row)
            tally.row(turn, row)
        found = ways(listed, START, ended=True)
        best = found[START]
        if ASSISTANT in found and _scalar(found[ASSISTANT], best) < _scalar(best, found[ASSISTANT]):
            best = found[ASSISTANT]
        turns = []
        for i, edits in enumerate(follow(best.audit, START, [row.initial for row in listed])):
            for letter, state in edits:
                if letter == "K":
                    turns.append({"edit": letter, "role": some[i][1], "text": some[i][2]})
                elif letter != "D":
                    turns.append({"edit": letter, "role": _ROLES[state], "text": some[i][2] if letter == "R" else ""})
        return {"conv_id": conv_id, "place": -1, "turns": turns, "report": tally.report(best)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, conv_id, some, out, size = None, None, [], [], 0
        arrow = None
        for batch in batches:
            arrow = arrow or pa.schema([
                ("conv_id", batch.schema.field("conv_id").type), ("place", pa.int64()),
                ("turns", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))),
                ("report", pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                                     + [("audit", pa.string())]))])
            names, ids, gone = batch.column(0).to_pylist(), batch.column(1), batch.column(7).to_pylist()
            columns = [batch.column(c) for c in range(2, 7)]
            for i, name in enumerate(names):
                if name != at:
                    if at is not None:
                        out.append(solve(conv_id, some))
                        size += sum(len(row[2]) + 100 for row in some)
                        if size > BYTES:
                            yield pa.RecordBatch.from_pylist(out, arrow)
                            out, size = [], 0
                    at, conv_id, some = name, ids[i].as_py(), []
                if not gone[i]:
                    some.append(tuple(c[i].as_py() for c in columns))
        if at is not None:
            out.append(solve(conv_id, some))
            yield pa.RecordBatch.from_pylist(out, arrow)

    return (_faults(rows).select("conv", "conv_id", "turn", "role", "text", "blank", "open", "gone")
            .repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(run, schema))


def _repair_blocks(rows: DataFrame, conv_type, block: int) -> DataFrame:
    """Long conversations: rows are put in order, blocks of them solved, and the blocks joined."""
    spark, order = rows.sparkSession, ("conv", "turn", "role", "text")
    ids = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows follow each other, so one stands for all of them. The beginning of a text is enough to deal rows by.
    runs = _faults(rows.where(~F.col("gone")).groupBy(*order).agg(F.count("*").alias("n")))
    placed = stored(runs.repartitionByRange(tasks, "conv", "turn", "role", F.left("text", F.lit(64)))
                    .sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "conversations-placed")
    first = (placed.where(~F.col("blank")).groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("place").alias("place"))
             .select("place", F.lit(True).alias("fresh")))
    fault = F.when(F.col("blank"), "blank").when(F.col("fresh").isNull(), "duplicate").when(F.col("open"), "truncated").otherwise("")
    judged = placed.drop("text").join(first, "place", "left").select(
        "conv", "place", F.expr(f"place div {block}").alias("block"),
        F.struct("place", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "n").alias("row"))
    blocks = judged.groupBy("conv", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    way = "struct<entry:int,leave:int,cost:long,audit:string>"
    counted = "turns array<long>, ends array<string>, faults array<long>, illegal long"

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                listed, tally = [], Tally()
                for row in record["rows"]:
                    one = Row(row["initial"], row["fault"], row["n"])
                    listed.append(one)
                    tally.row(row["turn"], one)
                found = [{"entry": entry, "leave": leave, "cost": best.cost, "audit": best.audit}
                         for entry in range(4) for leave, best in ways(listed, entry).items()]
                yield pa.RecordBatch.from_pylist([{
                    "conv": record["conv"], "block": record["block"], "places": [r["place"] for r in record["rows"]],
                    "initials": [r.initial for r in listed], "runs": [r.n for r in listed], "ways": found,
                    "turns": tally.turns and list(tally.turns), "ends": list(tally.ends),
                    "faults": list(tally.faults.values()), "illegal": tally.illegal}], solved_arrow)

    def arrow_of(ddl: str) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        return to_arrow_schema(_parse_datatype_string(ddl))

    solved_ddl = (f"conv string, block long, places array<long>, initials array<string>, runs array<long>, "
                  f"ways array<{way}>, {counted}")
    joined_ddl = f"conv string, place long, edits array<struct<edit:string,state:int>>, report {_REPORT}"
    solved_arrow, joined_arrow = arrow_of(solved_ddl), arrow_of(joined_ddl)
    solved = stored(blocks.mapInArrow(solve, solved_ddl), "conversations-blocks")

    def taken(conv: str, held: list, join: Join, tally: Tally) -> Iterator[pa.RecordBatch]:
        way, blocks_taken, inserts = join.end()
        last, state = -1, START
        for (places, initials, counts), (entry, audit) in zip(held, blocks_taken):
            edits = follow(audit, entry, initials, counts)
            yield pa.RecordBatch.from_pylist([
                {"conv": conv, "place": place, "report": None,
                 "edits": [{"edit": e, "state": s} for e, s in some if s is not None]}
                for place, some in zip(places, edits)], joined_arrow)
            last = places[-1]
            for some in edits:
                for _, to in some:
                    state = state if to is None else to
        rest = []
        for letter in inserts:
            state = _FOLLOWS[state]
            rest.append({"edit": letter, "state": state})
        yield pa.RecordBatch.from_pylist([
            {"conv": conv, "place": last + 1, "edits": rest, "report": None},
            {"conv": conv, "place": -1, "edits": [], "report": tally.report(way)}], joined_arrow)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, join, tally = None, [], Join(), Tally()
        for batch in batches:
            for i in range(batch.num_rows):
                record = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                if record["conv"] != conv:
                    if conv is not None:
                        yield from taken(conv, held, join, tally)
                    conv, held, join, tally = record["conv"], [], Join(), Tally()
                join.add({(w["entry"], w["leave"]): Way(w["cost"], w["audit"]) for w in record["ways"]})
                tally.add(record["turns"] and tuple(record["turns"]), tuple(record["ends"]),
                          dict(zip(tally.faults, record["faults"])), record["illegal"])
                held.append((record["places"], record["initials"], record["runs"]))
        if conv is not None:
            yield from taken(conv, held, join, tally)

    decided = stored(solved.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(combine, joined_ddl),
                     "conversations-edits")

    def kept(edit: Column) -> Column:
        role = F.when(edit["edit"] == "K", F.col("role")).when(edit["state"] == USER, "user").otherwise("assistant")
        text = F.when(edit["edit"] == "I", "").otherwise(F.col("text"))
        return F.struct(edit["edit"].alias("edit"), role.alias("role"), text.alias("text"))

    lines = (decided.where(F.size("edits") > 0).drop("report").join(placed.select("conv", "place", "role", "text"), ["conv", "place"], "left")
             .select("conv", "place", F.transform("edits", kept).alias("turns")))
    nothing = [F.lit(0).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    # A conversation of which nothing is left has no blocks.
    report = F.coalesce("report", F.struct(*nothing, F.lit("").alias("audit"))).alias("report")
    reports = ids.join(decided.where(F.col("report").isNotNull()).select("conv", "report"), "conv", "left")
    return (ids.join(lines, "conv").select("conv_id", "place", "turns", F.lit(None).cast(_REPORT).alias("report"))
            .unionByName(reports.select("conv_id", F.lit(-1).cast("long").alias("place"), F.array().cast(_TURNS).alias("turns"), report)))


def text_digests(repaired: DataFrame) -> DataFrame:
    """conv_id, report, repaired_sha256: the digest of ``role:text`` of all turns, joined by newlines.

    The turns of a long conversation pass its digest one by one: the checksum
    depends on their order, but nothing has to hold them.
    """
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    rows = repaired.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
                           "conv_id", "place", "report", line.alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"conv": [at], "digest": [digest.hexdigest()]})

        for batch in batches:
            for conv, line in zip(batch.column(0), batch.column(1)):
                if conv.as_py() != at:
                    if digest is not None:
                        yield out()
                    at, digest = conv.as_py(), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.as_py().encode())
        if digest is not None:
            yield out()

    long = (rows.where(F.col("place") >= 0).repartition("conv").sortWithinPartitions("conv", "place").select("conv", "line")
            .mapInArrow(run, "conv string, digest string"))
    # Digests are made before the join, so that it moves no texts.
    short = rows.where(F.col("place") < 0).withColumn("own", F.sha2(F.col("line").cast("binary"), 256)).drop("line")
    return short.join(long, "conv", "left").select("conv_id", "report", F.coalesce("digest", "own").alias("repaired_sha256"))
