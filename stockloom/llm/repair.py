"""Repair of conversations: the cheapest edits that give a lawful order of roles, by Knuth's lightest derivations.

Rows are kept, given the other role, deleted or, if missing, inserted, until the initials of the roles read
`(s?(ua)+)?`. "The rows from i on, when the roles so far led to state q, can be repaired" is an item; it follows from
an edit of row i (or an insertion before it) and the item that edit leads to. Items carry (cost, rows, audit), the
audit being the initials of the edits. An edit goes in front, adds its cost and its row, and so never makes an item
lighter, and a lighter item never makes a heavier one: the functions are superior, and the agenda may settle an
item when it is popped. The number of rows stands between cost and audit because keeping a row costs nothing; of
one item all derivations cover the same rows, so it does not change which is best: least cost, then the
first audit in ASCII order.

Two audits of the same rows between the same states and of the same cost never begin one another, since only
insertions could follow and they cost. Best audits of consecutive stretches may therefore be put together. A
conversation longer than a stretch is solved like that: each stretch from every state to every state, in
tasks of their own, then one vector of states is carried over the stretches. What all states agree on is
written out at once. Only the digest has to see the rows of a conversation one after another; they stream.

Defined results: null role or text is one space, as is a null id or turn in the checksum that damages a row. Null ids
are one conversation. Null turns come first; equal turns stay in the order of the table. A row whose role has
another initial than s, u or a can only be given a role or deleted. Texts may be of any length: conversations are
held up to STRETCH rows and STRETCH_BYTES of text, longer ones in stretches. A conversation without rows
has zeros, an empty audit and the digest of an empty text. Columns other than the four are ignored, and an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import ship, stored
from stockloom.operators.ordered import ordered_chunks, running_total

# Costs of the edits, white space, and the marks a finished sentence ends with.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: A conversation of more rows or bytes of text is solved in stretches of that many rows.
STRETCH = 1000
STRETCH_BYTES = 8 << 20

# The states of `(s?(ua)+)?`: nothing yet, after s, after u, after a.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
MOVES = {(NOTHING, "s"): AFTER_S, (NOTHING, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
FINAL = (NOTHING, AFTER_A)
STATES = range(4)
LAWFUL = {"su", "ua", "au"}

Item = Hashable
Weight = tuple[int, int, str]


@dataclass
class Deduction:
    """A hyperedge: `head` follows from `tails`, with the weight `weigh` gives for theirs."""

    head: Item
    tails: tuple[Item, ...]
    weigh: Callable[..., Weight]
    open: int = field(init=False)

    def __post_init__(self) -> None:
        self.open = len(self.tails)


def lightest(deductions: Iterable[Deduction], goal: Item | None = None) -> dict[Item, Weight]:
    """Knuth's agenda for superior functions: the lightest weights of all items up to the goal, or of all there are."""
    uses: dict[Item, list[Deduction]] = {}
    agenda: list[tuple[Weight, Item]] = []
    for d in deductions:
        if not d.tails:
            heapq.heappush(agenda, (d.weigh(), d.head))
        for tail in d.tails:
            uses.setdefault(tail, []).append(d)
    settled: dict[Item, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in settled:
            continue
        settled[item] = weight
        if item == goal:
            break
        for d in uses.get(item, ()):
            d.open -= 1
            if not d.open and d.head not in settled:
                heapq.heappush(agenda, (d.weigh(*[settled[t] for t in d.tails]), d.head))
    return settled


@dataclass(frozen=True)
class Row:
    initial: str
    lost: bool  # blank or a duplicate: must be deleted
    truncated: bool


def added_role(state: int) -> str:
    """The only role a state lets in by force."""
    return "assistant" if state == AFTER_U else "user"


def in_front(edit: Weight, rest: Weight) -> Weight:
    return edit[0] + rest[0], edit[1] + rest[1], edit[2] + rest[2]


def repairs(rows: list[Row], exits: Iterable[int]) -> Iterator[Deduction]:
    """The deductions of some rows. Items: (row, state), and (row, state, edit) for the edits themselves."""
    n = len(rows)
    for state in exits:
        yield Deduction((n, state), (), lambda: (0, 0, ""))
    for i in range(n + 1):
        for state in STATES:
            forced = MOVES[state, added_role(state)[0]]
            edits = [("I", COSTS["I"], i, forced)]
            if i < n:
                row = rows[i]
                extra = TRUNCATED_COST if row.truncated else 0
                edits.append(("D", COSTS["D"], i + 1, state))
                if not row.lost:
                    edits.append(("R", COSTS["R"] + extra, i + 1, forced))
                    if (state, row.initial) in MOVES:
                        edits.append(("K", COSTS["K"] + extra, i + 1, MOVES[state, row.initial]))
            for edit, cost, j, reached in edits:
                yield Deduction((i, state, edit), (), lambda w=(cost, j - i, edit): w)
                yield Deduction((i, state), ((i, state, edit), (j, reached)), in_front)


def best_repair(rows: list[Row]) -> tuple[int, str]:
    """(cost, audit) of the lightest repair of a whole conversation."""
    goal = (0, NOTHING)
    cost, _, audit = lightest(repairs(rows, FINAL), goal)[goal]
    return cost, audit


def crossings(rows: list[Row]) -> list[dict]:
    """The lightest repair of a stretch from every state to every state."""
    out = []
    for leave in STATES:
        settled = lightest(repairs(rows, [leave]))
        for enter in STATES:
            if (0, enter) in settled:
                cost, _, audit = settled[0, enter]
                out.append({"enter": enter, "leave": leave, "cost": cost, "audit": audit})
    return out


class Applied:
    """Applies an audit to rows as they come, and digests the repaired lines."""

    def __init__(self) -> None:
        self.state, self.cost, self.audit, self.lines = NOTHING, 0, [], 0
        self.digest = hashlib.sha256()
        self.pending: list[str] = []

    def line(self, role: str, text: str, initial: str) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.lines += 1
        self.digest.update(role.encode() + b":")
        self.digest.update(text.encode())
        self.state = MOVES[self.state, initial]

    def edits(self, audit: str) -> None:
        """The edits of the rows that come next; those left over from before are insertions."""
        self.finish()
        self.audit.append(audit)
        self.pending = list(reversed(audit))

    def insertions(self) -> None:
        while self.pending and self.pending[-1] == "I":
            self.pending.pop()
            role = added_role(self.state)
            self.cost += COSTS["I"]
            self.line(role, "", role[0])

    def row(self, role: str, text: str, truncated: bool) -> None:
        self.insertions()
        edit = self.pending.pop()
        self.cost += COSTS[edit] + (TRUNCATED_COST if truncated and edit != "D" else 0)
        if edit == "R":
            role = added_role(self.state)
        if edit != "D":
            self.line(role, text, role[0])

    def finish(self) -> None:
        self.insertions()


class Path:
    """Carries the best repair to every state over the stretches of a conversation, and lets go of what is decided."""

    def __init__(self) -> None:
        self.costs = {NOTHING: 0}
        self.steps: list[tuple[object, dict[int, dict]]] = []  # per stretch: its label, the crossing used to reach each state

    def trace(self, state: int, last: dict | None = None) -> str:
        """The audit that leads to a state, from the first stretch still held."""
        parts = [last["audit"]] if last else []
        for _, used in reversed(self.steps):
            parts.append(used[state]["audit"])
            state = used[state]["enter"]
        return "".join(reversed(parts))

    def add(self, label: object, ways: list[dict]) -> Iterator[tuple[object, str]]:
        used: dict[int, dict] = {}
        costs: dict[int, int] = {}
        for way in ways:
            if way["enter"] not in self.costs:
                continue
            cost, leave = self.costs[way["enter"]] + way["cost"], way["leave"]
            if leave not in used or cost < costs[leave] or (
                cost == costs[leave] and self.trace(way["enter"], way) < self.trace(used[leave]["enter"], used[leave])
            ):
                used[leave], costs[leave] = way, cost
        self.steps.append((label, used))
        self.costs = costs
        alive = set(costs)
        for at in range(len(self.steps) - 1, -1, -1):
            alive = {self.steps[at][1][s]["enter"] for s in alive}
            if len(alive) == 1 and at:
                yield from self.settle(at, alive.pop())
                break

    def settle(self, until: int, state: int) -> Iterator[tuple[object, str]]:
        """Give out the first stretches, of which the last leads to `state`."""
        chosen = []
        for label, used in reversed(self.steps[:until]):
            chosen.append((label, used[state]["audit"]))
            state = used[state]["enter"]
        self.steps = self.steps[until:]
        yield from reversed(chosen)

    def end(self) -> Iterator[tuple[object, str]]:
        best = min((s for s in FINAL if s in self.costs), key=lambda s: (self.costs[s], self.trace(s)))
        yield from self.settle(len(self.steps), best)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, row, copy): the rows after damage, in the order of (turn, row, copy). `conv` is the id
    as text that is never null."""
    def space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        group_of(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"),
        space("text").alias("text"), F.monotonically_increasing_id().alias("row"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("fate"),
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "row",
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def group_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("c"), conv_id.cast("string")), F.lit("n"))


def marked(rows: DataFrame) -> DataFrame:
    """Add whether a row is blank or truncated."""
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    return rows.withColumns({"blank": solid == "", "truncated": (solid != "") & ~F.right(solid, F.lit(1)).isin(*ENDS)})


RESULT = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("gaps", T.LongType()), T.StructField("blank", T.LongType()),
    T.StructField("duplicate", T.LongType()), T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
])


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def sent(rows: Iterator[dict], schema: T.StructType, size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, a few at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds, held = to_arrow_schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, kinds)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, kinds)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:]))


def solve(conv: str, turns: list, roles: list[str], texts: list[str], blank: list[bool], truncated: list[bool]) -> dict:
    """Counts and repair of one whole conversation."""
    seen: set[tuple[str, str]] = set()
    rows, copies, short = [], 0, 0
    for role, text, empty, open_ended in zip(roles, texts, blank, truncated):
        again = (role, text) in seen
        seen.add((role, text))
        copies += again and not empty
        short += open_ended and not again
        rows.append(Row(role[:1], empty or again, open_ended))
    cost, audit = best_repair(rows)
    applied = Applied()
    applied.edits(audit)
    for role, text, row in zip(roles, texts, rows):
        applied.row(role, text, row.truncated)
    applied.finish()
    known = [t for t in turns if t is not None]
    return {
        "conv": conv, "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, "blank": sum(blank),
        "duplicate": copies, "truncated": short, "illegal": illegal([r.initial for r in rows]), "cost": cost, "audit": audit,
        "repaired_sha256": applied.digest.hexdigest(),
    }


def repaired_whole(rows: DataFrame) -> DataFrame:
    """Conversations that are held whole, one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[dict]:
            for conv, group in groupby(rows_in(batches), key=lambda r: r[0]):
                yield solve(conv, *[list(c) for c in list(zip(*group))[1:]])

        return sent(results(), RESULT)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "row", "copy")
    return ordered.select("conv", "turn", "role", "text", "blank", "truncated").mapInArrow(run, RESULT)


WAY = T.StructType([
    T.StructField("enter", T.IntegerType()), T.StructField("leave", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("audit", T.StringType()),
])
WAYS = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("stretch", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("ways", T.ArrayType(WAY)),
])
CHOSEN = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("stretch", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("edits", T.StringType()),
])
DIGEST = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
    T.StructField("repaired_sha256", T.StringType()),
])


def repaired_in_stretches(rows: DataFrame) -> DataFrame:
    """Conversations of any length: numbered rows, stretches solved apart, then put together."""
    order = ["conv", "turn", "row", "copy"]
    numbered = running_total(ordered_chunks(rows.withColumn("_one", F.lit(1).cast("long")), order), ["conv"], order[1:], {"_n": "_one"})
    numbered = numbered.select(
        "conv", "turn", "role", "text", "blank", "truncated", (F.col("_n_end") - 1).alias("place"),
        F.expr(f"(_n_end - 1) div {STRETCH}").alias("stretch"),
        F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"),
    )
    numbered = stored(numbered, "numbered")
    # Rows met before are few: only texts that occur again take part in the join.
    firsts = numbered.groupBy("conv", "same").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    flagged = numbered.join(firsts, ["conv", "same"], "left").withColumn(
        "again", F.coalesce(F.col("place") > F.col("first"), F.lit(False))).drop("same", "first")
    flagged = stored(flagged, "flagged")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[dict]:
            for (conv, stretch), group in groupby(rows_in(batches), key=lambda r: r[:2]):
                part = [Row(initial, lost, truncated) for _, _, initial, lost, truncated in group]
                initials = [r.initial for r in part]
                yield {"conv": conv, "stretch": stretch, "illegal": illegal(initials), "first": initials[0], "last": initials[-1],
                       "ways": crossings(part)}

        return sent(results(), WAYS, 20)

    def path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[dict]:
            for conv, group in groupby(rows_in(batches), key=lambda r: r[0]):
                way, before = Path(), None
                for _, stretch, bad, first, last, ways in group:
                    bad += before is not None and before + first not in LAWFUL
                    before = last
                    yield from ({"conv": conv, "stretch": s, "illegal": b, "edits": a} for (s, b), a in way.add((stretch, bad), ways))
                yield from ({"conv": conv, "stretch": s, "illegal": b, "edits": a} for (s, b), a in way.end())

        return sent(results(), CHOSEN, 200)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[dict]:
            for conv, group in groupby(rows_in(batches), key=lambda r: r[0]):
                applied = Applied()
                for _, edits, role, text, truncated in group:
                    if edits is not None:
                        applied.edits(edits)
                    applied.row(role, text, truncated)
                applied.finish()
                yield {"conv": conv, "cost": applied.cost, "audit": "".join(applied.audit), "repaired_sha256": applied.digest.hexdigest()}

        return sent(results(), DIGEST, 1)

    narrow = flagged.select(
        "conv", "stretch", F.left("role", F.lit(1)).alias("initial"), (F.col("blank") | F.col("again")).alias("lost"), "truncated", "place")
    ways = narrow.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "place").drop("place").mapInArrow(stretches, WAYS)
    chosen = stored(ways.repartition("conv").sortWithinPartitions("conv", "stretch").mapInArrow(path, CHOSEN), "chosen")
    edited = flagged.join(chosen.drop("illegal"), ["conv", "stretch"]).select(
        "conv", F.when(F.col("place") % STRETCH == 0, F.col("edits")).alias("edits"), "role", "text", "truncated", "place")
    digested = edited.repartition("conv").sortWithinPartitions("conv", "place").drop("place").mapInArrow(digests, DIGEST)

    def tally(condition: Column) -> Column:
        return F.count_if(condition)

    counts = flagged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        tally(F.col("blank")).alias("blank"), tally(~F.col("blank") & F.col("again")).alias("duplicate"),
        tally(~F.col("again") & F.col("truncated")).alias("truncated"),
    )
    unlawful = chosen.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    return counts.join(unlawful, "conv").join(digested, "conv").select(*RESULT.names)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation."""
    spark = conversations.sparkSession
    ship(spark)
    ids = conversations.groupBy(group_of(F.col("conv_id")).alias("conv")).agg(F.first("conv_id").alias("conv_id"))
    rows = marked(damaged(conversations))
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    long = stored(sizes.where((F.col("n") > STRETCH) | (F.col("bytes") > STRETCH_BYTES)).select("conv"), "long")
    if long.isEmpty():
        results = repaired_whole(rows)
    else:
        results = repaired_whole(rows.join(long, "conv", "left_anti")).unionByName(
            repaired_in_stretches(rows.join(long, "conv", "left_semi")))
    joined = ids.join(results, "conv", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return joined.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
