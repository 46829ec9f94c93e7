"""Repairs against all possible edits, and whole tables against a plain version of the rules."""

import hashlib
import random
import re
from zlib import crc32

import pytest

import stockloom.llm.repair as repair_module
from stockloom.llm.repair import Deduction, Path, Row, best_repair, crossings, lightest, repair

LAWFUL = re.compile(r"(s?(ua)+)?\Z")


def every_repair(rows, extra):
    """All (cost, audit) of edits with at most `extra` insertions whose result is lawful, found without any states."""
    def go(i, roles, cost, audit, left):
        if i == len(rows) and LAWFUL.match(roles):
            yield cost, audit
        if left:
            for role in "ua":
                yield from go(i, roles + role, cost + 2, audit + "I", left - 1)
        if i < len(rows):
            row = rows[i]
            late = row.truncated
            yield from go(i + 1, roles, cost + 3, audit + "D", left)
            if not row.lost:
                yield from go(i + 1, roles + row.initial, cost + late, audit + "K", left)
                for role in "ua":
                    yield from go(i + 1, roles + role, cost + 2 + late, audit + "R", left)

    return go(0, "", 0, "", extra)


def some_rows(pick, n, letters="suax"):
    return [Row(pick.choice(letters), pick.random() < 0.2, pick.random() < 0.2) for _ in range(n)]


def test_lightest_against_all_edits():
    pick = random.Random(5)
    for _ in range(120):
        rows = some_rows(pick, pick.randint(0, 4))
        assert best_repair(rows) == min(every_repair(rows, 3)), rows


def test_agenda_on_a_hypergraph_with_wider_edges():
    """A head with two premises takes the lightest of both, and a goal ends the search."""
    edges = [
        Deduction("a", (), lambda: (1, 0, "x")), Deduction("a", (), lambda: (0, 0, "y")), Deduction("b", (), lambda: (2, 0, "z")),
        Deduction("c", ("a", "b"), lambda a, b: (a[0] + b[0], 0, a[2] + b[2])), Deduction("c", (), lambda: (9, 0, "")),
        Deduction("d", ("c", "c"), lambda c, e: (c[0] + e[0] + 1, 0, c[2] + e[2])),
    ]
    assert lightest(edges, "d") == {"a": (0, 0, "y"), "b": (2, 0, "z"), "c": (2, 0, "yz"), "d": (5, 0, "yzyz")}


def test_stretches_give_the_same_audit():
    pick = random.Random(6)
    for _ in range(150):
        rows = some_rows(pick, pick.randint(1, 40)) if pick.random() < 0.5 else [
            Row("ua"[i % 2], pick.random() < 0.2, pick.random() < 0.2) for i in range(pick.randint(1, 40))]
        size, path, parts = pick.randint(1, 6), Path(), []
        for start in range(0, len(rows), size):
            parts += path.add(start, crossings(rows[start : start + size]))
        parts += path.end()
        assert [label for label, _ in parts] == list(range(0, len(rows), size))
        assert "".join(a for _, a in parts) == best_repair(rows)[1]


def plain(table):
    """The results by the rules, one conversation after another; edits by dynamic programming from the end."""
    groups, out = {}, {}
    for place, (conv, turn, role, text) in enumerate(table):
        groups.setdefault(conv, [])
        name = " " if conv is None else conv
        fate = crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        groups[conv] += [(turn is not None, turn or 0, place, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for conv, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        seen, faults = set(), []
        for *_, role, text in rows:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[3][:1] for r in rows]
        after = {"": "su", "s": "u", "u": "a", "a": "u"}
        best = {(len(rows), q): (0, "", ()) for q in ("", "a")}
        for i in range(len(rows), -1, -1):
            for _ in range(5):
                for q in after:
                    ways = [best[i, q]] if (i, q) in best else []

                    def way(cost, edit, key, line):
                        if key in best:
                            c, a, lines = best[key]
                            ways.append((c + cost, edit + a, (line, *lines) if line is not None else lines))

                    given = "assistant" if q == "u" else "user"
                    way(2, "I", (i, given[0]), given + ":")
                    if i < len(rows):
                        late = faults[i] == "t"
                        way(3, "D", (i + 1, q), None)
                        if faults[i] not in ("b", "d"):
                            way(2 + late, "R", (i + 1, given[0]), given + ":" + rows[i][4])
                            if initials[i] and initials[i] in after[q]:
                                way(late, "K", (i + 1, initials[i]), rows[i][3] + ":" + rows[i][4])
                    if ways:
                        best[i, q] = min(ways)
        turns = [r[1] for r in rows if r[0]]
        cost, audit, lines = best[0, ""]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def some_table():
    pick = random.Random(11)
    texts = ["Well. Yes!", "no end", "", " \t\n", "twice.", "twice.", None, "what?  ", "é.", "a\nb."]
    table = []
    for conv in [*range(40), None]:
        role = "system" if pick.random() < 0.3 else "user"
        for turn in range(pick.randint(1, 12)):
            kept = turn if pick.random() < 0.95 else None if pick.random() < 0.5 else max(turn - 1, 0)
            text = pick.choice(texts) if pick.random() < 0.4 else f"line {conv} {turn}."
            table.append((conv, kept, pick.choice([role, role, None, "tool", ""]) if pick.random() < 0.2 else role, text))
            role = "assistant" if role == "user" else "user"
    table += [(77, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "long text. " * 2000) for t in range(60)]
    return table


@pytest.mark.parametrize("stretch", [1000, 4])
def test_tables(spark, monkeypatch, stretch):
    """Whole conversations and stretches give what the rules say; 4 rows make most conversations long ones."""
    monkeypatch.setattr(repair_module, "STRETCH", stretch)
    table = some_table()
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").coalesce(1)
    clashing = df.selectExpr("*", "1 AS cost", "'x' AS `conv`", "'y' AS audit")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair(clashing).collect()}
    assert got == plain(table)


def test_much_text_is_cut_too(spark, monkeypatch):
    monkeypatch.setattr(repair_module, "STRETCH_BYTES", 100)
    table = some_table()[:80]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").coalesce(1)
    assert {r["conv_id"]: tuple(r)[1:] for r in repair(df).collect()} == plain(table)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert repair(df.limit(0)).count() == 0
    gone = next(t for t in range(1000) if crc32(f"9:{t}".encode()) % 20 == 0)
    row = repair(spark.createDataFrame([(9, gone, "user", "Hi.")], df.schema)).collect()
    assert [tuple(r) for r in row] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
