"""Repaired conversations against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from orderloom.llm import conversation_repair as cr

INK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {
        conv: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for conv, own in out.items()
    }


def fault(row: tuple, earlier: list[tuple]) -> str | None:
    ink = INK.findall(row[2])
    if not ink:
        return "blank"
    if any(row[1:] == other[1:] for other in earlier):
        return "duplicate"
    return None if ink[-1] in ".!?" else "truncated"


def cheapest(marked: list[tuple]) -> tuple[int, str, tuple]:
    """Cost, letters and lines by trying every edit, state by state; costs beyond the best are left out."""
    step = {"": "u", "s": "u", "a": "u", "u": "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(front: dict) -> dict:
        for _ in range(3):
            for state, (cost, done, lines) in list(front.items()):
                to = step[state]
                more = (cost + 3, done + "I", (*lines, f"{names[to]}:"))
                front[to] = min(front.get(to, more), more)
        return front

    front = inserted({"": (0, "", ())})
    for _, role, text, problem in marked:
        after: dict = {}

        def offer(state, value, after=after):
            after[state] = min(after.get(state, value), value)

        for state, (cost, done, lines) in front.items():
            offer(state, (cost + 4, done + "D", lines))
            if problem in ("blank", "duplicate"):
                continue
            more = 3 * (problem == "truncated")
            to = step[state]
            offer(to, (cost + 3 + more, done + "R", (*lines, f"{names[to]}:{text}")))
            if role[:1] == to or (role[:1] == "s" and state == ""):
                offer(role[:1], (cost + more, done + "K", (*lines, f"{role}:{text}")))
        front = inserted(after)
    return min(front[state] for state in ("", "a") if state in front)


def brute(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, own in damage(rows).items():
        marked = [(*row, fault(row, own[:k])) for k, row in enumerate(own)]
        turns = {turn for turn, *_ in own if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        counts = [sum(row[3] == name for row in marked) for name in cr.FAULTS]
        cost, audit, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return sorted(out, key=str)


def conversation(dice: random.Random, conv, n: int) -> list[tuple]:
    roles = ("user", "assistant", "user", "assistant", "system", "tool", None, "")
    texts = ("Yes.", "No!", "Why?", "so", " ", "", None, "a b", "Well. ", "t.\n", "ok. ")
    rows, turn = [], dice.randint(-3, 3)
    for _ in range(n):
        text = dice.choice(texts) if dice.random() < 0.5 else f"text {dice.random()}."
        rows.append((conv, None if dice.random() < 0.05 else turn, dice.choice(roles), text))
        turn += dice.choice((0, 1, 1, 1, 2, 5))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(spark, rows: list[tuple], more: int = 4) -> list[tuple]:
    table = spark.createDataFrame(rows, SCHEMA).repartition(more)
    return sorted((tuple(r) for r in cr.digest(cr.edits(cr.damaged(table))).collect()), key=str)


def test_random_conversations(spark):
    dice = random.Random(3)
    rows = [row for conv in range(300) for row in conversation(dice, conv, dice.randint(1, 12))]
    rows += conversation(dice, None, 9)
    assert repaired(spark, rows) == brute(rows)


def test_conversations_of_many_pieces(spark):
    dice = random.Random(4)
    rows = [row for conv, n in enumerate((63, 64, 65, 128, 129, 700)) for row in conversation(dice, conv, n)]
    rows += [(50, k, ("user", "assistant")[k % 2], f"{k}.") for k in range(500)]
    assert repaired(spark, rows) == brute(rows)


def test_prices_may_arrive_before_the_turns(spark, monkeypatch):
    # Executors fetch shuffled rows in any order; here those of the first job come before all turns.
    frame = type(spark.range(0))
    union = frame.unionByName
    monkeypatch.setattr(
        frame, "unionByName", lambda turns, handed, **more: union(handed, turns, **more).select(*turns.columns)
    )
    dice = random.Random(6)
    rows = [row for conv in range(20) for row in conversation(dice, conv, dice.randint(60, 300))]
    assert repaired(spark, rows) == brute(rows)


def test_half_of_all_rows_are_one_turn(spark):
    rows = [(1, 5, "user", "Same.")] * 300 + [(k, k % 4, "user", f"{k}.") for k in range(2, 300)]
    assert repaired(spark, rows) == brute(rows)


def test_no_turn_is_left(spark):
    conv = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(conv, 0, "user", "Hi.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", empty)]
    none = spark.createDataFrame([], SCHEMA + ", edit string, place int")
    assert cr.digest(cr.edits(cr.damaged(none))).collect() == []


def test_edits_name_every_turn(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "again."), (1, 2, "tool", "x"), (1, 3, "assistant", "")]
    turns = spark.createDataFrame([(*row, True, "x") for row in rows], SCHEMA + ", present boolean, step string")
    got = [(r["edit"], r["role"], r["text"], r["was_role"]) for r in cr.edits(turns).collect()]
    assert got == [
        ("D", None, None, "user"), ("K", "user", "again.", "user"), ("R", "assistant", "x", "tool"), ("D", None, None, "assistant"),
    ] or got == [
        ("K", "user", "Hi.", "user"), ("R", "assistant", "again.", "user"), ("D", None, None, "tool"), ("D", None, None, "assistant"),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_settled_prices_are_distances(seed):
    dice = random.Random(seed)
    for _ in range(200):
        symbols = "".join(dice.choice("xsuaoSUAO") for _ in range(dice.randint(0, 12)))
        marked = [
            (0, {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"), "t",
             "blank" if c == "x" else "truncated" if c.isupper() else None)
            for c in symbols
        ]
        cost, audit, _ = cheapest(marked)
        lattice = cr.Lattice(symbols, cr.END)
        assert lattice.settle(cr.EMPTY) == cost
        assert lattice.trace(cr.EMPTY)[0] == audit
        cut = len(symbols) // 2
        leave = cr.prices(symbols[cut:], cr.END)
        head, state = cr.letters(symbols[:cut], leave, cr.EMPTY)
        assert head + cr.letters(symbols[cut:], cr.END, state)[0] == audit
