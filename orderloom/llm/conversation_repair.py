"""Repair of the structure of conversations by an auction algorithm for shortest paths.

A conversation is its turns in order (nulls first; equal turns by role, then text). A turn's first fault
counts: blank (no character but space and the control characters 9 to 13), duplicate (its role and text came
earlier), truncated (the last such character is not one of ``.!?``). The cheapest edits are sought that
make the initials of the roles match ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 3, Delete 4 (the only
choice for blank and duplicate turns), Insert of an empty user or assistant turn anywhere 3, and a truncated turn
that stays 3 more. Of equally cheap edits the one whose letters (K, R, D, I) sort first counts.

The lattice has a node for every number of turns read and every state (nothing yet, after s, u or a); its arcs are
the edits. ``Lattice.settle`` is the auction: a path grows from its origin over the arc that is cheapest by cost
plus the price of the node it leads to; if that is dearer than the price of the path's last node, that price
is raised to it and the path shrinks by that node. When the path reaches the end, the origin's price is its distance.
Prices never overstate a distance, so arcs whose cost equals the difference of two settled prices, the tight ones, are
those of cheapest paths; ``Lattice.trace`` follows the first letter among them.

Conversations of any length are solved in pieces of ``PIECE`` turns. A first job goes backwards over one symbol
a turn and hands the prices at the beginning of a piece to the piece before it; a second one goes forwards over
the texts, with the prices at the end of each piece and the state at its beginning. Both hold one piece at a
time; rows of a conversation pass through one task in sorted order, because their hash does.

Defined results: null roles and texts are one space; a null id names a conversation of its own; null turns come first and leave no
gap; a role of which the first character is not s, u or a cannot be kept; rows that repeat are duplicates; very long
texts are handed on as they are; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import prepare
from orderloom.session import scratch_path

PIECE = 64
# States of a path: nothing kept yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
COST = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
# The price of leaving the last piece in each state; None: not allowed.
END = (0, None, None, 0)
FAULTS = ("blank", "duplicate", "truncated")
EDITS = (
    "conv_id bigint, step bigint, turn bigint, edit string, role string, text string, fault string, was_role string"
)


def _arcs(symbol: str) -> tuple:
    """For each state the arcs (letter, cost, turns read, next state) of a turn, by letter.

    A symbol is the initial of the role (o: any other), in upper case if the turn is truncated; x must go.
    """
    extra, kind = (TRUNCATED, symbol.lower()) if symbol.isupper() else (0, symbol)
    out = []
    for state in range(4):
        arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, NEXT[state])]
        kept = {"s": SYSTEM if state == EMPTY else None, "u": USER, "a": ASSISTANT}.get(kind)
        if kept is not None and (kept == SYSTEM or NEXT[state] == kept):
            arcs.append(("K", KEEP + extra, 1, kept))
        if kind != "x":
            arcs.append(("R", REROLE + extra, 1, NEXT[state]))
        out.append(tuple(arcs))
    return tuple(out)


ARCS = {symbol: _arcs(symbol) for symbol in "xsuaoSUAO"}


class Lattice:
    """One piece: its symbols, and the price of leaving it in each state. Turns may be inserted after the last piece only."""

    def __init__(self, symbols: str, leave: tuple):
        self.symbols, self.leave, self.last = symbols, leave, leave == END
        self.end = 4 * (len(symbols) + 1)
        self.price = [0] * (self.end + 1)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Letter, cost and end of every arc from a node; leaving the piece has no letter and comes first."""
        at, state = divmod(node, 4)
        if at < len(self.symbols):
            return [(letter, cost, 4 * (at + read) + then) for letter, cost, read, then in ARCS[self.symbols[at]][state]]
        out = [("", self.leave[state], self.end)] if self.leave[state] is not None else []
        return out + [("I", INSERT, 4 * at + NEXT[state])] if self.last else out

    def settle(self, origin: int) -> int:
        """Auction from one origin; afterwards its price is its distance to the end."""
        price, path = self.price, [origin]
        while path[-1] != self.end:
            best, ahead = min((cost + price[to], to) for _, cost, to in self.arcs(path[-1]))
            if price[path[-1]] < best:
                price[path[-1]] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(ahead)
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The letters of the first of the cheapest paths from a state, and the state it ends in."""
        node, letters = state, []
        self.settle(node)
        while True:
            for letter, cost, to in self.arcs(node):
                # A price that still rises shows that the arc is not tight.
                if self.price[node] == cost + self.price[to] and (to == self.end or self.price[node] == cost + self.settle(to)):
                    break
            if to == self.end:
                return "".join(letters), node % 4
            letters.append(letter)
            node = to


@lru_cache(4096)
def prices(symbols: str, leave: tuple) -> tuple:
    """The prices of all states at the beginning of a piece, less the smallest."""
    lattice = Lattice(symbols, leave)
    out = [lattice.settle(state) for state in range(4)]
    return tuple(price - min(out) for price in out)


@lru_cache(4096)
def letters(symbols: str, leave: tuple, state: int) -> tuple[str, int]:
    return Lattice(symbols, leave).trace(state)


def faults(turns: DataFrame) -> DataFrame:
    """The turns with ``fault`` (null: none), ``symbol`` and their ``place`` from 1 in their conversation.

    ``turns`` has conv_id, turn, role, text and present; a row that is not present only names its conversation.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        "present",
    )
    turn = F.col("turn").asc_nulls_first()
    equal = Window.partitionBy("conv_id", "present", "role", "text").orderBy(turn)
    whole = Window.partitionBy("conv_id").orderBy(F.col("present").desc(), turn, "role", "text", "again")
    ink = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(ink == "", "blank").when(F.col("again") > 1, "duplicate").when(~ink.isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault").isNotNull(), F.upper(kind)).otherwise(kind)
    return (
        rows.repartition("conv_id")
        .withColumn("again", F.row_number().over(equal).cast("bigint"))
        .withColumn("place", F.row_number().over(whole).cast("bigint"))
        .withColumn("fault", fault)
        .withColumn("symbol", symbol)
        .select("conv_id", "place", "turn", "role", "text", "present", "fault", "symbol")
    )


def _pieces(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Neighbouring rows (conversation, place, ...) of one piece."""
    held: list[tuple] = []
    for row in rows:
        if held and (row[0] != held[0][0] or (row[1] - 1) // PIECE != (held[0][1] - 1) // PIECE):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: str, most: int = 1024, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length and text."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    names, types = zip(*((name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))), strict=True)
    held, total = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, types, strict=True)], names)

    for row in rows:
        held.append(row)
        total += sum(len(value) for value in row if isinstance(value, str))
        if len(held) >= most or total >= size:
            yield batch()
            held, total = [], 0
    yield batch()


_HANDED = "conv_id bigint, place bigint, leave array<bigint>"


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prices at the end of every piece but the last of a conversation; rows come last place first."""

    def handed() -> Iterator[tuple]:
        conversation, leave = object(), END
        for piece in _pieces(_rows(batches)):
            if piece[0][0] != conversation:
                conversation, leave = piece[0][0], END
            elif leave != END:
                yield conversation, (piece[0][1] - 1) // PIECE * PIECE, list(leave)
            leave = prices("".join(row[2] for row in reversed(piece)), leave)

    return _batches(handed(), _HANDED)


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of every conversation. Handed prices come as a row in front of their piece."""

    def edits() -> Iterator[tuple]:
        conversation, state, step, leave = object(), EMPTY, 0, END
        for piece in _split(_rows(batches)):
            conv = piece[0][0]
            if conv != conversation:
                conversation, state, step = conv, EMPTY, 0
            leave = tuple(piece[0][8]) if piece[0][8] is not None else END
            present = [row for row in piece if row[5]]
            own, left = letters("".join(row[7] for row in present), leave, state) if present else ("", state)
            turns = iter(present)
            for letter in own:
                step += 1
                if letter in "IR":
                    state = NEXT[state]
                if letter == "I":
                    yield conv, step, None, "I", NAMES[state], "", None, None
                    continue
                _, _, turn, role, text, _, fault, _, _ = next(turns)
                if letter == "K":
                    state = SYSTEM if role[:1] == "s" else NEXT[state]
                after = (NAMES[state], text) if letter == "R" else (role, text) if letter == "K" else (None, None)
                yield conv, step, turn, letter, *after, fault, role
            state = left
            if not present:  # the conversation itself is known
                yield conv, step, None, None, None, None, None, None

    return _batches(edits(), EDITS)


def _split(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Pieces, where prices (a row without a role) open the piece behind them and absent turns stand apart."""
    held: list[tuple] = []
    for row in rows:
        if held and (
            row[0] != held[0][0]
            or row[8] is not None
            or (held[0][8] is None and (row[1] - 1) // PIECE != (held[0][1] - 1) // PIECE)
            or (held[0][8] is not None and row[1] > held[0][1] + PIECE)
            or not row[5]
        ):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def edits(turns: DataFrame) -> DataFrame:
    """The edits of all conversations, in order: rows of ``EDITS``, those of a conversation next to each other.

    ``role`` and ``text`` are those after the edit (null if it deletes), ``fault`` and ``was_role`` those of the turn
    before it. A conversation without present turns has one row without an edit.
    """
    spark = prepare(turns.sparkSession)
    path = scratch_path(spark, "turns")
    faults(turns).write.parquet(path)
    rows = spark.read.parquet(path)
    symbols = rows.where("present").select("conv_id", "place", "symbol")
    handed = symbols.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").desc()).mapInArrow(_backwards, _HANDED)
    whole = rows.withColumn("leave", F.lit(None).cast("array<bigint>")).unionByName(handed, allowMissingColumns=True)
    # Prices have the place of the last turn before their piece and come behind it, in whatever order they arrive.
    ahead = F.col("leave").isNotNull()
    return whole.repartition("conv_id").sortWithinPartitions("conv_id", "place", ahead).mapInArrow(_forwards, EDITS)


_DIGEST = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of the edits, which come next to each other."""

    def sums() -> Iterator[tuple]:
        conversation, now = object(), None
        for conv, _, turn, edit, role, text, fault, was in _rows(batches):
            if conv != conversation:
                if now:
                    yield now.row(conversation)
                conversation, now = conv, _Sums()
            if edit:
                now.add(turn, edit, role, text, fault, was)
        if now:
            yield now.row(conversation)

    return _batches(sums(), _DIGEST)


class _Sums:
    """What is counted and hashed over the edits of one conversation."""

    def __init__(self):
        self.faults = dict.fromkeys(FAULTS, 0)
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0
        self.cost = self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None

    def add(self, turn, edit, role, text, fault, was) -> None:
        self.audit.append(edit)
        self.cost += COST[edit]
        if edit != "D":
            self.cost += TRUNCATED * (fault == "truncated")
            self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
            self.lines += 1
        if edit == "I":
            return
        if fault:
            self.faults[fault] += 1
        initial = was[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            self.distinct += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn

    def row(self, conversation) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (
            conversation, gaps, *(self.faults[name] for name in FAULTS), self.illegal, self.cost,
            "".join(self.audit), self.hash.hexdigest(),
        )


def digest(edited: DataFrame) -> DataFrame:
    """One row per conversation of ``edits``: faults, cost, letters and the hash of the repaired turns.

    Reads the edits in the order in which ``edits`` makes them, so nothing may stand between the two.
    """
    return edited.mapInArrow(_sums, _DIGEST)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in by ``crc32(conv_id:turn) % 20``, to be repaired.

    0 drops a turn, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user.
    """

    def part(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
