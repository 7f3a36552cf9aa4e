"""Cheapest repair of a conversation's structure, streamed in turn order.

Rows are dealt by conversation, sorted by turn within their task, and read as a
stream.  A dynamic program over four states (nothing yet, after a system turn,
after a user turn, after an assistant turn) is carried from one Arrow batch to
the next; what it needs to know of the past is a number, so a row costs one
look-up.  One number a row leads back along the cheapest path; rows and numbers
of a giant conversation go to files of the task until its end is known.
"""
from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import shuffle_parts, staged

#: white space, the set of [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: the state that an inserted turn leads to, which a kept user or assistant turn leads to as well
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}


@dataclass(frozen=True)
class Costs:
    """Cost of an edit; ``cut_off`` is added for a truncated turn that stays.
    ``block``: rows of a conversation kept in memory, with up to ``chars``
    characters, before they go to a file."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    cut_off: int = 5
    block: int = 20_000
    chars: int = 8 << 20


#: (state before, inserted turns, edit): how a state is reached over one row
Move = tuple[int, int, str]


class Program:
    """The dynamic program, as a table that fills as it is used.

    A row's kind is (initial, must go, truncated).  A position holds the cost of
    each state above the cheapest one and the states' order by their edits so
    far; these are finitely many, so positions and steps are numbered.  Edits
    up to a row end with that row's edit, so none is the beginning of another
    and their order stays decided."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        first = ((0, None, None, None), (0, None, None, None))
        self.numbers = {first: 0}
        self.positions = [first]
        self.steps: dict[tuple[int, tuple[str, bool, bool]], int] = {}
        self.table: list[tuple[int, int, tuple[Move | None, ...]]] = []  # position after, cost, move to each state

    def edits(self, state: int, kind: tuple[str, bool, bool]) -> Iterator[tuple[str, int, int]]:
        """(edit, state after, cost) of a row in ``state``."""
        initial, must_go, cut = kind
        yield "D", state, self.costs.delete
        if must_go:
            return
        stays = self.costs.cut_off if cut else 0
        if initial == "s" and state == START:
            yield "K", SYSTEM, stays
        elif initial == "ua"[NEXT[state] == ASSISTANT]:
            yield "K", NEXT[state], stays
        yield "R", NEXT[state], self.costs.rerole + stays

    def step(self, position: int, kind: tuple[str, bool, bool]) -> int:
        known = self.steps.get((position, kind))
        if known is not None:
            return known
        cost, rank = self.positions[position]
        best: list[tuple | None] = [None] * STATES
        for q in range(STATES):
            if cost[q] is None:
                continue
            state = q
            for k in range(3):  # more than two insertions lead back to a state reached cheaper
                for edit, to, price in self.edits(state, kind):
                    option = (cost[q] + k * self.costs.insert + price, rank[q], "I" * k + edit, q, k)
                    if best[to] is None or option < best[to]:
                        best[to] = option
                state = NEXT[state]
        least = min(b[0] for b in best if b)
        order = {s: r for r, s in enumerate(sorted((s for s in range(STATES) if best[s]), key=lambda s: best[s][1:3]))}
        after = (tuple(b and b[0] - least for b in best), tuple(order.get(s) for s in range(STATES)))
        if after not in self.numbers:
            self.numbers[after] = len(self.positions)
            self.positions.append(after)
        self.table.append((self.numbers[after], least, tuple(b and (b[3], b[4], b[2][-1]) for b in best)))
        self.steps[position, kind] = len(self.table) - 1
        return len(self.table) - 1

    def end(self, position: int) -> tuple[int, int, int]:
        """(state, turns to insert, cost) of the cheapest whole repair."""
        cost, rank = self.positions[position]
        missing = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
        c, _, s = min((cost[s] + missing[s] * self.costs.insert, rank[s], s) for s in range(STATES) if cost[s] is not None)
        return s, missing[s], c


class Trail:
    """Rows of one conversation and the numbers of their steps, in memory up to
    ``block`` rows or ``chars`` characters, beyond that in two files of the task."""

    def __init__(self, block: int, chars: int):
        self.block, self.chars, self.rows, self.steps, self.size = block, chars, [], array("I"), 0
        self.files: tuple | None = None
        self.places: list[tuple[int, int]] = []  # (place in the file of rows, rows) of a block

    def add(self, row: tuple, step: int) -> None:
        self.rows.append(row)
        self.steps.append(step)
        self.size += len(row[2])
        if len(self.rows) >= self.block or self.size >= self.chars:
            self.spill()

    def spill(self) -> None:
        if self.files is None:
            self.files = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        rows, steps = self.files
        self.places.append((rows.tell(), len(self.rows)))
        pickle.dump(self.rows, rows, pickle.HIGHEST_PROTOCOL)
        self.steps.tofile(steps)
        self.rows, self.steps, self.size = [], array("I"), 0

    def moves_back(self, program: Program, steps: array, state: int) -> int:
        """Each step number gives way to its move on the path that ends in
        ``state``: edit, insertions and state before in one number."""
        for i in range(len(steps) - 1, -1, -1):
            before, k, edit = program.table[steps[i]][2][state]
            steps[i] = ord(edit) << 8 | k << 4 | before
            state = before
        return state

    def replay(self, program: Program, state: int) -> Iterator[tuple[tuple, int]]:
        """(row, move) in order, along the path that ends in ``state``."""
        if self.files is None:
            self.moves_back(program, self.steps, state)
            yield from zip(self.rows, self.steps)
            return
        if self.rows:
            self.spill()
        rows, numbers = self.files
        at = sum(n for _, n in self.places) * array("I").itemsize
        for _, n in reversed(self.places):
            at -= n * array("I").itemsize
            part = array("I")
            numbers.seek(at)
            part.fromfile(numbers, n)
            state = self.moves_back(program, part, state)
            numbers.seek(at)
            part.tofile(numbers)
        numbers.seek(0)
        for place, n in self.places:
            rows.seek(place)
            part = array("I")
            part.fromfile(numbers, n)
            yield from zip(pickle.load(rows), part)
        for f in self.files:
            f.close()


def repaired_rows(rows: Iterable[tuple], program: Program) -> Iterator[tuple]:
    """Sorted rows (conversation, turn, role, text, blank, truncated, seen) to
    (conversation, place, turn, role, role before, text, fault, edit)."""
    trail: Trail | None = None
    conv = position = place = prev = None

    def finish() -> Iterator[tuple]:
        state, missing, _ = program.end(position)
        place, at = 0, START

        def insert(times: int) -> Iterator[tuple]:
            nonlocal place, at
            for _ in range(times):
                at = NEXT[at]
                yield conv, place, None, ROLES[at], None, "", None, "I"
                place += 1

        for (turn, role, text, fault), move in trail.replay(program, state):
            edit = chr(move >> 8)
            yield from insert(move >> 4 & 15)
            new = None
            if edit != "D":
                at = SYSTEM if edit == "K" and at == START and role[:1] == "s" else NEXT[at]
                new = role if edit == "K" else ROLES[at]
            yield conv, place, turn, new, role, text, fault, edit
            place += 1
        yield from insert(missing)

    for c, turn, role, text, blank, cut, seen in rows:
        if trail is None or c != conv:
            if trail is not None:
                yield from finish()
            conv, position, trail, prev = c, 0, Trail(program.costs.block, program.costs.chars), None
        again = seen or prev == (turn, role, text)
        prev = (turn, role, text)
        fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        step = program.step(position, (initial, blank or again, fault == "truncated"))
        position = program.table[step][0]
        trail.add((turn, role, text, fault), step)
    if trail is not None:
        yield from finish()


EDITED = "_conv string, place long, turn long, role string, role_before string, text string, fault string, edit string"


def _tuples(frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
    for f in frames:
        columns = [f[c].astype(object).where(f[c].notna(), None).tolist() for c in f.columns]
        yield from zip(*columns)


def _frames(rows: Iterable[tuple], names: list[str], most: int = 2000) -> Iterator[pd.DataFrame]:
    part: list[tuple] = []
    size = 0
    for r in rows:
        part.append(r)
        size += len(r[5] or "") if len(r) > 5 and isinstance(r[5], str) else 0
        if len(part) >= most or size > 8 << 20:
            yield _frame(part, names)
            part, size = [], 0
    if part:
        yield _frame(part, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, zip(*rows))})


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Every row of ``rows`` (conv_id, turn, role, text) and every inserted turn
    with its edit, as ``conv_id, place, turn, role, role_before, text, fault,
    edit``; a task has whole conversations, each in order of ``place``.

    Order is by turn (null first), then role and text, so ties and repeated rows
    have one result.  Null roles and texts count as one space; a null conv_id is
    a conversation of its own; an empty table gives no rows; other columns are
    not read.  A repeat of a turn in the same turn comes right behind it; of
    repeats in other turns Spark counts the first turn beforehand, so no list of
    what was seen is held.  Memory does not grow with a conversation."""
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    has_turn = F.col("turn").isNotNull()
    d = rows.select(
        F.col("conv_id"), F.col("conv_id").cast("string").alias("_conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
    d = d.withColumns({
        "_key": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256),
        "_at": F.struct(has_turn.alias("known"), F.col("turn").alias("turn"))})
    first = (d.groupBy("_conv", "_key").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
             .where(F.col("_first") != F.col("_last")).select(F.col("_conv").alias("_c"), F.col("_key").alias("_k"), "_first"))
    first = staged(first)
    marked = (d.join(first, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_key") == F.col("_k")), "left")
              .select("_conv", "turn", "role", "text", (last == "").alias("_blank"),
                      (~last.isin(".", "!", "?")).alias("_cut"),
                      F.coalesce(F.col("_at") > F.col("_first"), F.lit(False)).alias("_seen")))
    ordered = (marked.repartition(shuffle_parts(rows.sparkSession), "_conv")
               .sortWithinPartitions("_conv", F.asc_nulls_first("turn"), "role", "text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in EDITED.split(", ")]
        yield from _frames(repaired_rows(_tuples(frames), Program(costs)), names)

    kind = rows.schema["conv_id"].dataType
    return ordered.mapInPandas(run, EDITED).select(F.col("_conv").cast(kind).alias("conv_id"), *EDITED_OUT)


EDITED_OUT = ["place", "turn", "role", "role_before", "text", "fault", "edit"]
PRICE = {"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}


def digest_rows(rows: Iterable[tuple], costs: Costs = Costs()) -> Iterator[tuple]:
    """Rows of :func:`repair` in their order to one digest a conversation, with
    counters, a hash in progress and the edits as state."""
    conv, state = None, None

    def done() -> tuple:
        turns = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
        return (conv, turns, *(state[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")),
                state["audit"].decode(), state["hash"].hexdigest())

    for c, _, turn, role, before, text, fault, edit in rows:
        if state is None or c != conv:
            if state is not None:
                yield done()
            conv, state = c, {"low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                              "cost": 0, "audit": bytearray(), "hash": hashlib.sha256(), "prev": None, "some": False}
        state["audit"] += edit.encode()
        state["cost"] += 0 if edit == "K" else getattr(costs, PRICE[edit])
        if edit != "I":
            if turn is not None and turn != state["high"]:  # in order, so a new turn is a higher one
                state["low"] = turn if state["low"] is None else state["low"]
                state["high"], state["turns"] = turn, state["turns"] + 1
            if fault:
                state[fault] += 1
            if state["prev"] is not None and state["prev"] + before[:1] not in ("su", "ua", "au"):
                state["illegal"] += 1
            state["prev"] = before[:1]
        if edit != "D":
            if fault == "truncated":
                state["cost"] += costs.cut_off
            state["hash"].update(("\n" * state["some"] + role + ":" + text).encode("utf-8", "surrogatepass"))
            state["some"] = True
    if state is not None:
        yield done()


DIGEST = ("_conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def digest(edited: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation of :func:`repair`'s rows, in the same tasks."""
    kind = edited.schema["conv_id"].dataType

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DIGEST.split(", ")]
        yield from _frames(digest_rows(_tuples(frames), costs), names)

    src = edited.select(F.col("conv_id").cast("string").alias("_conv"), *EDITED_OUT)
    names = [c.split()[0] for c in DIGEST.split(", ")][1:]
    return src.mapInPandas(run, DIGEST).select(F.col("_conv").cast(kind).alias("conv_id"), *names)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after the faults that the checksum of ``conv_id:turn`` deals out
    (nulls count as one space): 0 drops a row, 1 empties its text, 2 removes its
    full stops, 3 repeats it, 4 makes it the user's."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    d = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), code.alias("_code"))
    text = (F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    times = F.when(F.col("_code") == 0, 0).when(F.col("_code") == 3, 2).otherwise(1)
    return (d.select("conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
                     text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy"))


def conversation_repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One digest per conversation of ``rows``, repaired after damage; zeros
    and hashes of nothing where no row is left."""
    got = digest(repair(damaged(rows), costs), costs)
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    none = hashlib.sha256().hexdigest()
    out = every.join(got, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))

