"""Chat formatting with minimum-cost role repair.

A conversation is legal when its turns follow an automaton: an optional system turn, then user and
assistant in alternation. Dynamic programming over the automaton repairs any other sequence at least
cost, by relabelling a turn, merging it into the one before, or inserting an empty turn, and renders
the result. Turns are never dropped.

A turn is a min-plus matrix over the four states, and matrices of adjacent turns multiply, so a
conversation of any length is handled in pieces: turns are range partitioned by their order; each
partition sends the matrix of its first and last conversation; the states at partition borders
follow from those; then every partition repairs its own turns. No task needs a whole conversation.

Defined results: turns are ordered by turn number, null first, then role and text, so ties and
repeated rows have an order and all stay; a null or unknown role can only be relabelled; a null or
empty text is an empty turn; rows with a null conversation id form one conversation; an empty table
gives no rows. Only the columns named in the result are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import cut, map_arrow, on_workers

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ["", "system", "user", "assistant"]
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
RELABEL, MERGE, INSERT = 2.0, 1.0, 1.5
# A prompt may still wait for its answer.
FINAL = (SYSTEM, USER, ASSISTANT)
NEVER = float("inf")
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"

# (cost, to, inserted role or 0, merged) for every role and state; ties go to the first listed.
Move = tuple[float, int, int, bool]


def moves(role: int | None) -> list[list[Move]]:
    """Per state, the ways to place one turn of a role, cheapest first for each new state."""
    table = []
    for state in range(4):
        best: dict[int, Move] = {}
        options = [(0.0, to, 0, False) for to in LEGAL[state]]
        options += [(INSERT, to, empty, False) for empty in LEGAL[state] for to in LEGAL[empty]]
        if state != START:
            options.append((MERGE, state, 0, True))
        for cost, to, empty, merged in options:
            cost += 0.0 if to == role else RELABEL
            if to not in best or cost < best[to][0]:
                best[to] = (cost, to, empty, merged)
        table.append(sorted(best.values()))
    return table


MOVES = {role: moves(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def role_of(name: str | None) -> int | None:
    return ROLES.get((name or "").strip().lower())


def forward(costs: list[float], roles: list[int | None]) -> tuple[list[float], list[list[tuple[int, Move] | None]]]:
    """Least cost of each state after the turns, and how each state was reached at every turn."""
    steps = []
    for role in roles:
        new, how = [NEVER] * 4, [None] * 4
        table = MOVES[role]
        for state in range(4):
            if costs[state] == NEVER:
                continue
            for move in table[state]:
                total = costs[state] + move[0]
                if total < new[move[1]]:
                    new[move[1]], how[move[1]] = total, (state, move)
        costs = new
        steps.append(how)
    return costs, steps


def matrix(roles: list[int | None]) -> list[float]:
    """Least costs from every state to every state over the turns, as 16 numbers."""
    return [cost for state in range(4) for cost in forward([0.0 if s == state else NEVER for s in range(4)], roles)[0]]


def path(roles: list[int | None], enter: int = START, leave: int | None = None) -> tuple[list[Move], float]:
    """The cheapest moves from one state to another, or to any final one."""
    costs, steps = forward([0.0 if s == enter else NEVER for s in range(4)], roles)
    state = min(FINAL, key=lambda s: costs[s]) if leave is None else leave
    total, found = costs[state], []
    for how in reversed(steps):
        state, move = how[state]
        found.append(move)
    return found[::-1], total


def borders(matrices: list[list[float]]) -> list[tuple[int, int]]:
    """States in which the cheapest way enters and leaves each of the consecutive pieces."""
    costs, back = [0.0, NEVER, NEVER, NEVER], []
    for m in matrices:
        ways = [[costs[a] + m[4 * a + b] for a in range(4)] for b in range(4)]
        back.append([min(range(4), key=lambda a, w=w: w[a]) for w in ways])
        costs = [min(w) for w in ways]
    state, found = min(FINAL, key=lambda s: costs[s]), []
    for step in reversed(back):
        found.append((step[state], state))
        state = step[state]
    return found[::-1]


def rendered(found: list[Move], texts: list[str], first: bool, last: bool) -> list[str]:
    """One piece a turn; the pieces of a conversation, joined, are its rendering.

    A turn is closed by the piece after it, which knows whether it merges.
    """
    pieces = []
    for i, ((_, to, empty, merged), text) in enumerate(zip(found, texts)):
        if merged:
            piece = "\n" + text
        else:
            piece = "" if first and i == 0 else CLOSE
            piece += OPEN.format(NAMES[empty]) + CLOSE if empty else ""
            piece += OPEN.format(NAMES[to]) + text
        pieces.append(piece + (CLOSE if last and i == len(found) - 1 else ""))
    return pieces


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Consecutive rows of one conversation, across batches."""
    group, rows = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if rows and row[0] != group:
                yield group, rows
                rows = []
            group = row[0]
            rows.append(row)
    if rows:
        yield group, rows


def ordered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text) in order within and across partitions, written down as such."""
    rows = turns.select(*(F.col(f"`{c}`").alias(n) for c, n in ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))))
    order = ["conv", "turn", "role", F.xxhash64("text"), "text"]
    # The row number only helps to split equal rows over partitions.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return cut(rows.repartitionByRange(*order[:4], "row").sortWithinPartitions(*order, "row").drop("row"))


def piece_matrices(rows: DataFrame) -> DataFrame:
    """The first and the last conversation of every partition as matrices."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, kind = [], None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                yield batch.select([0, 2])

        for group, found in runs(typed()):
            ends = [*ends[:1], (group, [role_of(r[1]) for r in found])]
        if ends:
            part = pa.array([TaskContext.get().partitionId()] * len(ends), pa.int64())
            ms = pa.array([matrix(roles) for _, roles in ends], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in ends], kind), part, ms], names=["conv", "part", "m"])

    return map_arrow(rows, run, f"conv {kind}, part long, m array<double>")


def border_states(pieces: DataFrame) -> dict[tuple[int, object], tuple[int, int, bool, bool]]:
    """(partition, conversation) -> states, and whether it begins and ends there.

    Only conversations in several partitions have an entry, so there are at most two a partition.
    """
    on_workers(pieces.sparkSession)
    kind = pieces.schema["conv"].dataType.simpleString()

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        found = borders([list(m) for m in group["m"]]) if len(group) > 1 else []
        return pd.DataFrame(
            {
                "conv": group["conv"].iloc[: len(found)],
                "part": group["part"].iloc[: len(found)],
                "enter": [a for a, _ in found],
                "leave": [b for _, b in found],
                "at": range(len(found)),
                "n": len(found),
            }
        )

    solved = pieces.groupBy("conv").applyInPandas(solve, f"conv {kind}, part long, enter int, leave int, at int, n int")
    return {(r["part"], r["conv"]): (r["enter"], r["leave"], r["at"] == 0, r["at"] == r["n"] - 1) for r in solved.collect()}


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per turn, in the order of ``seq``: what became of it, and its piece of the rendering."""
    rows = ordered_turns(turns, conv, turn, role, text)
    shared = turns.sparkSession.sparkContext.broadcast(border_states(piece_matrices(rows)))
    names = [conv, turn, "seq", "old_role", "new_role", "action", "inserted", "cost", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, kinds, seq = TaskContext.get().partitionId(), shared.value, [], 0

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.column(0).type, batch.column(1).type]
                yield batch

        for group, found in runs(typed()):
            roles = [role_of(r[2]) for r in found]
            enter, leave, first, last = known.get((part, group), (START, None, True, True))
            best, _ = path(roles, enter, leave)
            pieces = rendered(best, [r[3] or "" for r in found], first, last)
            action = [("merge" if m[3] else "keep") + ("" if m[1] == r else "+relabel") for m, r in zip(best, roles)]
            columns = [
                pa.array([r[0] for r in found], kinds[0]),
                pa.array([r[1] for r in found], kinds[1]),
                pa.array(range((part << 40) + seq, (part << 40) + seq + len(found)), pa.int64()),
                pa.array([r[2] for r in found], pa.string()),
                pa.array([NAMES[m[1]] for m in best], pa.string()),
                pa.array(action, pa.string()),
                pa.array([NAMES[m[2]] or None for m in best], pa.string()),
                pa.array([m[0] for m in best], pa.float64()),
                pa.array(pieces, pa.string()),
            ]
            seq += len(found)
            yield pa.RecordBatch.from_arrays(columns, names=[f"k{i}" for i in range(len(columns))])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    types = [*kinds, "long", "string", "string", "string", "string", "double", "string"]
    return map_arrow(rows, run, ", ".join(f"k{i} {t}" for i, t in enumerate(types))).toDF(*names)
