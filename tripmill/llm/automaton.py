"""One deterministic automaton for several byte patterns, as transition arrays.

Patterns are regular expressions over bytes: literals, ``\\xNN`` and escaped characters, classes,
groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``. They become one nondeterministic
automaton, that a deterministic one by subset construction over classes of bytes that no pattern
tells apart, and that the smallest one by refining a partition of its states.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import count

import numpy as np

ALL = (1 << 256) - 1
MOST_STATES = 1 << 15
# Bytes read ahead of a chunk to guess the state in which it begins; a wrong guess costs time only.
AHEAD = 64
# Not a power of two, so that the columns of the transposed bytes spread over the cache.
CHUNK = 1_001

Node = tuple


def _bytes(chars: str) -> int:
    return sum(1 << ord(c) for c in set(chars))


class _Parser:
    def __init__(self, pattern: str):
        self.tokens = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|\{\d+(?:,\d*)?\}|\[(?:\\x[0-9A-Fa-f]{2}|\\.|[^\]\\])+\]|[\x20-\x5A\x5C-\x7E]", pattern)
        if "".join(self.tokens) != pattern:
            raise ValueError(f"not a pattern of bytes: {pattern!r}")
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def either(self) -> Node:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return ("either", *parts)

    def sequence(self) -> Node:
        parts = []
        while self.peek() not in ("", "|", ")"):
            node, mark = self.single(), self.peek()
            if mark in ("?", "*", "+") or len(mark) > 2 and mark[0] == "{":
                node = ("repeat", node, *self.times(self.take()))
            parts.append(node)
        return ("sequence", *parts)

    @staticmethod
    def times(mark: str) -> tuple[int, int | None]:
        if mark[0] != "{":
            return (1 if mark == "+" else 0), (1 if mark == "?" else None)
        least, comma, most = mark[1:-1].partition(",")
        return int(least), int(most) if most else None if comma else int(least)

    def single(self) -> Node:
        token = self.take()
        if token == "(":
            node = self.either()
            if self.peek() != ")":
                raise ValueError("a group is not closed")
            self.take()
            return node
        if token == ".":
            return ("set", ALL & ~(1 << 10))
        return ("set", self.members(token[1:-1]) if token[0] == "[" else 1 << self.code(token))

    @staticmethod
    def code(token: str) -> int:
        return int(token[2:], 16) if token[:2] == "\\x" else ord(token[-1])

    def members(self, inside: str) -> int:
        negated = inside.startswith("^")
        codes = [(self.code(t), t) for t in re.findall(r"\\x..|\\.|.", inside[negated:])]
        found, k = 0, 0
        while k < len(codes):
            low = high = codes[k][0]
            if k + 2 < len(codes) and codes[k + 1][1] == "-":
                high, k = codes[k + 2][0], k + 2
            found |= sum(1 << c for c in range(low, high + 1))
            k += 1
        return ALL & ~found if negated else found


def parse(pattern: str) -> Node:
    parser = _Parser(pattern)
    node = parser.either()
    if parser.peek():
        raise ValueError(f"unbalanced: {pattern!r}")
    return node


def any_case(word: str) -> str:
    """A pattern for the word in either case of its ASCII letters."""
    return "".join(f"[{c.upper()}{c.lower()}]" if "a" <= c.lower() <= "z" else re.escape(c) for c in word)


def backwards(node: Node) -> Node:
    """The pattern of the reversed texts."""
    if node[0] == "set":
        return node
    if node[0] == "repeat":
        return ("repeat", backwards(node[1]), *node[2:])
    parts = [backwards(part) for part in node[1:]]
    return (node[0], *(reversed(parts) if node[0] == "sequence" else parts))


class _Nondeterministic:
    """States joined by empty moves and by moves over sets of bytes."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node: Node, start: int) -> int:
        """Append a pattern after ``start``; its last state."""
        if node[0] == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
        elif node[0] == "sequence":
            end = start
            for part in node[1:]:
                end = self.add(part, end)
        elif node[0] == "either":
            end = self.state()
            for part in node[1:]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first)].append(end)
        else:
            _, part, least, most = node
            end = start
            for _ in range(least):
                end = self.add(part, end)
            if most is None:
                again = self.state()
                self.free[end].append(again)
                self.free[self.add(part, again)].append(again)
                end = again
            else:
                last = self.state()
                for _ in range(most - least):
                    self.free[end].append(last)
                    end = self.add(part, end)
                self.free[end].append(last)
                end = last
        return end

    def closure(self, states) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for after in self.free[open_.pop()]:
                if after not in found:
                    found.add(after)
                    open_.append(after)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``table[state, kind of byte]`` is the next state; state 0 is the first. ``accepts[state]`` has
    the bit of every pattern that ends there; a state from which nothing can be reached is ``dead``."""

    kinds: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    dead: int

    @cached_property
    def rows(self) -> list[list[int]]:
        return self.table.tolist()

    def walk(self, data: bytes | np.ndarray, state: int = 0) -> list[int]:
        """The states after every byte, one after the other; ends at the dead state."""
        rows, kinds, states = self.rows, self.kinds, []
        for byte in data:
            state = rows[state][kinds[byte]]
            if state == self.dead:
                break
            states.append(state)
        return states

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state after every byte of ``data``, in one pass.

        The bytes are read in chunks side by side. Where a chunk begins in another state than
        guessed, it is read anew from its beginning until both readings agree, chunk after chunk,
        so the result is that of reading byte by byte.
        """
        if not len(data):
            return np.empty(0, dtype=np.uint16)
        width = self.table.shape[1]
        flat = self.table.astype(np.int32).ravel()
        chunks = -(-len(data) // CHUNK)
        padded = np.full(AHEAD + chunks * CHUNK, 0xFF, dtype=np.uint8)
        padded[AHEAD : AHEAD + len(data)] = data
        kinds = self.kinds[padded]
        # The bytes ahead of the first chunk are no part of the data: all read as the first state.
        state = np.zeros(chunks, dtype=np.int32)
        for k in range(AHEAD):
            state = flat[state * width + kinds[k : k + chunks * CHUNK : CHUNK]]
        state[0] = 0
        begun = state.copy()
        columns = np.ascontiguousarray(kinds[AHEAD:].reshape(chunks, CHUNK).T)
        out = np.empty((CHUNK, chunks), dtype=np.uint16)  # MOST_STATES fit
        for k in range(CHUNK):
            state = flat[state * width + columns[k]]
            out[k] = state
        found = np.ascontiguousarray(out.T).ravel()
        self._mend(found, begun, kinds[AHEAD:])
        return found[: len(data)]

    def _mend(self, found: np.ndarray, begun: np.ndarray, kinds: np.ndarray) -> None:
        done = 0
        for chunk in np.flatnonzero(found[CHUNK - 1 :: CHUNK][:-1] != begun[1:]) + 1:
            at = int(chunk) * CHUNK
            if at < done:
                continue
            state = int(found[at - 1])
            while at < len(found):
                state = self.rows[state][kinds[at]]
                # Past a border both readings must agree in a chunk whose beginning was right.
                if found[at] == state and (at % CHUNK != CHUNK - 1 or at + 1 >= len(found) or begun[(at + 1) // CHUNK] == state):
                    break
                found[at] = state
                at += 1
            done = at


def compile_patterns(patterns: Sequence[str | Node], anywhere: bool = True) -> Automaton:
    """The least automaton of all patterns. With ``anywhere`` a match may begin at any byte, without
    it only at the first."""
    machine = _Nondeterministic()
    first, ends = machine.state(), {}
    for number, pattern in enumerate(patterns):
        start = machine.state()
        machine.free[first].append(start)
        ends[machine.add(parse(pattern) if isinstance(pattern, str) else pattern, start)] = number

    sets = sorted({mask for moves in machine.moves for mask, _ in moves})
    signs = [tuple(mask >> byte & 1 for mask in sets) for byte in range(256)]
    names = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
    kinds = np.array([names[sign] for sign in signs], dtype=np.uint8)
    example = [signs.index(sign) for sign in names]

    begin = machine.closure([first])
    reach: list[list[frozenset[int]]] = [
        [machine.closure([to for mask, to in moves if mask >> byte & 1]) for byte in example] for moves in machine.moves
    ]
    always = begin if anywhere else frozenset()
    numbers, rows, number = {begin: 0}, [], count(1)
    order = [begin]
    for states in order:
        row = []
        for k in range(len(example)):
            after = always.union(*(reach[s][k] for s in states if machine.moves[s]))
            if after not in numbers:
                numbers[after] = next(number)
                order.append(after)
                if len(order) > MOST_STATES:
                    raise ValueError("the patterns need too many states")
            row.append(numbers[after])
        rows.append(row)
    accepts = [sum({1 << ends[s] for s in states if s in ends}) for states in order]
    return _least(kinds, np.array(rows, dtype=np.int64), np.array(accepts, dtype=np.int64))


def _least(kinds: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that no bytes tell apart: blocks of equal acceptance, split until none splits."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        signs = np.column_stack([block, block[table]])
        _, first, finer = np.unique(signs, axis=0, return_index=True, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    rename = np.argsort(np.argsort(first))  # blocks in order of their first state, so 0 stays 0
    kept, block = np.sort(first), rename[finer]
    small, ends = block[table[kept]], accepts[kept]
    dead = np.flatnonzero((small == np.arange(len(small))[:, None]).all(axis=1) & (ends == 0))
    return Automaton(kinds, small.astype(np.int32), ends, int(dead[0]) if len(dead) else -1)
