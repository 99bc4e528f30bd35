"""Secrets in texts: all rules in one pass of one automaton.

The patterns of all rules are compiled into one deterministic automaton (see ``automaton``), which
reads the UTF-8 bytes of every whole text once and tells after each byte which rules may end there.
Ends are rare. From an end the reversed pattern of its rule is walked to the leftmost place at which
the match can begin, and from there the pattern itself to the first byte of its tail, whose length
the rule may ask for. Matches of a rule do not overlap, and a match whose tail is too short is
dropped but its bytes are spent, as a search with the pattern and a test of its length would do.

A rule's pattern ends in a repeated class of bytes (``[0-9]+``, ``[0-9]{20,}``), or in a text that
cannot end at two successive bytes. Then the last of successive ends is the end of the longest match.

Defined results: a null text is an empty one and holds nothing; a text of any length is read whole;
rows that repeat are read row by row; rules that match the same characters all report them, in the
order of the rules; an empty table gives no rows. Spans count code points and their end is
exclusive. Only the id and the results are returned, or, from ``redact``, all columns with the text
replaced; a null text stays null there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.automaton import Automaton, any_case, backwards, compile_patterns, parse
from tripmill.llm.shared import map_arrow, portions

# No byte of UTF-8 text; it ends every match.
BORDER = b"\xff"


@dataclass(frozen=True)
class Rule:
    """``least`` is the shortest tail: the bytes from the first at which the pattern is complete."""

    kind: str
    pattern: str
    least: int = 1


_NAME = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + any_case("api") + "_?" + any_case("key")

# The three base kinds, then published forms of tokens and keys.
BASE = (
    Rule("assign", f"({_NAME})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", "AKIA[A-Z0-9]+", 12),
    # 32 or more: eight in the pattern, which keeps the automaton small and ends rare, the rest as tail.
    Rule("hex", "[0-9a-f]{8,}", 25),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 36),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]+", 10),
    Rule("google", "AIza[A-Za-z0-9_-]+", 35),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]+", 16),
    Rule("jwt", "eyJ[A-Za-z0-9_.-]+", 40),
    Rule("key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:long,end:long>>"

Found = list[tuple[int, int, int]]  # (start, rule, end)


@dataclass(frozen=True)
class Scanner:
    """The compiled rules. Its arrays depend on the rules alone, so it goes to every task."""

    rules: tuple[Rule, ...]
    combined: Automaton
    forward: tuple[Automaton, ...]
    reversed: tuple[Automaton, ...]

    @cached_property
    def quiet(self) -> np.ndarray:
        return self.combined.accepts == 0

    def ends(self, data: np.ndarray) -> list[tuple[int, int]]:
        """(rule, place) of every byte at which a rule's longest matches end, by rule and place."""
        states = self.combined.states(data)
        hits = np.flatnonzero(~self.quiet[states])
        bits = self.combined.accepts[states[hits]]
        found = []
        for rule in range(len(self.rules)):
            own = hits[(bits >> rule & 1).astype(bool)]
            last = own[np.diff(own, append=-1) != 1]
            found += [(rule, int(place)) for place in last]
        return found

    def matches(self, data: bytes) -> Found:
        """Matches of each rule as (first byte, rule, byte behind the last)."""
        found, rule, spent = [], -1, 0
        for number, place in self.ends(np.frombuffer(data, dtype=np.uint8)):
            if number != rule:
                rule, spent = number, 0
            walked = self.reversed[rule].walk(_back(data, place, spent))
            steps = [k for k, state in enumerate(walked) if self.reversed[rule].accepts[state]]
            if not steps:
                continue  # it would overlap the match before
            start, spent = place - steps[-1], place + 1
            states = self.forward[rule].walk(data[start:spent])
            tail = next(k for k, state in enumerate(states) if self.forward[rule].accepts[state])
            if spent - start - tail >= self.rules[rule].least:
                found.append((start, rule, spent))
        return found

    def texts(self, values: Sequence[str]) -> list[Found]:
        """Matches in every text in code points, by start and rule."""
        out: list[Found] = []
        for part in portions(values):
            encoded = [value.encode("utf-8", "replace") for value in values[part]]
            starts = np.cumsum([0, *(len(e) + 1 for e in encoded)])
            found = [[] for _ in encoded]
            for start, rule, end in self.matches(BORDER.join(encoded)):
                own = int(np.searchsorted(starts, start, side="right")) - 1
                found[own].append((start - int(starts[own]), rule, end - int(starts[own])))
            out += [_code_points(e, f) for e, f in zip(encoded, found)]
        return out


def _back(data: bytes, place: int, least: int) -> Iterator[int]:
    for k in range(place, least - 1, -1):
        yield data[k]


def _code_points(encoded: bytes, found: Found) -> Found:
    if not found:
        return []
    # A character begins at every byte that continues none.
    begun = np.cumsum((np.frombuffer(encoded, dtype=np.uint8) & 0xC0) != 0x80)
    count = lambda k: int(begun[k - 1]) if k else 0
    return sorted((count(a), rule, count(b)) for a, rule, b in found)


def compile_rules(rules: Sequence[Rule] = RULES) -> Scanner:
    combined = compile_patterns([rule.pattern for rule in rules])
    forward = [compile_patterns([rule.pattern], anywhere=False) for rule in rules]
    back = [compile_patterns([backwards(parse(rule.pattern))], anywhere=False) for rule in rules]
    return Scanner(tuple(rules), combined, tuple(forward), tuple(back))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, spans) of every row: all matches by start, then in the order of the rules. A narrow stage."""
    kinds = [rule.kind for rule in rules]
    shared = docs.sparkSession.sparkContext.broadcast(compile_rules(rules))  # a few hundred KB
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.texts([value or "" for value in batch.column(1).to_pylist()])
            spans = [[{"kind": kinds[rule], "start": a, "end": b} for a, rule, b in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["key", "spans"])

    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_arrow(chosen, run, f"key {docs.schema[key].dataType.simpleString()}, spans {SPANS}")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts and digests of the spans of every row."""
    base = [rule.kind for rule in BASE]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    own = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(own(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return find(docs, key, text, rules).select(
        F.col("key").alias(key),
        *counts,
        F.sha2(F.array_join(F.transform(own(*base), line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )


def replaced(text: str, found: Found, kinds: Sequence[str]) -> str:
    """The text with every secret named by its kind; of overlapping ones the first, then the longest."""
    parts, at = [], 0
    for start, rule, end in sorted(found, key=lambda f: (f[0], -f[2], f[1])):
        if start >= at:
            parts += [text[at:start], f"[{kinds[rule].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The same rows and columns with secrets replaced in the text; a null text stays null."""
    kinds = [rule.kind for rule in rules]
    shared = docs.sparkSession.sparkContext.broadcast(compile_rules(rules))
    at, names = docs.columns.index(text), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, values = batch.columns, batch.column(at).to_pylist()
            found = shared.value.texts([value or "" for value in values])
            columns[at] = pa.array([None if v is None else replaced(v, f, kinds) for v, f in zip(values, found)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    return map_arrow(docs.toDF(*names), run, schema).toDF(*docs.columns)
