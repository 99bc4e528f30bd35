"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; every piece is merged on its own. A segment tree over the
byte positions of a piece holds the leftmost pair of least rank, so a merge is three logarithmic
point updates: the merged token, its live neighbour to the left, and the position that died. A piece
of any length is therefore encoded in n log n.

Pieces repeat a lot, so each Python worker remembers what short pieces encode to, up to a fixed
number of pieces. Texts never leave their partition: one narrow stage, no shuffle.

Defined results: a null text is encoded as an empty one, to no ids; repeated rows give repeated
results; lone surrogates cannot occur in a Spark string; only the id column and the results are
returned, so other columns cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import map_arrow, portions

DEAD = 1 << 62
POSITION = (1 << 32) - 1
REMEMBERED = 400_000
SHORT = 64
STEP = 4_096


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get = len(piece), ranks.get
    size = 1 << max(n - 2, 0).bit_length()
    after = list(range(1, n + 1))  # where the token at a live position ends
    before = list(range(-1, n - 1))
    tree = [DEAD] * (2 * size)  # rank << 32 | position; leaves from ``size`` on
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    while (top := tree[1]) < DEAD:
        i = top & POSITION
        gone = after[i]
        after[i] = end = after[gone]
        if end < n:
            before[end] = i
        # The position that died, the merged token, and its live neighbour to the left.
        for at in (gone, i, before[i]):
            if at < 0 or at >= n - 1:
                continue
            value = DEAD
            if at != gone and (middle := after[at]) < n:
                rank = get(piece[at : after[middle]])
                if rank is not None:
                    value = rank << 32 | at
            node = size + at
            while tree[node] != value:
                tree[node] = value
                if node == 1:
                    break
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class PairRanks:
    """Rank of two adjacent token ids, looked up for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found = {
            ranks[token[:k]] << 32 | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        keys = np.fromiter(found, dtype=np.int64, count=len(found))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], DEAD)
        self.ranks = np.append(np.fromiter(found.values(), dtype=np.int64, count=len(found))[order], 0)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)

    def keyed(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, real: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        where = np.searchsorted(self.keys, pair)
        return np.where(real & (self.keys[where] == pair), self.ranks[where] << 32 | at, DEAD)


def merge_many(pieces: list[bytes], pairs: PairRanks) -> list[list[int]]:
    """As ``merge`` for many short pieces: one tree per row of an array, all rows step together."""
    m, width = len(pieces), max(map(len, pieces))
    leaves = 1 << (width - 1).bit_length()
    n = np.fromiter(map(len, pieces), dtype=np.int64, count=m)
    place = np.arange(leaves + 1)
    token = np.zeros((m, leaves + 1), dtype=np.int64)
    token[place < n[:, None]] = pairs.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    live = place < n[:, None]
    tree = np.full((m, 2 * leaves), DEAD, dtype=np.int64)
    real = place[:-1] < n[:, None] - 1
    rows, cols = np.nonzero(real)
    tree[rows, leaves + cols] = pairs.keyed(token[rows, cols], token[rows, cols + 1], cols, True)
    half = leaves
    while half > 1:
        tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
        half //= 2
    after = np.broadcast_to(place + 1, token.shape).copy()
    before = np.broadcast_to(place - 1, token.shape).copy()
    flat = tree.reshape(-1)
    rows = np.flatnonzero(tree[:, 1] < DEAD)
    while len(rows):
        top = tree[rows, 1]
        at = top & POSITION
        gone = after[rows, at]
        end = np.minimum(after[rows, gone], leaves)
        token[rows, at] = top >> 32
        live[rows, gone] = False
        after[rows, at] = end
        before[rows, end] = at
        left = before[rows, at]
        base = rows * (2 * leaves)
        flat[base + leaves + gone] = DEAD
        flat[base + leaves + at] = pairs.keyed(top >> 32, token[rows, end], at, end < n[rows])
        has = np.flatnonzero(left >= 0)
        near = left[has]
        flat[base[has] + leaves + near] = pairs.keyed(token[rows[has], near], top[has] >> 32, near, True)
        left = np.where(left >= 0, left, at)
        for node in (gone, at, left):
            node += leaves
        while gone[0] > 1:
            for node in (gone, at, left):
                node >>= 1
                child = base + 2 * node
                flat[base + node] = np.minimum(flat[child], flat[child + 1])
        rows = rows[tree[rows, 1] < DEAD]
    ids, counts = token[live].tolist(), np.concatenate([[0], np.cumsum(live.sum(1))]).tolist()
    return [ids[a:b] for a, b in zip(counts, counts[1:])]


class Codec:
    """Encoder and decoder of one vocabulary; ids travel as decimal text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pairs = PairRanks(ranks)
        # The pattern's white space is Unicode's White_Space property.
        own = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pieces = regex.compile(own).findall
        # A space before something else always starts a piece, so texts can be cut there first.
        self.runs = regex.compile(r" (?=\P{White_Space})").split
        self.odd = regex.compile(r" (?:\p{White_Space}|\Z)").search
        self.known: dict[str, str] = {}
        self.words: dict[str, str] = {}
        order = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            order[rank] = token
        self.decimal = [str(rank) for rank in range(len(order))]
        self.lengths = np.array([len(token) for token in order], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.letters = np.frombuffer(b"".join(order), dtype=np.uint8)

    def _merged(self, pieces: set[str]) -> dict[str, str]:
        """Decimal ids of pieces; short ones by size, long ones one at a time."""
        out, by_size = {}, defaultdict(list)
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = self.decimal[whole]
            elif len(raw) > SHORT:
                out[piece] = " ".join(map(str, merge(raw, self.ranks)))
            else:
                by_size[(len(raw) - 1).bit_length()].append((piece, raw))
        for group in by_size.values():
            for start in range(0, len(group), STEP):
                part = group[start : start + STEP]
                for (piece, _), ids in zip(part, merge_many([raw for _, raw in part], self.pairs)):
                    out[piece] = " ".join(map(self.decimal.__getitem__, ids))
        return out

    def encode_many(self, texts: Sequence[str]) -> list[str]:
        cut = [(self.runs(text) if self.odd(text) else text.split(" ")) for text in texts]
        for memory in (self.known, self.words):
            if len(memory) > REMEMBERED:
                memory.clear()
        words, known = self.words, self.known
        new = {word for _, *rest in cut for word in rest if word not in words}
        pieces = {word: self.pieces(" " + word) for word in new}
        firsts = [self.pieces(first) for first, *_ in cut]
        fresh = {piece for part in (pieces.values(), firsts) for found in part for piece in found if piece not in known}
        merged = self._merged(fresh)
        ids = lambda found: " ".join([known.get(piece) or merged[piece] for piece in found])
        own = {word: ids(found) for word, found in pieces.items()}
        out = []
        for first, (_, *rest) in zip(firsts, cut):
            parts = [words.get(word) or own[word] for word in rest]
            if first:
                parts.insert(0, ids(first))
            out.append(" ".join(parts))
        known.update((piece, value) for piece, value in merged.items() if len(piece) <= SHORT)
        words.update((word, value) for word, value in own.items() if len(word) <= SHORT)
        return out

    def encode(self, text: str) -> str:
        return self.encode_many([text])[0]

    def decode(self, ids: str) -> bytes:
        if not ids:
            return b""
        found = np.fromstring(ids, dtype=np.int64, sep=" ")
        lengths = self.lengths[found]
        ends = np.cumsum(lengths)
        where = np.arange(ends[-1]) + np.repeat(self.starts[found] - (ends - lengths), lengths)
        return self.letters[where].tobytes()


@lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    """One per Python worker, kept from task to task."""
    return Codec(load_ranks(vocabulary), pattern)


def _each(
    rows: DataFrame, key: str, value: str, columns: dict[str, tuple[str, pa.DataType]], work, vocabulary: str, pattern: str
) -> DataFrame:
    """Run ``work(codec, values)`` over portions; the file travels with the job, so any node has it."""
    rows.sparkSession.sparkContext.addFile(vocabulary)
    name = vocabulary.replace("\\", "/").rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name), pattern)
        for batch in batches:
            values = [v if v is not None else "" for v in batch.column(1).to_pylist()]
            for part in portions(values):
                keys = batch.column(0).slice(part.start, part.stop - part.start)
                found = work(own, values[part])
                arrays = [pa.array(column, kind) for column, (_, kind) in zip(found, columns.values())]
                yield pa.RecordBatch.from_arrays([keys, *arrays], names=[key, *columns])

    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, " + ", ".join(f"{c} {t}" for c, (t, _) in columns.items())
    return map_arrow(rows.select(F.col(f"`{key}`"), F.col(f"`{value}`")), run, schema)


def _digests(own: Codec, texts: list[str]) -> list[list]:
    ids = own.encode_many(texts)
    return [
        [found.count(" ") + 1 if found else 0 for found in ids],
        [hashlib.sha256(found.encode()).hexdigest() for found in ids],
        [hashlib.sha256(own.decode(found)).hexdigest() for found in ids],
    ]


def digests(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return counts and hashes of both."""
    columns = {
        "n_tokens": ("long", pa.int64()),
        "ids_sha256": ("string", pa.string()),
        "decoded_sha256": ("string", pa.string()),
    }
    return _each(docs, key, text, columns, _digests, vocabulary, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every text."""
    work = lambda own, texts: [[list(map(int, ids.split())) for ids in own.encode_many(texts)]]
    return _each(docs, key, text, {"ids": ("array<int>", pa.list_(pa.int32()))}, work, vocabulary, pattern)


def decode(rows: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, bytes binary) of every id array, null as empty; an id outside the vocabulary is an error."""
    work = lambda own, arrays: [[own.decode(" ".join(map(str, a))) for a in arrays]]
    return _each(rows, key, ids, {"bytes": ("binary", pa.binary())}, work, vocabulary, pattern)
