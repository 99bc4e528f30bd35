"""Hard negatives by inner product, with bounds along a spanning tree of the anchors.

Scores are inner products of vectors of whole numbers, floor(256 * x) of every component. For every
anchor the best rows of its own label are its positives; the negatives of a positive are the best
rows of other labels whose score lies in a window below the positive's.

Anchors are sorted by hashed signs, which brings like ones together, and cut into blocks of fixed
size. In a block the anchors form a least spanning tree. A candidate's score at a child anchor
differs from that at the parent by at most the length of the edge times the candidate's norm, so
an interval known at the parent gives one at the child. Only candidates whose interval overlaps what
the child still looks for (the scores of a window, or scores no worse than the best so far) are
scored again; for them the interval shrinks to a point. Intervals rule out, they never decide, so the
result is that of scoring every pair.

Candidates lie in chunks of fixed size. Every chunk meets every block once for the positives and
once for the negatives, and a task keeps the best rows per anchor of the blocks it is at. No row
is left out on the way, and no task holds more than some blocks and one chunk.

Defined results: rows with a null label, a null vector or a null, NaN or infinite component take no
part; rows with a null id are candidates, are reported as null and come last among equal scores, and
are no anchors; repeated rows are rows of their own, so a row's copy may be its positive; vectors of
different lengths never meet; vectors without components all score 0; an anchor without another row
of its label, or a positive without a row in its window, gives no rows; an empty table gives none.
Scores are exact; one outside 64 bits raises. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.shared import discard, map_arrow, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative scores LOW to HIGH percent of its positive.
LOW, HIGH = 80, 100
# Bounds of memory: rows of a chunk and anchors of a block, fewer where vectors are long.
CHUNK_ROWS = 4_096
BLOCK_ROWS = 2_048
COMPONENTS = 1 << 18
SIGNS = 32
# Copies of every block, so that the chunks that meet it lie in as many partitions.
COPIES = 32
# Chunks that a task fills at a time, one for every length of vectors.
OPEN_CHUNKS = 16
# Blocks whose best rows a task remembers before it hands them on.
OPEN_BLOCKS = 8
# Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
# Rounding of distances and norms, well above what they lose.
ROOM = 1e-9
NO_ID = np.iinfo(np.int64).max


def anchors_of(key: Column) -> Column:
    return key % 100 == 0


@dataclass
class Rows:
    """Vectors side by side. ``row`` names a row for good, ``missing`` tells a null id."""

    row: np.ndarray
    id: np.ndarray
    missing: np.ndarray
    label: np.ndarray
    vectors: np.ndarray

    @property
    def norms(self) -> np.ndarray:
        return np.sqrt((self.vectors * self.vectors).sum(axis=1))


ROW_TYPES = (("rows", np.int64), ("ids", np.int64), ("missing", np.bool_), ("labels", np.int64), ("vectors", np.float64))


def pack_rows(rows: Rows) -> list[bytes]:
    return [np.ascontiguousarray(v, dtype=t).tobytes() for v, (_, t) in zip((rows.row, rows.id, rows.missing, rows.label, rows.vectors), ROW_TYPES)]


def unpack_rows(parts: list[bytes], width: int) -> Rows:
    row, key, missing, label, vectors = (np.frombuffer(p, dtype=t) for p, (_, t) in zip(parts, ROW_TYPES))
    return Rows(row, key, missing, label, vectors.reshape(len(row), width))


PACKED = ", ".join(f"{name} binary" for name, _ in ROW_TYPES)


def usable(df: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(row, id, label, width, vector) of the rows that take part, vectors in whole numbers."""
    own = F.col(f"`{vector}`")
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Doubles of 2 ** 53 and more are whole already, and may lie outside a long.
    scaled = lambda x: x.cast("double") * SCALE
    whole = F.transform(own, lambda x: F.when(F.abs(scaled(x)) < EXACT, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    kept = df.where(own.isNotNull() & label.isNotNull() & finite)
    return kept.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.size(own).alias("width"),
        whole.alias("vector"),
    )


def chunks(rows: DataFrame, most: int, more: str = "") -> DataFrame:
    """Rows packed into chunks of at most ``most``, each of one vector length and of one partition.

    With ``more`` a chunk is the rows of one value of it; the input must be sorted by it then.
    """
    names = ["width", "part", *(name for name, _ in ROW_TYPES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple]] = {}

        def packed(key: tuple) -> pa.RecordBatch:
            pieces = held.pop(key)
            joined = [np.concatenate([piece[k] for piece in pieces]) for k in range(len(ROW_TYPES))]
            values = [key[0], key[1], *pack_rows(Rows(*joined))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int32(), pa.int64(), *[pa.binary()] * len(ROW_TYPES)])], names=names)

        for batch in batches:
            row, key, label, width, vector, part = (batch.column(k) for k in range(6))
            columns = [np.asarray(row), np.asarray(key.fill_null(int(NO_ID))), np.asarray(key.is_null()), np.asarray(label)]
            widths, parts = np.asarray(width), np.asarray(part)
            flat, starts = np.asarray(vector.flatten(), dtype=np.float64), np.concatenate([[0], np.cumsum(widths)])
            order = np.lexsort((parts, widths))  # stable, so the order inside stays
            edges = np.flatnonzero((np.diff(widths[order], prepend=-1) != 0) | (np.diff(parts[order], prepend=-1) != 0))
            for at in np.split(order, edges[1:]) if len(order) else []:
                w, p = int(widths[at[0]]), int(parts[at[0]])
                limit = max(1, min(most, COMPONENTS // max(w, 1)))
                for k in range(0, len(at), limit):
                    some = at[k : k + limit]
                    vectors = flat[starts[some][:, None] + np.arange(w)]
                    if more and (w, p) not in held:
                        for key in list(held):
                            yield packed(key)
                    pieces = held.setdefault((w, p), [])
                    if sum(len(piece[0]) for piece in pieces) + len(some) > limit:
                        yield packed((w, p))
                        pieces = held.setdefault((w, p), [])
                    pieces.append((*(c[some] for c in columns), vectors))
            if not more and len(held) > OPEN_CHUNKS:  # of so many vector lengths
                for key in list(held):
                    yield packed(key)
        for key in list(held):
            yield packed(key)

    part = F.col(more) if more else F.lit(0)
    chosen = rows.select("row", "id", "label", "width", "vector", part.cast("long").alias("part"))
    return map_arrow(chosen, run, f"width int, part long, {PACKED}")


def sign_code() -> Column:
    """Signs of hashed combinations of the components, as one number."""
    sign = lambda k: F.aggregate(
        F.transform("vector", lambda x, i: x * F.when(F.xxhash64(i, F.lit(k)) > 0, 1.0).otherwise(-1.0)), F.lit(0.0), lambda a, x: a + x
    )
    return sum((F.when(sign(k) > 0, F.lit(1 << k)).otherwise(F.lit(0)) for k in reversed(range(SIGNS))), F.lit(0)).cast("long")


def tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A least spanning tree of rows: their order from the root, parents and edge lengths.

    A child comes after its parent, and the largest branch of a node last, so that few intervals
    have to be kept at a time.
    """
    n = len(vectors)
    parent, length = np.full(n, -1), np.zeros(n)
    near, via, inside = np.full(n, np.inf), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    reached, at = [0], 0
    inside[0] = True
    for _ in range(n - 1):
        gap = vectors - vectors[at]
        gap = np.sqrt((gap * gap).sum(axis=1))
        closer = gap < near
        near[closer], via[closer] = gap[closer], at
        at = int(np.argmin(np.where(inside, np.inf, near)))
        if inside[at]:  # distances that overflow
            at = int(np.flatnonzero(~inside)[0])
        inside[at], parent[at], length[at] = True, via[at], near[at]
        reached.append(at)
    branch = np.ones(n, dtype=np.int64)
    for node in reversed(reached[1:]):
        branch[parent[node]] += branch[node]
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reached[1:]:
        children[parent[node]].append(node)
    order, open_ = [], [0]
    while open_:
        node = open_.pop()
        order.append(node)
        open_ += sorted(children[node], key=lambda c: -branch[c])
    return np.array(order), parent, length


def blocks(anchors: DataFrame, most: int = BLOCK_ROWS) -> tuple[DataFrame, list[str]]:
    """The anchors packed into blocks of like ones, with their trees; and folders to discard.

    The place of an anchor in the order of signs comes from counts per range, one a partition.
    """
    spark = anchors.sparkSession
    ordered = anchors.withColumn("code", sign_code()).repartitionByRange("width", "code", "row").sortWithinPartitions("width", "code", "row")
    ranged, first_folder = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "anchors")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("range")).agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    shifts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    placed = ranged.withColumn("range", part).join(F.broadcast(shifts), "range").withColumn("at", F.col("shift") + inside)
    limit = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(COMPONENTS) / F.greatest("width", F.lit(1)))))
    numbered = placed.withColumn("part", F.floor(F.col("at") / limit)).repartition("width", "part").sortWithinPartitions("width", "part", "at")
    names = ["width", "block", *(name for name, _ in ROW_TYPES), "order", "parent", "length"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                width, part, *parts = (batch.column(c)[k].as_py() for c in range(batch.num_columns))
                order, parent, length = tree(unpack_rows(parts, width).vectors)
                values = [width, part, *parts, order.astype(np.int64).tobytes(), parent.astype(np.int64).tobytes(), length.tobytes()]
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    grown = map_arrow(chunks(numbered, most, "part"), grow, f"width int, block long, {PACKED}, order binary, parent binary, length binary")
    out, folder = stored(grown, "anchor-blocks")
    return out, [first_folder, folder]


class Scores:
    """Intervals and exact scores of one chunk at the anchors of a block, along its tree."""

    def __init__(self, anchors: Rows, order: np.ndarray, parent: np.ndarray, length: np.ndarray, chunk: Rows):
        self.anchors, self.chunk, self.order, self.parent, self.length = anchors, chunk, order, parent, length
        self.norms, self.own = chunk.norms, anchors.norms
        most = float(self.norms.max(initial=0.0)) * float(self.own.max(initial=0.0))
        self.exact = most < EXACT / 2  # every partial sum is below this too
        self.children = np.bincount(parent[parent >= 0], minlength=len(order))
        self.scored = 0

    def at(self, anchor: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of some candidates at an anchor."""
        self.scored += len(wanted)
        if self.exact:
            return self.chunk.vectors[wanted] @ self.anchors.vectors[anchor]
        left = [[int(x) for x in row] for row in self.chunk.vectors[wanted]]
        right = [int(x) for x in self.anchors.vectors[anchor]]
        return np.array([sum(a * b for a, b in zip(row, right)) for row in left], dtype=object)

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, low, high) down the tree. The caller narrows the intervals that it scores anew,
        and the children's come from those."""
        held: dict[int, list] = {}
        for anchor in self.order.tolist():
            reach = self.norms * self.own[anchor]
            reach = reach + ROOM * (1 + reach)
            low, high = -reach, reach
            up = int(self.parent[anchor])
            if up >= 0 and self.exact:
                over, under, left = held[up]
                step = self.length[anchor] * self.norms
                # Intervals of the parent may be of the size of its own reach, so they round like that.
                step = step + ROOM * (1 + step + np.maximum(np.abs(over), np.abs(under)))
                low, high = np.maximum(low, over - step), np.minimum(high, under + step)
                held[up][2] = left - 1
                if left == 1:
                    del held[up]
            yield anchor, low, high
            if self.children[anchor]:
                held[anchor] = [low, high, int(self.children[anchor])]


def best(scores: np.ndarray, rows: Rows, places: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` best of the rows at some places: highest score, then smallest id, null ids last."""
    some = range(len(scores))
    if len(scores) > 4 * k and scores.dtype != object:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k]).tolist()
    found = [(-int(scores[i]), bool(rows.missing[p]), int(rows.id[p]), int(rows.row[p])) for i, p in zip(some, places[some].tolist())]
    return sorted(found)[:k]


FOUND = "block long, width int, at int, slot int, score decimal(38,0), id long, row long"
FOUND_NAMES = [field.split()[0] for field in FOUND.split(", ")]
FOUND_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64(), pa.int64()]


class Best:
    """The best rows so far of every (anchor, slot) of a block: at most ``k`` each."""

    def __init__(self, k: int):
        self.k = k
        self.held: dict[tuple[int, int], list[tuple]] = {}

    def least(self, at: int, slot: int) -> float:
        """The score that a further row must reach."""
        own = self.held.get((at, slot), ())
        return -own[-1][0] if len(own) == self.k else -np.inf

    def add(self, at: int, slot: int, scores: np.ndarray, rows: Rows, places: np.ndarray) -> None:
        own = self.held.get((at, slot), [])
        self.held[at, slot] = sorted(own + best(scores, rows, places, self.k))[: self.k]

    def table(self, block: int, width: int) -> pa.RecordBatch:
        lines = [(block, width, at, slot, -s, None if missing else key, row) for (at, slot), own in self.held.items() for s, missing, key, row in own]
        columns = list(zip(*lines)) if lines else [[] for _ in FOUND_TYPES]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FOUND_TYPES)], names=FOUND_NAMES)


def find_positives(scores: Scores, kept: Best, k: int) -> None:
    """Candidates of the anchor's label, but for the anchor's own row."""
    chunk, anchors = scores.chunk, scores.anchors
    members = {int(label): np.flatnonzero(chunk.label == label) for label in np.unique(anchors.label)}
    for anchor, low, high in scores.walk():
        own = members[int(anchors.label[anchor])]
        own = own[chunk.row[own] != anchors.row[anchor]]
        if not len(own):
            continue
        bar = kept.least(anchor, 0)
        if len(own) > k:
            bar = max(bar, np.partition(low[own], len(own) - k)[len(own) - k])
        wanted = own[high[own] >= bar] if scores.exact else own
        if len(wanted):
            exact = scores.at(anchor, wanted)
            if scores.exact:
                low[wanted] = high[wanted] = exact
            kept.add(anchor, 0, exact, chunk, wanted)


def find_negatives(scores: Scores, kept: Best, windows: list[list[tuple[int, int]]]) -> None:
    """Candidates of other labels in the windows (slot, positive's score) of every anchor."""
    chunk, anchors = scores.chunk, scores.anchors
    others = {int(label): np.flatnonzero(chunk.label != label) for label in np.unique(anchors.label)}
    for anchor, low, high in scores.walk():
        own = others[int(anchors.label[anchor])]
        # A window below zero holds no whole number, as its lower end lies above its upper one.
        spans = [(slot, -(-LOW * s // 100), HIGH * s // 100) for slot, s in windows[anchor] if LOW * s <= HIGH * s]
        if not spans or not len(own):
            continue
        if not scores.exact:
            exact = scores.at(anchor, own)
            for slot, a, b in spans:
                some = np.array([a <= s <= b for s in exact], dtype=bool)
                kept.add(anchor, slot, exact[some], chunk, own[some])
            continue
        needed = np.zeros(len(own), dtype=bool)
        for slot, a, b in spans:
            needed |= (high[own] >= max(a, kept.least(anchor, slot))) & (low[own] <= b)
        wanted = own[needed]
        if not len(wanted):
            continue
        exact = scores.at(anchor, wanted)
        low[wanted] = high[wanted] = exact
        for slot, a, b in spans:
            some = (exact >= max(a, kept.least(anchor, slot))) & (exact <= b)
            if some.any():
                kept.add(anchor, slot, exact[some], chunk, wanted[some])


def meet(packed: DataFrame, blocks: DataFrame, k: int, windows: bool) -> DataFrame:
    """Every chunk with every block of its vector length: the best rows per anchor and slot of a task."""
    n = len(ROW_TYPES)
    # A chunk goes to one of the copies of a block; adaptive execution broadcasts blocks that are few.
    numbers = blocks.groupBy("width").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
    dealt = packed.join(F.broadcast(numbers), "width").withColumn("copy", F.pmod(F.xxhash64("rows"), F.lit(COPIES)))
    dealt = dealt.withColumn("block", F.explode("blocks")).drop("blocks", "part")
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    copies = copies.withColumnsRenamed({name: f"anchor_{name}" for name, _ in ROW_TYPES}).withColumn("copy", F.col("copy").cast("long"))
    both = dealt.join(copies, ["width", "block", "copy"])
    wide = ["width", "block", *(name for name, _ in ROW_TYPES), *(f"anchor_{name}" for name, _ in ROW_TYPES), "order", "parent", "length"]
    both = both.select(*wide, "wanted") if windows else both.select(*wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                width, block, *rest = (batch.column(c)[i].as_py() for c in range(batch.num_columns))
                chunk, anchors = unpack_rows(rest[:n], width), unpack_rows(rest[n : 2 * n], width)
                order, parent = (np.frombuffer(v, dtype=np.int64) for v in rest[2 * n : 2 * n + 2])
                scores = Scores(anchors, order, parent, np.frombuffer(rest[2 * n + 2], dtype=np.float64), chunk)
                if (width, block) not in open_ and len(open_) == OPEN_BLOCKS:
                    key = next(iter(open_))
                    yield open_.pop(key).table(key[1], key[0])
                kept = open_.setdefault((width, block), Best(k))
                if not windows:
                    find_positives(scores, kept, k)
                    continue
                spans: list[list[tuple[int, int]]] = [[] for _ in range(len(order))]
                for wanted in rest[2 * n + 3]:
                    spans[wanted["at"]].append((wanted["slot"], int(wanted["score"])))
                find_negatives(scores, kept, spans)
        for (width, block), kept in open_.items():
            yield kept.table(block, width)

    return map_arrow(both, run, FOUND)


def first_rows(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tasks found, numbered from 1. A group has ``k`` rows a task and copy at most."""
    order = Window.partitionBy("width", "block", "at", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``anchor`` tells by the column ``id`` which rows are anchors.
    """
    spark = df.sparkSession
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows, rows_folder = stored(usable(df, key, vector, label), "vectors")
    chosen = rows.where(anchors_of(F.col("id")) if anchor is None else anchor)
    grown, folders = blocks(chosen, block_rows)
    packed = chunks(rows, chunk_rows)
    first, first_folder = stored(first_rows(meet(packed, grown, positives, False), positives), "positives")
    by_block = first.groupBy("width", "block").agg(F.collect_list(F.struct("at", (F.col("rank") - 1).alias("slot"), "score")).alias("wanted"))
    second = first_rows(meet(packed, grown.join(by_block, ["width", "block"]), negatives, True), negatives)
    # The anchor's id is at its place in its block.
    places = grown.select("width", "block", "ids")
    ids = map_arrow(places, _listed, "width int, block long, at int, anchor_id long")
    keys = ["width", "block", "at"]
    chosen = first.select(*keys, (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = second.join(chosen, [*keys, "slot"]).join(ids, keys)
    out = out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("positive_score").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"),
    )
    out, _ = stored(out, "hard-negatives")
    for folder in [rows_folder, first_folder, *folders]:
        discard(spark, folder)
    return out


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a block's anchors with their places."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch.column(2)[i].as_py(), dtype=np.int64)
            n = len(ids)
            columns = [pa.array([batch.column(0)[i].as_py()] * n, pa.int32()), pa.array([batch.column(1)[i].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["width", "block", "at", "anchor_id"])
