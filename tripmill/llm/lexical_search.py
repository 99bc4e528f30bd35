"""Ranked lexical search with K2-treaps over grids of terms and documents.

Documents are cut into shards of neighbouring rows. A shard keeps its postings: which of its terms
stands in which of its documents, how often, and the length of every document. Over the postings of
the terms that are asked for lies a K2-treap: a quadtree over the grid of terms and documents whose
cells are stored only where they hold a posting, each with a bitmap of its four quadrants and the
highest impact below it; the place of a child follows from counting bits. Terms are rows by falling
frequency, so that cells of rare terms are mostly empty.

An item is a set of rows. Its search starts at the root and goes down ranges of documents, halving
them: every row has its own path of cells, and the sum of the weighted maxima of the paths' cells
bounds the score of each document in the range. The ranges of the highest bounds are halved first, in
batches; at single documents the bound is the score. The search of a shard ends when no range can
reach the worst of the best found so far, in this shard or in earlier ones of the task. Nothing is
cut off otherwise, so the result is that of scoring every document.

Shards are rows of a stored table that every search reads; blocks of items meet all shards, and a
task hands on the best rows of each item. Terms are named by 64-bit hashes.

Defined results: a null, empty or blank text has no terms, is no document for the statistics and is
never returned; repeated rows are documents of their own; a null id is returned as null and comes last
among equal scores; an item without terms, or of terms that no document holds, gives no rows;
repeated items give their rows once each; a text of any length is one document; an empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.shared import discard, map_arrow, portions, stored
from tripmill.llm.shingles import BASE, LOWER, PLACES, SEED, TABLE, mix

TOP = 10
# Bounds of memory: documents of a shard (columns of a grid fit 16 bits), words of a shard, items of a block.
SHARD_DOCS = 4_096
SHARD_WORDS = 2_000_000
BLOCK_ITEMS = 256
# Copies of a block of items, so that the shards that meet it lie in as many partitions.
COPIES = 32
# Ranges halved at a time.
BATCH = 256
# Items whose best rows a task remembers before it hands them on.
OPEN_ITEMS = 4 * BLOCK_ITEMS

# What no term holds, by the pattern [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+.
IS_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    IS_TERM[_low : _high + 1] = False
BITS = np.array([bin(k).count("1") for k in range(16)], dtype=np.int32)


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every term of every text, in order; A-Z count as a-z."""
    encoded = [text.encode("utf-8", "replace") for text in texts]
    raw = np.frombuffer(b"\x00".join(encoded) + b"\x00", dtype=np.uint8)
    inside = IS_TERM[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    letters = np.flatnonzero(inside)
    place = letters - np.repeat(starts, lengths)
    values = TABLE[place % PLACES, LOWER[raw[letters]]]
    far = place >= PLACES
    if far.any():
        values[far] = mix(values[far] + (place[far] // PLACES).astype(np.uint64) * BASE)
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    hashes = mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64) * SEED)
    borders = np.cumsum([len(e) + 1 for e in encoded])
    return np.searchsorted(borders, starts, side="right"), hashes


# A shard: its documents, its terms by hash, and its postings by term and document.
SHARD = (("rows", np.int64), ("ids", np.int64), ("missing", np.bool_), ("lengths", np.int64), ("terms", np.uint64), ("starts", np.int32), ("docs", np.uint16), ("times", np.int32))
SHARD_NAMES = [name for name, _ in SHARD]


class _Filling:
    """Documents that wait for their shard to be full."""

    def __init__(self, most: int = SHARD_DOCS):
        self.most = most
        self.documents: list[tuple[int, int, bool, int]] = []
        self.columns: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.words = 0

    def add(self, row: int, key: int | None, hashes: np.ndarray) -> None:
        self.columns.append(np.full(len(hashes), len(self.documents), dtype=np.int64))
        self.hashes.append(hashes)
        self.documents.append((row, key or 0, key is None, len(hashes)))
        self.words += len(hashes)

    def full(self) -> bool:
        return len(self.documents) >= self.most or self.words >= SHARD_WORDS

    def shard(self) -> pa.RecordBatch:
        terms, rank = np.unique(np.concatenate(self.hashes), return_inverse=True)
        cells, times = np.unique((rank << 16) | np.concatenate(self.columns), return_counts=True)
        starts = np.searchsorted(cells >> 16, np.arange(len(terms) + 1))
        parts = [*(list(c) for c in zip(*self.documents)), terms, starts, cells & 0xFFFF, times]
        packed = [np.asarray(p).astype(t).tobytes() for p, (_, t) in zip(parts, SHARD)]
        names = [*SHARD_NAMES, "n_docs", "n_words"]
        values = [*(pa.array([p], pa.binary()) for p in packed), pa.array([len(self.documents)], pa.int64()), pa.array([self.words], pa.int64())]
        self.__init__(self.most)
        return pa.RecordBatch.from_arrays(values, names=names)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The shards, a row each: a narrow stage over all documents. Store it to search it more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filling = _Filling(shard_docs)
        for batch in batches:
            rows, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values = [value or "" for value in batch.column(2).to_pylist()]
            for part in portions(values):
                own, hashes = term_hashes(values[part])
                edges = np.searchsorted(own, np.arange(part.stop - part.start + 1))
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if a < b:
                        filling.add(rows[part.start + k], keys[part.start + k], hashes[a:b])
                        if filling.full():
                            yield filling.shard()
        if filling.documents:
            yield filling.shard()

    chosen = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = ", ".join(f"{name} binary" for name in SHARD_NAMES)
    return map_arrow(chosen, run, f"{schema}, n_docs long, n_words long")


def document_frequencies(shards: DataFrame) -> DataFrame:
    """(term, n): in how many documents of a shard a term stands, a row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1)):
                counts = np.diff(np.frombuffer(starts.as_buffer(), dtype=np.int32)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_buffer(), dtype=np.int64)), pa.array(counts)], names=["term", "n"])

    return map_arrow(shards.select("terms", "starts"), run, "term long, n long")


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term) for the distinct terms of every item; ``item`` names a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [value or "" for value in batch.column(2).to_pylist()]
            for part in portions(values):
                own, hashes = term_hashes(values[part])
                pairs = pa.table({"own": own, "term": hashes.view(np.int64)}).group_by(["own", "term"]).aggregate([])
                at = pa.array(np.asarray(pairs["own"]) + part.start)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pairs["term"].combine_chunks()], names=["item", "item_id", "term"])

    chosen = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{key}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(chosen, run, f"item long, item_id {items.schema[key].dataType.simpleString()}, term long")


def _spread(x: np.ndarray) -> np.ndarray:
    """Every bit of 32-bit numbers moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


@dataclass
class Treap:
    """Cells of all levels in one row, those of a level by their place along the curve of quadrants.

    Cell 0 is empty and stands for every cell without postings. ``quadrants`` is a bitmap of a cell's
    children, ``child`` the place of the first; ``highest`` is the highest impact in the cell.
    """

    height: int
    root: int
    quadrants: np.ndarray
    child: np.ndarray
    highest: np.ndarray
    terms: np.ndarray  # sorted hashes
    row: np.ndarray  # of each term

    def rows_of(self, terms: np.ndarray) -> np.ndarray:
        """Rows of terms in the grid, -1 for those without postings."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.row[at], -1)


def build_treap(terms: np.ndarray, counts: np.ndarray, docs: np.ndarray, impacts: np.ndarray, columns: int) -> Treap:
    """A treap over the postings of sorted ``terms``, ``counts`` of them for each."""
    row = np.empty(len(terms), dtype=np.int64)
    row[np.argsort(-counts, kind="stable")] = np.arange(len(terms))
    height = max(1, int(len(terms) - 1).bit_length(), int(columns - 1).bit_length())
    code = (_spread(np.repeat(row, counts)) << np.uint64(1)) | _spread(docs)
    order = np.argsort(code, kind="stable")
    code, highest = code[order], impacts[order]
    levels = [(np.zeros(len(code), dtype=np.uint8), np.zeros(len(code), dtype=np.int64), highest)]
    for _ in range(height):
        quadrant, code = code & np.uint64(3), code >> np.uint64(2)
        first = np.flatnonzero(np.diff(code, prepend=code[0] + np.uint64(1)) != 0)
        bits = np.bitwise_or.reduceat((1 << quadrant.astype(np.int64)).astype(np.uint8), first)
        highest, code = np.maximum.reduceat(highest, first), code[first]
        levels.append((bits, first, highest))
    # One row of all levels, leaves first, behind the empty cell.
    bases = np.cumsum([1, *(len(level[0]) for level in levels)])
    child = [levels[0][1], *(level[1] + bases[k] for k, level in enumerate(levels[1:]))]
    none = [np.zeros(1, dtype=np.int64)]
    return Treap(
        height,
        int(bases[-2]),
        np.concatenate([np.zeros(1, dtype=np.uint8), *(level[0] for level in levels)]),
        np.concatenate(none + child).astype(np.int32),
        np.concatenate(none + [level[2] for level in levels]),
        terms,
        row,
    )


def descend(treap: Treap, rows: np.ndarray, weights: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, scores) that hold the ``top`` best documents of a query with a score above 0 and of
    ``least`` or more; more may be among them.
    """
    found, scores = [], []
    paths, level, first = np.full((1, len(rows)), treap.root, dtype=np.int32), np.array([treap.height]), np.array([0])
    bound = np.array([int((weights * treap.highest[treap.root]).sum())])
    best = np.empty(0, dtype=np.int64)
    least = max(least, 1)
    while True:
        open_ = bound >= least
        if not open_.all():
            paths, level, first, bound = paths[open_], level[open_], first[open_], bound[open_]
        if not len(bound):
            break
        if len(bound) > BATCH:
            chosen = np.argpartition(bound, len(bound) - BATCH)
            rest, chosen = chosen[:-BATCH], chosen[-BATCH:]
            own, own_level, own_first = paths[chosen], level[chosen], first[chosen]
            paths, level, first, bound = paths[rest], level[rest], first[rest], bound[rest]
        else:
            own, own_level, own_first = paths, level, first
            paths, level, first, bound = paths[:0], level[:0], first[:0], bound[:0]
        # One level down: every path chooses its half of the rows, the range splits into halves.
        below = own_level - 1
        upper = (rows[None, :] >> below[:, None]) & 1
        quadrants, child = treap.quadrants[own], treap.child[own]
        for half in (0, 1):
            quadrant = upper * 2 + half
            there = (quadrants >> quadrant) & 1
            cells = np.where(there, child + BITS[quadrants & ((1 << quadrant) - 1)], 0)
            sums = treap.highest[cells] @ weights
            columns = own_first + (half << below)
            keep = sums >= least
            single = keep & (below == 0)
            if single.any():
                found.append(columns[single])
                scores.append(sums[single])
                best = np.sort(np.concatenate([best, sums[single]]))[-top:]
                if len(best) == top:
                    least = max(least, int(best[0]))
            wide = keep & (below > 0)
            if wide.any():
                paths, level = np.concatenate([paths, cells[wide].astype(np.int32)]), np.concatenate([level, below[wide]])
                first, bound = np.concatenate([first, columns[wide]]), np.concatenate([bound, sums[wide]])
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    columns, sums = np.concatenate(found), np.concatenate(scores)
    return columns[sums >= least], sums[sums >= least]


def impacts(times: np.ndarray, lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What a term adds to a document's score, but for its weight; whole numbers."""
    m = 100 - 90 + 90 * lengths * n_docs // n_words
    times = times.astype(np.int64)
    return 1_000_000_000 * times // (1_000 * times + 8 * m)


def shard_treap(shard: dict[str, np.ndarray], wanted: np.ndarray, n_docs: int, n_words: int) -> Treap | None:
    """The treap over those postings of a shard whose terms are in sorted ``wanted``."""
    at = np.minimum(np.searchsorted(wanted, shard["terms"]), len(wanted) - 1)
    held = np.flatnonzero(wanted[at] == shard["terms"])
    if not len(held):
        return None
    starts = shard["starts"].astype(np.int64)
    counts = starts[held + 1] - starts[held]
    skipped = np.repeat(starts[held] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    places = np.arange(counts.sum()) + skipped
    docs = shard["docs"][places].astype(np.int64)
    weight = impacts(shard["times"][places], shard["lengths"][docs], n_docs, n_words)
    return build_treap(shard["terms"][held], counts, docs, weight, len(shard["rows"]))


class Leaders:
    """The best documents so far of every item."""

    def __init__(self, top: int):
        self.top = top
        self.held: dict[int, list[tuple]] = {}

    def least(self, item: int) -> int:
        own = self.held.get(item, ())
        return -own[-1][0] if len(own) == self.top else 1

    def add(self, item: int, columns: np.ndarray, scores: np.ndarray, shard: dict[str, np.ndarray]) -> None:
        new = [(-int(s), bool(shard["missing"][c]), int(shard["ids"][c]), int(shard["rows"][c])) for c, s in zip(columns.tolist(), scores)]
        if new:
            self.held[item] = sorted(self.held.get(item, []) + new)[: self.top]

    def table(self) -> pa.RecordBatch:
        lines = [(item, -s, None if missing else key, row) for item, own in self.held.items() for s, missing, key, row in own]
        self.held = {}
        columns = list(zip(*lines)) if lines else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "score", "doc_id", "row"])


def meet(shards: DataFrame, blocks: DataFrame, n_blocks: int, n_docs: int, n_words: int, top: int) -> DataFrame:
    """(item, score, doc_id, row): every block of items searched in every shard, the best of a task."""
    numbers = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    dealt = shards.drop("n_docs", "n_words").withColumn("block", F.explode(numbers)).withColumn("copy", F.pmod(F.xxhash64("rows"), F.lit(COPIES)).cast("int"))
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    both = dealt.join(copies, ["block", "copy"]).select(*SHARD_NAMES, "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = Leaders(top)
        for batch in batches:
            for k in range(batch.num_rows):
                shard = {name: np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t) for c, (name, t) in enumerate(SHARD)}
                asked = batch.column(len(SHARD))[k].values
                items, terms, weights = (np.asarray(asked.field(name)) for name in ("item", "term", "weight"))
                terms = terms.view(np.uint64)
                treap = shard_treap(shard, np.unique(terms), n_docs, n_words)
                if treap is None:
                    continue
                order = np.argsort(items, kind="stable")
                edges = np.flatnonzero(np.diff(items[order], prepend=items[order[0]] - 1))
                for own in np.split(order, edges[1:]):
                    item, rows = int(items[own[0]]), treap.rows_of(terms[own])
                    some = own[rows >= 0]
                    if len(some):
                        leaders.add(item, *descend(treap, rows[rows >= 0], weights[some], leaders.least(item), top), shard)
                if len(leaders.held) > OPEN_ITEMS:
                    yield leaders.table()
        yield leaders.table()

    return map_arrow(both, run, "item long, score long, doc_id long, row long")


def search(shards: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", top: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of every item over a stored ``index``."""
    spark = shards.sparkSession
    asked, asked_folder = stored(item_terms(items, key, text), "item-terms")
    totals = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("l")).first()
    n_docs, n_words, n_items = totals["n"] or 0, totals["l"] or 0, asked.select("item").distinct().count()
    frequencies = document_frequencies(shards).join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(1000) * F.ln(F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1)))
    n_blocks = max(1, -(-n_items // block_items))
    weighed = asked.join(frequencies, "term").select(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block"), F.struct("item", "term", weight.alias("weight")).alias("one"))
    # A block holds some hundred items; adaptive execution broadcasts blocks that are few.
    blocks, blocks_folder = stored(weighed.groupBy("block").agg(F.collect_list("one").alias("asked")), "item-blocks")
    found = meet(shards, blocks, n_blocks, n_docs, max(n_words, 1), top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select("item", "item_id").distinct()
    out = ranked.join(names, "item").select(F.col("item_id").alias(key), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    out, _ = stored(out, "ranked")
    for folder in (asked_folder, blocks_folder):
        discard(spark, folder)
    return out


def search_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Index all documents, search for all items, and remove the index."""
    shards, folder = stored(index(docs), "shards")
    out = search(shards, items)
    discard(docs.sparkSession, folder)
    return out
