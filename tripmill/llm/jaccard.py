"""Exact Jaccard join of word shingle sets, by size-banded tiles and bitmap signatures.

Two sets with similarity t or more differ little in size and share one of their first shingles
under any common order. So a set goes to tiles named by a size band and one of its first shingles;
bands double in size, and a set near the end of a band visits the next as well. The order puts
shingles that many documents hold last, so common passages open no tiles. Inside the tiles pairs
are bounded from above by the bits their hashed bitmaps have in common, and only pairs that pass are
compared exactly, as intersections of sorted arrays. Nothing is capped and nothing is sampled.

Equal sets are one set from the start, so copies cost no pairs. Since the result is connected
components, tiles join their members to hubs in rounds, one comparison a set and round. A tile's hub
leaves it after its round, as all its pairs are known by then, so tiles of two sets, nearly all of
them, are done after one round, and so are tiles whose sets are all in one component. Only what the
rounds leave is paired within the tiles.

Defined results: a null, empty or blank text has an empty set and is linked with nothing; fewer
words than a shingle count as one shingle; repeated rows are copies; rows with a null id get a
result with a null component id unless their set also has an id; an empty table gives no rows. Only
the id and the results are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.shared import cut, discard, map_arrow, row_hash, stored
from tripmill.llm.shingles import shingle_set

WORDS = 4
PERCENT = 85
# Cells that count in how many documents their shingles occur. A fixed number, whatever the input.
CELL_BITS = 17
CELLS = 1 << CELL_BITS
CELL_BLOCK = 1 << 12
SIGNATURE_BITS = 2_048
BIT_COLUMNS = [f"bits{i}" for i in range(SIGNATURE_BITS // 64)]
# Rounds of one comparison a set at most; the pairs they leave are all compared afterwards.
HUB_ROUNDS = 3
# Lowest tiles that a set carries along, so that a pair is met in one tile of the many it shares.
LEAST_TILES = 8
# Bits of the filters that keep most rows out of joins; 2 MB, whatever the input.
FILTER_BITS = 1 << 24
FILTER_BLOCK = 1 << 15  # what one bitmap_construct_agg holds


def least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b that links them: 100 * i >= percent * (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix(n: int, percent: int) -> int:
    """How many first shingles hold at least one of any set that can be linked."""
    return n - -(-(percent * n) // 100) + 1


def bands(n: int, percent: int) -> list[int]:
    """The band of size n, and the next where a larger partner may lie: sets up to n * 100 / percent."""
    own, furthest = n.bit_length(), (100 * n // percent).bit_length()
    return [own] if furthest == own else [own, own + 1]


def set_name(found: np.ndarray) -> int:
    """A 64-bit name; sets of one name count as equal, as shingles of one hash do."""
    return int.from_bytes(hashlib.md5(found.tobytes()).digest()[:8], "little", signed=True)


def signature(found: np.ndarray) -> list[int]:
    """The set's hashed bitmap as SIGNATURE_BITS / 64 whole numbers.

    A bit tells whether an odd number of elements falls on it, so large sets do not fill it up.
    """
    bits = np.bincount((found % np.uint64(SIGNATURE_BITS)).astype(np.int64), minlength=SIGNATURE_BITS) & 1
    return np.packbits(bits.astype(bool)).view(np.int64).tolist()


def cell(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def sets_and_cells(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """A row per document: key, place in the input, set name (null if empty), size, bitmap. And the
    totals of every task per block of cells: in how many documents the shingles of a cell occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        names, kind = ["key", "row", "place", "set", "n", "bits", "block", "cells"], None
        for batch in batches:
            kind, sets, sizes, bits = batch.column(0).type, [], [], []
            for value in batch.column(1).to_pylist():
                found = shingle_set(value, words)
                sets.append(set_name(found) if len(found) else None)
                sizes.append(len(found))
                bits.append(signature(found) if len(found) else None)
                np.add.at(total, cell(found), 1)
            none = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in (0, 2, 3)),
                    pa.array(sets, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bits, pa.list_(pa.int64())),
                    pa.nulls(none, pa.int64()),
                    pa.nulls(none, pa.list_(pa.int64())),
                ],
                names=names,
            )
        if kind is not None:
            blocks = list(total.reshape(-1, CELL_BLOCK))
            none = pa.nulls(len(blocks), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(blocks), kind), none, none, none, none, pa.nulls(len(blocks), pa.list_(pa.int64())), pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.list_(pa.int64()))],
                names=names,
            )

    kind = docs.schema[key].dataType.simpleString()
    chosen = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        row_hash(key, text).alias("row"),
        F.monotonically_increasing_id().alias("place"),
    )
    columns = "row long, place long, set long, n long, bits array<long>, block long, cells array<long>"
    return map_arrow(chosen, run, f"key {kind}, {columns}")


def commonness(found: DataFrame) -> np.ndarray:
    """In how many documents the shingles of every cell occur, which is the common order's rank.

    A cell sums many rare shingles, and its count strays from the others' by the root of that sum
    only, so a shingle of more documents than that lifts its cell out of all prefixes. The sums come
    to the driver, CELLS numbers for any input.
    """
    parts = found.where("block is not null").select("block", F.posexplode("cells").alias("at", "n"))
    sums = parts.groupBy("block", "at").agg(F.sum("n").alias("n")).select((F.col("block") * CELL_BLOCK + F.col("at")).alias("cell"), "n")
    totals = sums.toPandas()
    total = np.zeros(CELLS, dtype=np.int64)
    total[totals["cell"].to_numpy(dtype=np.int64)] = totals["n"].to_numpy(dtype=np.int64)
    return total


def first_shingles(found: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set under the common order: cells of few documents first, then by hash."""
    order = np.lexsort((found, classes[cell(found)]))
    return found[order[: prefix(len(found), percent)]]


def tiles(docs: DataFrame, classes: np.ndarray, text: str, words: int, percent: int) -> DataFrame:
    """(tile, set) for every tile of every set; a task tells each of its sets once.

    A tile is a shingle's upper bits and, in the lower ones, the size band.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, told = shared.value, set()
        for batch in batches:
            tile, names, times = [], [], []
            for value in batch.column(0).to_pylist():
                found = shingle_set(value, words)
                if not len(found) or (name := set_name(found)) in told:
                    continue
                if len(told) > 1_000_000:
                    told.clear()  # repeated rows do no harm
                told.add(name)
                first = first_shingles(found, own, percent)
                for band in bands(len(found), percent):
                    tile.append((first & ~np.uint64(63)) | np.uint64(band))
                    names.append(name)
                    times.append(len(first))
            if tile:
                flat = np.concatenate(tile).view(np.int64)
                sets = np.repeat(np.array(names, dtype=np.int64), times)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(sets)], names=["tile", "set"])

    return map_arrow(docs.select(F.col(f"`{text}`").alias("text")), run, "tile long, set long")


def folded(number):
    """A bit for a number, as a column or an array. The upper half counts too: the row numbers of
    different partitions differ only there."""
    high = F.shiftright(number, 33) if isinstance(number, Column) else number >> 33
    low = number.bitwiseAND(F.lit((1 << 33) - 1)) if isinstance(number, Column) else number & ((1 << 33) - 1)
    mixed = low + high * 1_000_003
    return F.pmod(mixed, F.lit(FILTER_BITS)) if isinstance(number, Column) else mixed % FILTER_BITS


def name_filter(names: DataFrame, column: str) -> bytes:
    """FILTER_BITS bits with those of the names set; built in Spark, at most 2 MB at the driver."""
    at = folded(F.col(column))
    block = F.floor(at / FILTER_BLOCK)
    inside = F.pmod(at, F.lit(FILTER_BLOCK)).cast("long")
    parts = names.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(inside).alias("bits"))
    bits = bytearray(FILTER_BITS // 8)
    for row in parts.collect():
        start = row["block"] * (FILTER_BLOCK // 8)
        bits[start : start + FILTER_BLOCK // 8] = row["bits"]
    return bytes(bits)


def may_be_named(bits: bytes, names: np.ndarray) -> np.ndarray:
    at = folded(names)
    return (np.frombuffer(bits, dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def shared_tiles(rows: DataFrame) -> DataFrame:
    """(tile, set, first, last) of tiles that hold several sets, ``first`` the least of them.

    Minima are combined before the shuffle. Most tiles hold one set; a filter of fixed size keeps
    nearly all of those out of the join, which adaptive execution may split where a third of all
    sets share a tile.
    """
    ends = rows.groupBy("tile").agg(F.min("set").alias("first"), F.max("set").alias("last"))
    ends = cut(ends.where("first <> last"))
    wanted = rows.sparkSession.sparkContext.broadcast(name_filter(ends, "tile"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_be_named(wanted.value, batch.column(0).to_numpy())))

    return map_arrow(rows, run, "tile long, set long").join(ends, "tile").distinct()


def arrays(docs: DataFrame, places: DataFrame, text: str, words: int) -> DataFrame:
    """(at, set, hashes) of the rows at the places, each made again from its text, and of a few others.

    Making them anew costs less than keeping the sets of all documents.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(name_filter(places, "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(may_be_named(wanted.value, batch.column(1).to_numpy())))
            found = [shingle_set(value, words) for value in some.column(0).to_pylist()]
            hashes = pa.array([v.tobytes() for v in found], pa.binary())
            sets = pa.array([set_name(v) if len(v) else None for v in found], pa.int64())
            yield pa.RecordBatch.from_arrays([some.column(1), sets, hashes], names=["at", "set", "hashes"])

    chosen = docs.select(F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("at"))
    return map_arrow(chosen, run, "at long, set long, hashes binary").where("set is not null")


def bit_bound(percent: int) -> Column:
    """Whether sets a and b may link: no more can be common than their bitmaps allow.

    A bit in which they differ needs an element that only one of them has, so twice the
    intersection is at most the sum of the sizes less the number of such bits.
    """
    differ = sum((F.bit_count(F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}"))) for w in BIT_COLUMNS), F.lit(0))
    both = F.col("a.n") + F.col("b.n")
    return (100 + percent) * (both - differ) >= 2 * percent * both


def linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set names that link, by exact intersection of the sorted arrays.

    Arrays are dealt by set and place once, for both ends, and one of a pair's moves to the other.
    """
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("set").alias(end), F.col("place").alias(f"{end}_at")), end)
    pairs = cut(pairs)
    places = pairs.select(F.col("a_at").alias("place")).union(pairs.select(F.col("b_at").alias("place")))
    found = arrays(docs, places, text, words)
    left = found.select(F.col("set").alias("a"), F.col("at").alias("a_at"), F.col("hashes").alias("left"))
    right = found.select(F.col("set").alias("b"), F.col("at").alias("b_at"), F.col("hashes").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                if not (x.is_valid and y.is_valid):
                    raise RuntimeError("a text was not found again at its place; did the input change?")
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    rows = pairs.join(left, ["a", "a_at"], "left").join(right, ["b", "b_at"], "left").select("a", "b", "left", "right")
    return map_arrow(rows, run, "a long, b long")


def similar_sets(docs: DataFrame, found: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """(set, component) for every set that links with another; components are named by a set."""
    spark = docs.sparkSession
    rows, folder = stored(tiles(docs, commonness(found), text, words, percent), "tiles")
    members, members_folder = stored(shared_tiles(rows), "shared-tiles")
    discard(spark, folder)
    own = found.where("set is not null").join(members.select("set").distinct(), "set", "left_semi")
    sets = own.groupBy("set").agg(F.min(F.struct("place", "n", "bits")).alias("x"))
    sets = sets.select("set", "x.place", "x.n", *(F.get("x.bits", i).alias(w) for i, w in enumerate(BIT_COLUMNS)))
    sets, sets_folder = stored(sets, "sets")

    # Frames that go from round to round are stored: checkpoints keep the estimates of the plans they
    # cut, which multiply with every join and soon take the planner longer than the work.
    made = [sets_folder]

    def kept(df: DataFrame, purpose: str) -> DataFrame:
        df, place = stored(df, purpose)
        made.append(place)
        return df

    # (a, b): pairs within the bounds that still have to be compared, and those that were.
    pending = tried = edges = label = None
    for _ in range(HUB_ROUNDS):
        hubs = members.where("set <> first").select(F.col("set").alias("a"), F.col("first").alias("b")).distinct()
        if tried is not None:
            hubs = apart(hubs, label).join(tried, ["a", "b"], "left_anti")
        near = within_bounds(hubs, sets, percent)
        pending = kept(near if pending is None else pending.union(near).distinct(), "pairs")
        chosen = kept(pending.groupBy("a").agg(F.min("b").alias("b")), "pairs")
        good = kept(linked(chosen, sets, docs, text, words, percent), "links")
        edges = good if edges is None else edges.union(good)
        tried = chosen if tried is None else tried.union(chosen)
        label = components(edges)
        pending = kept(apart(pending.join(chosen, ["a", "b"], "left_anti"), label), "pairs")
        rest, rest_folder = stored(without_hubs(members, label), "shared-tiles")
        discard(spark, members_folder)
        members, members_folder = rest, rest_folder
        if members.isEmpty() and pending.isEmpty():
            break

    if not members.isEmpty():
        left = tile_pairs(members, label, sets, percent)
        pending = kept(pending.union(left.join(tried, ["a", "b"], "left_anti")).distinct(), "pairs")
    discard(spark, members_folder)
    if not pending.isEmpty():
        label = components(edges.union(kept(linked(pending, sets, docs, text, words, percent), "links")))
    for place in made:
        discard(spark, place)
    return label


def within_bounds(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link, by their sizes and bitmaps."""
    both = pairs.join(sets.alias("a"), pairs["a"] == F.col("a.set")).join(sets.alias("b"), pairs["b"] == F.col("b.set"))
    return both.where(near_sizes(percent) & bit_bound(percent)).select(pairs["a"], pairs["b"])


def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components; a set without a label is its own."""
    for end in ("a", "b"):
        pairs = pairs.join(label.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")), end, "left")
    return pairs.where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")


def without_hubs(members: DataFrame, label: DataFrame) -> DataFrame:
    """(tile, set, first, last) without each tile's hub; tiles that are left with one component go."""
    more = members.where("set <> first and set <> last").select("tile").distinct()
    rest = members.where("set <> first").join(more, "tile", "left_semi").select("tile", "set")
    named = cut(_named_members(rest, label))
    ends = named.groupBy("tile").agg(
        F.min("set").alias("first"), F.max("set").alias("last"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    ends = ends.where("low <> high").select("tile", "first", "last")
    return named.select("tile", "set").join(ends, "tile")


def tile_pairs(members: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b), a > b: all pairs of a tile in different components that pass the bounds."""
    least = members.groupBy("set").agg(F.slice(F.sort_array(F.collect_list("tile")), 1, LEAST_TILES).alias("least"))
    rows = _named_members(members, label).join(sets.join(least, "set"), "set")
    a, b = rows.alias("a"), rows.alias("b")
    same_tile = (F.col("a.tile") == F.col("b.tile")) & (F.col("a.set") > F.col("b.set")) & (F.col("a.component") != F.col("b.component"))
    pairs = a.join(b, same_tile & near_sizes(percent) & bit_bound(percent) & ~met_before())
    return pairs.select(F.col("a.set").alias("a"), F.col("b.set").alias("b"))


def met_before() -> Column:
    """Whether sets a and b are known to share a lower tile than this one, where they meet as well.

    Only the lowest tiles of each are at hand, so some pairs meet more than once; none is lost, as
    nothing lies below the lowest tile they share.
    """
    lowest = F.array_min(F.array_intersect("a.least", "b.least"))
    return F.coalesce(lowest < F.col("a.tile"), F.lit(False))


def near_sizes(percent: int) -> Column:
    return (100 * F.col("a.n") >= percent * F.col("b.n")) & (100 * F.col("b.n") >= percent * F.col("a.n"))


def _named_members(members: DataFrame, label: DataFrame) -> DataFrame:
    named = members.join(label.select(F.col("node").alias("set"), "component"), "set", "left")
    return named.select("tile", "set", F.coalesce("component", "set").alias("component"))


def document_components(docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """(key, row, n, component, component_id), a row per document; ``row`` is a hash of id and text.

    ``component`` names a component by one of its sets; it is null for documents without words.
    """
    found = cut(sets_and_cells(docs, key, text, words))
    own = found.where("block is null").select("key", "row", "set", "n")
    label = similar_sets(docs, found, text, words, percent).select(F.col("node").alias("set"), "component")
    # A set's documents first, then a component's sets: both minima are combined before shuffling.
    least = own.where("set is not null").groupBy("set").agg(F.min("key").alias("least"))
    least = least.join(label, "set", "left").withColumn("component", F.coalesce("component", "set"))
    by_component = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = least.join(by_component, "component").select("set", "component", "component_id")
    named = own.join(by_set, "set", "left")
    return named.select("key", "row", "n", "component", F.coalesce("component_id", "key").alias("component_id"))


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(key, n_shingles, component_id): the smallest id reachable by links, a row per document."""
    found = document_components(docs, key, text, words, percent)
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The documents without all but the first of each component; documents without words stay.

    The first is the one of the smallest id; an id goes before a null, so a component whose ids are
    all null keeps one row as well.

    A filter of fixed size passes most texts straight through; only those it cannot rule out meet
    the rows to drop in a join.
    """
    found = cut(document_components(docs, key, text, words, percent))
    grouped = found.where("n > 0")
    place = F.struct(F.col("key").isNull().alias("missing"), "key", "row")
    first = grouped.groupBy("component").agg(F.min(place).alias("first"))
    dropped = grouped.join(first, "component").where(F.col("row") != F.col("first.row")).select("row").distinct()
    # Rows that are equal in id and text share their hash; all but one of them go as well.
    repeated = grouped.groupBy("row").count().where("count > 1").select("row")
    marked = cut(dropped.union(repeated).distinct())
    wanted = docs.sparkSession.sparkContext.broadcast(name_filter(marked, "row"))
    names = [f"c{i}" for i in range(len(docs.columns))]

    def side(marked_rows: bool) -> DataFrame:
        """The rows that the filter passes, or those it rules out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = may_be_named(wanted.value, batch.column(len(names)).to_numpy())
                yield batch.filter(pa.array(hit == marked_rows))

        schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
        return map_arrow(docs.withColumn("__row", row_hash(key, text)).toDF(*names, "row"), run, schema + ", row long")

    rest = side(True).join(dropped, "row", "left_anti").select(*names, "row")
    if not repeated.isEmpty():
        again = rest.join(repeated, "row", "left_semi").where(F.length(names[docs.columns.index(text)]) > 0)
        rest = rest.join(repeated, "row", "left_anti").unionByName(again.dropDuplicates(["row"]))
    return side(False).unionByName(rest).select(names).toDF(*docs.columns)
