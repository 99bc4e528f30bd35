"""Near-duplicate vectors by sorted projection passes.

In every pass the vectors are ordered by the concatenated bits of random hashes, and each is compared
with its next ``window`` neighbours. Near vectors share long prefixes, so some pass puts them side by
side. Pairs whose cosine holds are united across passes into components. Links are then counted
inside each component over all its vectors, tile by tile, so a group larger than a window has whole
counts.

The first hash of a pass is the nearest of a few centres, the others are signs of projections from
that centre; so vectors of one topic, which all lie on one side of most planes, are still told apart.
A window misses more pairs the more rows there are, so the number of passes grows with the number of
vectors (``passes_for``). Pairs that lie among very many vectors nearly as near are found less often
than RECALL says; ``exact=True`` compares every pair of chunks that the triangle inequality leaves,
whose work is the square of the vectors at worst.

Defined results: a vector that is null, empty, zero or holds a null or non-finite number links with
nothing and is its own component; vectors of different length never link; repeated rows are equal
vectors, an id repeated with one vector counts once per row; ties in the order fall by a hash of the
vector; an empty table gives no rows. Only the id and the results are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.shared import cut, discard, map_arrow, on_workers, stored

COSINE = 0.95
# Share of the pairs at COSINE, in spread vectors, that the number of passes is chosen for; and the fewest passes.
RECALL = 0.999
PASSES = 8
CENTRE_BITS = 4
SIGN_BITS = 58
WINDOW = 256
# Vectors that the centres of all passes are taken from: those of least hash.
SAMPLE = 1_024
TILE = 2_048
# Rows that are compared with others at once.
ROWS = 512
# A chunk has at most this many times TILE vectors, and bytes of doubles.
CHUNK_TILES = 8
CHUNK_BYTES = 1 << 23
# Most pivots of a vector size; a chunk's bounds are one range of angles to each.
PIVOTS = 256
# Angles lose about 1e-8 in arccos; bounds give way by more than that.
ROUNDING = 1e-6


def usable(column: str) -> Column:
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def units(raw: list[bytes]) -> np.ndarray:
    """Rows of unit length in double precision."""
    found = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)
    scaled = found / np.max(np.abs(found), axis=1, keepdims=True)  # squares of tiny or huge parts stay in range
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def passes_for(n: int, window: int, cosine: float) -> int:
    """Passes after which a pair at ``cosine`` among ``n`` spread vectors has met with probability RECALL.

    A plane parts such a pair with its angle's share of a half turn, and each halves the vectors that
    still share the prefix, until a window holds them.
    """
    together = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    if n <= window or together >= 1:
        return PASSES
    met = (n / window) ** math.log2(together) if together > 0 else 0.0
    return max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-min(max(met, 1e-3), 0.999))))


def projections(size: int, passes: int) -> np.ndarray:
    return np.random.default_rng(20_240_229 + size).standard_normal((size, passes * SIGN_BITS))


def pass_centres(sample: np.ndarray, passes: int) -> np.ndarray:
    """(passes, centres, size): other centres in every pass, so no pair is parted by all of them."""
    rng = np.random.default_rng(len(sample))
    many = max(1, min(1 << CENTRE_BITS, len(sample) // 16))
    found = []
    for _ in range(passes):
        own = sample[rng.choice(len(sample), many, replace=False)]
        for _ in range(3):
            nearest = np.argmax(sample @ own.T - (own * own).sum(axis=1) / 2, axis=1)
            own = np.stack([sample[nearest == k].mean(axis=0) if (nearest == k).any() else own[k] for k in range(many)])
        found.append(own)
    return np.stack(found)


def centres(classes: DataFrame, passes: int) -> dict[int, np.ndarray]:
    """Centres of every vector size that the SAMPLE vectors of least hash hold; other sizes do without."""
    least = classes.select("v", F.xxhash64("rep").alias("at"), "rep").orderBy("at", "rep").limit(SAMPLE).collect()
    sizes: dict[int, list[bytes]] = {}
    for row in least:
        sizes.setdefault(len(row["v"]) // 8, []).append(bytes(row["v"]))
    return {size: pass_centres(units(raw), passes) for size, raw in sizes.items()}


def sort_keys(classes: DataFrame, passes: int) -> DataFrame:
    """(pass, size, sign, rep, v): every vector once per pass, with its key of a centre and SIGN_BITS signs."""
    weights = (1 << np.arange(SIGN_BITS, dtype=np.int64))[::-1]
    shared = classes.sparkSession.sparkContext.broadcast(centres(classes, passes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column(1).to_pylist()
            sizes = np.array([len(v) // 8 for v in raw], dtype=np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                some = [raw[i] for i in own]
                if size not in planes:
                    planes[size] = projections(int(size), passes)
                middles = shared.value.get(int(size), np.zeros((passes, 1, int(size))))
                unit = units(some)
                reps, vectors = batch.column(0).take(pa.array(own)), pa.array(some, pa.binary())
                for k in range(passes):
                    n, middle, plane = len(own), middles[k], planes[size][:, k * SIGN_BITS : (k + 1) * SIGN_BITS]
                    nearest = np.argmax(unit @ middle.T - (middle * middle).sum(axis=1) / 2, axis=1)
                    signs = ((unit @ plane > (middle @ plane)[nearest]) @ weights) + (nearest.astype(np.int64) << SIGN_BITS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, k)), pa.array(np.full(n, size)), pa.array(signs), reps, vectors],
                        names=["pass", "size", "sign", "rep", "v"],
                    )

    return map_arrow(classes.select("rep", "v"), run, "pass long, size long, sign long, rep long, v binary")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of every node to the least one it hangs together with: the same components, fewer edges."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, last = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == last).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def near_pairs(rep: np.ndarray, unit: np.ndarray, fresh: int, window: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the pairs within the window whose later row is among the last ``fresh`` ones."""
    n, found = len(rep), [(rep[:0], rep[:0])]
    for start in range(n - fresh, n, ROWS):
        end, first = min(start + ROWS, n), max(start - window, 0)
        later, earlier = np.nonzero(unit[start:end] @ unit[first:end].T >= cosine)
        step = (later + start) - (earlier + first)
        good = (step > 0) & (step <= window)
        found.append((rep[earlier[good] + first], rep[later[good] + start]))
    return stars(*(np.concatenate(side) for side in zip(*found)))


def window_edges(keys: DataFrame, window: int, cosine: float) -> DataFrame:
    """Edges of all passes. Rows are range partitioned by their order and streamed through a window.

    The last rows of a partition meet the first of the next in a second step, so no border hides a pair.
    """

    def compared(rows: Iterator[tuple[tuple, np.ndarray, list[bytes]]]):
        """Stream (group, reps, vectors) runs; carry the last rows of a group on."""
        group, rep, unit = None, None, None
        for name, reps, raw in rows:
            own = units(raw)
            if name != group:
                group, rep, unit = name, reps[:0], own[:0]
            rep, unit = np.concatenate([rep, reps]), np.concatenate([unit, own])
            yield near_pairs(rep, unit, len(reps), window, cosine)
            rep, unit = rep[-window:], unit[-window:]

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray, list[bytes]]]:
        groups = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
        rep, raw = batch.column(3).to_numpy(), batch.column(4).to_pylist()
        starts = [0, *(np.flatnonzero((groups[1:] != groups[:-1]).any(axis=1)) + 1), len(rep)]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                yield tuple(groups[a]), rep[a:b], raw[a:b]

    names = ["a", "b", "part", "place", "pass", "size", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, tail = TaskContext.get().partitionId(), [], []

        def pieces():
            for batch in batches:
                for group, rep, raw in runs(batch):
                    rows = [(group, int(r), v) for r, v in zip(rep[: window - len(head)] if len(head) < window else [], raw)]
                    head.extend(rows)
                    tail.extend((group, int(r), v) for r, v in zip(rep[-window:], raw[-window:]))
                    del tail[:-window]
                    yield group, rep, raw

        for a, b in compared(pieces()):
            nothing = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), nothing, nothing, nothing, nothing, pa.nulls(len(a), pa.binary())], names=names)
        border = [(part - 1, window + i, row) for i, row in enumerate(head)] + [(part, i - len(tail), row) for i, row in enumerate(tail)]
        if border:
            columns = [[row[1] for _, _, row in border], [None] * len(border), [p for p, _, _ in border], [i for _, i, _ in border], [row[0][0] for _, _, row in border], [row[0][1] for _, _, row in border]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([row[2] for _, _, row in border], pa.binary())], names=names)

    schema = "a long, b long, part long, place long, pass long, size long, v binary"
    ordered = keys.repartitionByRange("pass", "size", "sign", "rep").sortWithinPartitions("pass", "size", "sign", "rep")
    found = cut(map_arrow(ordered.select("pass", "size", "sign", "rep", "v"), run, schema))

    def border(group: pd.DataFrame) -> pd.DataFrame:
        edges = [(np.empty(0, dtype=np.int64),) * 2]
        for _, rows in group.sort_values("place").groupby(["pass", "size"]):
            edges.append(near_pairs(rows["a"].to_numpy(), units(list(rows["v"])), len(rows), window, cosine))
        a, b = (np.concatenate(side) for side in zip(*edges))
        return pd.DataFrame({"a": a, "b": b})

    inside = found.where("part is null").select("a", "b")
    across = found.where("part is not null").groupBy("part").applyInPandas(border, "a long, b long")
    return cut(inside.union(across))


def chunk_limit(size: int) -> int:
    """Most vectors of a chunk, for vectors of ``size`` numbers."""
    return max(1, min(CHUNK_TILES * TILE, CHUNK_BYTES // (8 * size)))


def pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of every vector size: those of least hash, one for a chunk, PIVOTS at most."""
    sizes = {row["size"]: row["n"] for row in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    found = {}
    for size, n in sizes.items():
        wanted = min(PIVOTS, -(-n // chunk_limit(size)))
        some = classes.where(F.col("size") == size).orderBy(F.xxhash64("rep"), "rep").limit(wanted).select("v").collect()
        found[size] = units([bytes(row["v"]) for row in some])
    return found


def placed(members: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``members`` with ``cell``, the nearest pivot, and ``angles`` to all pivots of their size."""
    shared = members.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(3).to_pylist()
            sizes = np.array([len(v) // 8 for v in raw], dtype=np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                angles = np.arccos(np.clip(units([raw[i] for i in own]) @ shared.value[int(size)].T, -1, 1))
                taken = batch.take(pa.array(own))
                more = [pa.array(np.full(len(own), size)), pa.array(np.argmin(angles, axis=1)), pa.array(list(angles), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*taken.columns, *more], names=["component", "rep", "weight", "v", "size", "cell", "angles"])

    schema = "component long, rep long, weight long, v binary, size long, cell long, angles array<double>"
    return map_arrow(members.select("component", "rep", "weight", "v"), run, schema)


def chunk_bounds(members: DataFrame) -> DataFrame:
    """(size, cell, chunk, low, high): the least and greatest angle of a chunk to every pivot."""
    names = ["size", "cell", "chunk", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            chunks = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for name, angles in zip(chunks, batch.column(3)):
                angles = angles.values.to_numpy()
                low, high = bounds.setdefault(name, [angles, angles])
                bounds[name] = [np.minimum(low, angles), np.maximum(high, angles)]
        for name, both in bounds.items():
            yield pa.RecordBatch.from_arrays([*(pa.array([x]) for x in name), *(pa.array([x.tolist()], pa.list_(pa.float64())) for x in both)], names=names)

    parts = map_arrow(members.select("size", "cell", "chunk", "angles"), run, "size long, cell long, chunk long, low array<double>, high array<double>")
    ends = parts.select("size", "cell", "chunk", F.posexplode(F.arrays_zip("low", "high")).alias("at", "x"))
    ends = ends.groupBy("size", "cell", "chunk", "at").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    ordered = ends.groupBy("size", "cell", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("x"))
    return ordered.select("size", "cell", "chunk", F.col("x.low").alias("low"), F.col("x.high").alias("high"))


def all_links(members: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Every pair of vectors of one size: (rep, links), the weights of the others each one links with,
    and edges (a, b) that join components.

    Two vectors that link have angles to any pivot that differ by at most that of ``cosine``, so a pair
    of chunks whose ranges lie further apart for some pivot holds no link. A chunk has a bounded number
    of vectors, and each pair of chunks is one task's tile, so memory is bounded; the work is the square
    of the vectors at worst.
    """
    sized = members.withColumn("size", F.expr("length(v) div 8"))
    near = cut(placed(members, pivots(sized)))
    cells = near.groupBy("size", "cell").agg(F.count("*").alias("m"))
    limit = F.greatest(F.lit(1), F.least(F.lit(CHUNK_TILES * TILE), F.expr(f"{CHUNK_BYTES} div (8 * size)")))
    cells = cells.withColumn("chunks", F.ceil(F.col("m") / limit).cast("long"))
    near = near.join(F.broadcast(cells.drop("m")), ["size", "cell"])
    near = near.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    bounds = cut(chunk_bounds(near))
    reach = float(np.arccos(cosine)) + ROUNDING
    left = bounds.select("size", F.struct("cell", "chunk").alias("one"), F.col("low").alias("l1"), F.col("high").alias("h1"))
    right = bounds.select("size", F.struct("cell", "chunk").alias("two"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    apart = F.exists(F.arrays_zip("l1", "h1", "l2", "h2"), lambda x: (x["l1"] - reach > x["h2"]) | (x["l2"] - reach > x["h1"]))
    pairs = left.join(right, "size").where("one <= two").where(~apart).select("size", "one", "two")
    # A tile's name goes to the members of both its chunks; ``side`` tells which they came from.
    sides = F.when(F.col("one") == F.col("two"), F.array(F.struct(F.col("one").alias("of"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("one").alias("of"), F.lit(0).alias("side")), F.struct(F.col("two").alias("of"), F.lit(1).alias("side")))
    )
    sent = pairs.select("size", F.xxhash64("size", "one", "two").alias("tile"), F.explode(sides).alias("x"))
    sent = sent.select("size", "tile", F.col("x.of.cell").alias("cell"), F.col("x.of.chunk").alias("chunk"), F.col("x.side").alias("side"))
    tiled = near.select("size", "cell", "chunk", "component", "rep", "weight", "v").join(sent, ["size", "cell", "chunk"])

    def count(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["side", "rep"], kind="stable")
        unit, weight, component = units(list(tile["v"])), tile["weight"].to_numpy(), tile["component"].to_numpy()
        rep, side = tile["rep"].to_numpy(), tile["side"].to_numpy()
        alone = side.max() == 0
        left = np.flatnonzero(side == 0)
        right = left if alone else np.flatnonzero(side == 1)
        links = np.zeros(len(tile), dtype=np.int64)
        joined = (rep[:0], rep[:0])
        for start in range(0, len(left), ROWS):
            rows = left[start : start + ROWS]
            hit = unit[rows] @ unit[right].T >= cosine
            if alone:
                hit[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
            links[rows] += hit @ weight[right]
            if not alone:
                links[right] += weight[rows] @ hit
            hit &= component[rows][:, None] != component[right][None, :]
            i, j = np.nonzero(hit)
            joined = stars(*(np.concatenate(both) for both in zip(joined, (component[rows][i], component[right][j]))))
        linked = np.flatnonzero(links)
        counts = pd.DataFrame({"rep": rep[linked], "links": links[linked], "a": None, "b": None})
        edges = pd.DataFrame({"rep": None, "links": None, "a": joined[0], "b": joined[1]}, dtype="object")
        return pd.concat([counts.astype("object"), edges]).astype("Int64")

    on_workers(members.sparkSession)
    found = cut(tiled.select("tile", "side", "component", "rep", "weight", "v").groupBy("tile").applyInPandas(count, "rep long, links long, a long, b long"))
    counted = found.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    return counted, found.where("a is not null").select("a", "b")


def links_within(members: DataFrame, cosine: float) -> DataFrame:
    """(rep, links): the weights of the others of its component that each vector links with.

    Small components lie in bundles of about a chunk's vectors. A component of more is dealt into
    chunks, and every pair of its chunks is one task's tile, so no task holds a whole large one.
    """
    limit = F.greatest(F.lit(1), F.least(F.lit(CHUNK_TILES * TILE), F.expr(f"{CHUNK_BYTES} div length(any_value(v))")))
    sizes = members.groupBy("component").agg(F.count("*").alias("m"), limit.cast("long").alias("limit")).where("m > 1")
    sizes, folder = stored(sizes, "component-sizes")
    load = sizes.where("m <= limit").agg(F.coalesce(F.ceil(F.sum(F.col("m") / F.col("limit"))), F.lit(1)).alias("n")).first()["n"]
    chunks = F.when(F.col("m") <= F.col("limit"), 1).otherwise(F.ceil(F.col("m") / F.col("limit"))).cast("long")
    rows = members.join(sizes.withColumn("chunks", chunks), "component")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    large = F.col("chunks") > 1
    tiled = rows.select(
        F.when(~large, F.pmod(F.xxhash64("component"), F.lit(int(load)))).alias("bundle"),
        F.when(large, F.col("component")).alias("owner"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        "component", "rep", "weight", "v",
    )

    def count(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["component", "side", "rep"], kind="stable")
        component, side = tile["component"].to_numpy(), tile["side"].to_numpy()
        weight, rep, raw = tile["weight"].to_numpy(), tile["rep"].to_numpy(), tile["v"].to_numpy()
        links = np.zeros(len(tile), dtype=np.int64)
        ends = [0, *(np.flatnonzero(component[1:] != component[:-1]) + 1), len(tile)]
        pair = tile["low"].iat[0] != tile["high"].iat[0]
        for a, b in zip(ends, ends[1:]):
            unit = units(list(raw[a:b]))
            left = np.flatnonzero(side[a:b] == 0) if pair else np.arange(b - a)
            right = np.flatnonzero(side[a:b] == 1) if pair else left
            for start in range(0, len(left), ROWS):
                some = left[start : start + ROWS]
                hit = unit[some] @ unit[right].T >= cosine
                if not pair:
                    hit[np.arange(len(some)), some] = False
                links[a + some] += hit @ weight[a + right]
                if pair:
                    links[a + right] += weight[a + some] @ hit
        linked = links > 0
        return pd.DataFrame({"rep": rep[linked], "links": links[linked]})

    on_workers(members.sparkSession)
    found = tiled.groupBy("bundle", "owner", "low", "high").applyInPandas(count, "rep long, links long")
    counted = cut(found.groupBy("rep").agg(F.sum("links").alias("links")))
    discard(members.sparkSession, folder)
    return counted


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    passes: int | None = None,
    window: int = WINDOW,
    exact: bool = False,
) -> DataFrame:
    """(key, n_links, component_id, kept), a row per vector.

    ``passes`` follows from the number of different vectors when it is None. ``exact`` also
    compares what no window showed.
    """
    own = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    good = F.coalesce(usable("x"), F.lit(False))
    # Copies are counted per vector before the shuffle; a class is named by a hash of its vector.
    own = own.withColumn("rep", F.when(good, F.xxhash64("x")))
    classes = own.where("rep is not null").groupBy("rep").agg(F.count("*").alias("weight"), F.min("key").alias("least"), F.first("x").alias("x"))
    classes, folder = stored(with_bytes(classes), "vectors")
    if passes is None:
        passes = passes_for(classes.count(), window, cosine)
    label = components(window_edges(sort_keys(classes, passes), window, cosine)).withColumnRenamed("node", "rep")
    # A vector that the windows left alone is a component of its own.
    members = classes.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    members, members_folder = stored(members, "members")
    discard(rows.sparkSession, folder)
    named = members.select("rep", "weight", "least", "component")
    if exact:
        links, joins = all_links(members.select("component", "rep", "weight", "v"), cosine)
        further = components(joins).select(F.col("node").alias("component"), F.col("component").alias("root"))
        named = named.join(further, "component", "left").withColumn("component", F.coalesce("root", "component"))
    else:
        links = links_within(members.select("component", "rep", "weight", "v"), cosine)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(least, "component").join(links, "rep", "left")
    found = found.select(
        "rep",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    found = cut(found)
    discard(rows.sparkSession, members_folder)
    named = own.select("key", "rep").join(found, "rep", "left")
    component = F.coalesce("component_id", "key")
    return named.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )


def with_bytes(classes: DataFrame) -> DataFrame:
    """The vector as bytes of doubles, which tasks read without copying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x.values.to_numpy(zero_copy_only=False).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(raw, pa.binary())], names=["rep", "weight", "least", "v"])

    kind = classes.schema["least"].dataType.simpleString()
    return map_arrow(classes.select("rep", "weight", "least", "x"), run, f"rep long, weight long, least {kind}, v binary")
