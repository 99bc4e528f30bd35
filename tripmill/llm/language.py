"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter n-grams. Every language has several centroids
from spherical clustering; a text gets the language of the nearest by cosine, and is rejected when it
is farther away than nearly all learned texts of its length are from theirs. Few words have few of
their language's n-grams, so a short text's cosine is low in any language, and the radius is learned
by length. Texts of under about ten words are hardly ever rejected for it.

Document frequencies cover all learning rows. Only the clustering uses a sample, about SAMPLE rows
of each language, spread evenly by a hash; a group of one language has about that many rows at any
input size. The model, CLUSTERS vectors a language, is all that reaches the driver.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; rows
whose language is null or id is held out are never learned from; repeated rows are predicted row by
row; with nothing to learn from, every row is ``und``; an empty table gives no rows. Only the
columns given by ``keep`` are returned besides the results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import map_arrow, on_workers, portions, whole_text

DIMENSIONS = 4_096
CLUSTERS = 3
SAMPLE = 600
# Range of the hash that samples: far beyond the rows of any language.
HASHES = 1 << 62
ROUNDS = 12
# A text is rejected when its cosine is below this share of a low quantile of the sample's, of texts
# of about its length. One junk row in a hundred does not move the quantile of all languages; the
# language's own quantile only lowers it.
SLACK = 0.65
QUANTILE = 0.01
OWN_QUANTILE = 0.05
LENGTHS = 40  # length classes; a class spans a doubling of the n-grams
FEWEST = 20  # sample rows that a class needs for a quantile of its own
UNKNOWN = "und"
CHUNK = 1_000_000
GRAMS = np.array([[0x9E3779B1, 0, 0], [0x85EBCA6B, 0xC2B2AE35, 0], [0x27D4EB2F, 0x165667B1, 0x9E3779B9]], dtype=np.uint32)
BLANK = np.uint32(32)

# Latin letters of the ASCII range in small form; everything else there is a blank.
FOLD = np.full(128, 32, dtype=np.uint32)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed 1-, 2- and 3-gram counts of the whole text; chunks overlap, so nothing is lost."""
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for start in range(0, len(text), CHUNK):
        part = text[max(0, start - 2) : start + CHUNK].lower().encode("utf-32-le", "replace")
        points = np.frombuffer(part, dtype=np.uint32)
        letters = np.where(points < 128, FOLD[np.minimum(points, 127)], points)
        for n, mix in enumerate(GRAMS, start=1):
            if len(letters) < n:
                continue
            grams = sum(letters[k : len(letters) - n + 1 + k] * mix[k] for k in range(n))
            grams ^= grams >> np.uint32(15)
            middle = letters[n // 2 : len(letters) - n + 1 + n // 2]
            overlap = 0 if start == 0 else max(0, min(2, start) - (n - 1))
            keep = middle[overlap:] != BLANK
            total += np.bincount(grams[overlap:][keep] % np.uint32(DIMENSIONS), minlength=DIMENSIONS)
    return total


def vectors(texts: Sequence[str], idf: np.ndarray) -> np.ndarray:
    """Rows of unit length, or zero where nothing was counted."""
    return sized_vectors(texts, idf)[0]


def sized_vectors(texts: Sequence[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors, and the length class of every text."""
    found, size = np.empty((len(texts), DIMENSIONS), dtype=np.float32), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        own = counts(text)
        found[i], size[i] = own, min(int(own.sum()).bit_length(), LENGTHS - 1)
    np.log1p(found, out=found)
    found *= idf
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    return np.divide(found, norm, out=np.zeros_like(found), where=norm > 0), size


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the id as text divisible by 5; a null id counts as an empty text, so it is held out."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and in how many of them each dimension occurs. Every task sends one row of totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += counts(text) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([seen], pa.list_(pa.int64()))], names=["n", "seen"])

    parts = map_arrow(docs.select("text"), run, "n long, seen array<long>")
    sums = parts.select(F.posexplode("seen").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    totals = {row["at"]: row["n"] for row in sums.union(parts.select(F.lit(-1), F.sum("n"))).collect()}
    return int(totals.pop(-1, 0) or 0), np.array([totals.get(k, 0) or 0 for k in range(DIMENSIONS)], dtype=np.int64)


def cluster(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first centres: centroids and each row's cosine to its own."""
    centres = [points.mean(axis=0)]
    while len(centres) < min(k, len(points)):
        nearest = np.max(points @ np.array(centres).T, axis=1)
        # A first centre in the bulk, not at an outlier: the row at a fixed low rank of closeness.
        centres.append(points[np.argsort(nearest, kind="stable")[len(points) // 4]])
    found = np.array(centres, dtype=np.float32)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        own = np.argmax(points @ found.T, axis=1)
        found = np.array([points[own == c].mean(axis=0) if (own == c).any() else found[c] for c in range(len(found))])
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    cosines = points @ found.T
    return found, cosines.max(axis=1)


def low_cosines(size: np.ndarray, cosines: np.ndarray, quantile: float) -> np.ndarray:
    """The quantile of every length class. A class of few rows borrows: from the next longer one that
    has enough, less by the root of the length, as cosines fall about so; beyond the longest, from that.
    """
    groups = [cosines[size == k] for k in range(LENGTHS)]
    known = [k for k, x in enumerate(groups) if len(x) >= FEWEST]
    if not known:
        all_of_them = np.quantile(cosines, quantile) if len(cosines) else 0.0
        middle = int(np.median(size)) if len(size) else 0
        return np.array([all_of_them * 0.5 ** (max(0, middle - k) / 2) for k in range(LENGTHS)])
    low = np.zeros(LENGTHS)
    for k in reversed(range(LENGTHS)):
        if k in known:
            low[k] = np.quantile(groups[k], quantile)
        else:
            low[k] = low[k + 1] * 0.5**0.5 if k < known[-1] else np.quantile(groups[known[-1]], quantile)
    return low


def sample_limit(n: int) -> int:
    """Hashes below this, of HASHES, choose about SAMPLE of ``n`` rows; never none."""
    return max(1, min(HASHES, SAMPLE * HASHES // n))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict:
    """The model: document frequencies as weights, and each language's centroids and radii."""
    learn = docs.where(~held_out(key)).select(
        F.col(f"`{lang}`").alias("lang"), whole_text(F.col(f"`{text}`")).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    learn = learn.where("lang is not null and text rlike '\\\\p{L}'")
    rows, seen = frequencies(learn)
    idf = np.log((1 + rows) / (1 + seen)).astype(np.float32) + 1
    # One number per language goes into the plan itself, so no text is shuffled to be sampled.
    sizes = {row["lang"]: row["n"] for row in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    limits = [F.lit(x) for name, n in sizes.items() for x in (name, sample_limit(n))]
    limit = F.create_map(*limits)[F.col("lang")] if limits else F.lit(0)
    chosen = learn.where(F.pmod(F.xxhash64("row"), F.lit(HASHES)) < limit)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in portions(texts, rows=256):
                found, size = sized_vectors(texts[part], idf)
                langs = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([langs, pa.array([v.tobytes() for v in found], pa.binary()), pa.array(size)], names=["lang", "v", "size"])

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["v", "size"])
        points = np.frombuffer(b"".join(group["v"]), dtype=np.float32).reshape(-1, DIMENSIONS)
        found, cosines = cluster(points, CLUSTERS)
        # The sample's sizes and cosines, about SAMPLE numbers, go along with the first centroid.
        more = [([], [])] * (len(found) - 1)
        sizes, near = zip((group["size"].tolist(), cosines.astype(float).tolist()), *more)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "v": [v.astype(np.float32).tobytes() for v in found], "sizes": sizes, "cosines": near})

    on_workers(docs.sparkSession)
    embedded = map_arrow(chosen.select("lang", "text"), embed, "lang string, v binary, size long")
    model = embedded.groupBy("lang").applyInPandas(centroids, "lang string, v binary, sizes array<long>, cosines array<double>")
    found = sorted(((r["lang"], bytes(r["v"]), r["sizes"], r["cosines"]) for r in model.collect()))
    missing = sorted(sizes.keys() - {f[0] for f in found})
    if missing:
        raise RuntimeError(f"no centroid for {', '.join(missing)}")
    return {
        "idf": idf,
        "langs": [f[0] for f in found],
        "centroids": np.array([np.frombuffer(f[1], dtype=np.float32) for f in found]).reshape(-1, DIMENSIONS),
        "floor": SLACK * floors(found),
    }


def floors(found: list[tuple]) -> np.ndarray:
    """For every centroid and length class, the low cosine of all languages or of its own if lower."""
    samples = {lang: (np.array(sizes), np.array(cosines)) for lang, _, sizes, cosines in found if len(sizes)}
    if not samples:
        return np.zeros((len(found), LENGTHS))
    every = low_cosines(*(np.concatenate(part) for part in zip(*samples.values())), QUANTILE)
    own = {lang: low_cosines(*sample, OWN_QUANTILE) for lang, sample in samples.items()}
    return np.maximum(np.array([np.minimum(every, own[f[0]]) for f in found]), 0.0)


def predict(docs: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and lang_pred, score, rejected, from nothing but the text. One narrow stage."""
    # About DIMENSIONS * 4 bytes for each centroid: its size depends on languages, not on rows.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in keep if c not in ("lang_pred", "score", "rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        langs = [*own["langs"], UNKNOWN]
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for part in portions(texts, rows=256):
                some = texts[part]
                best = np.full(len(some), len(langs) - 1)
                score, rejected = np.zeros(len(some)), np.ones(len(some), dtype=bool)
                if len(langs) > 1:
                    found, size = sized_vectors(some, own["idf"])
                    cosines = found @ own["centroids"].T
                    near = np.argmax(cosines, axis=1)
                    lettered = np.array([has_letter(t) for t in some])
                    best = np.where(lettered, near, best)
                    score = np.where(lettered, np.clip(cosines[np.arange(len(some)), near].astype(float), 0, 1), 0.0)
                    rejected = ~lettered | (score < own["floor"][near, size])
                kept = [batch.column(1 + i).slice(part.start, part.stop - part.start) for i in range(len(keep))]
                results = [pa.array([langs[k] for k in best], pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*kept, *results], names=[*(f"k{i}" for i in range(len(keep))), "lang_pred", "score", "rejected"])

    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = "".join(f"k{i} {kind}, " for i, kind in enumerate(kinds)) + "lang_pred string, score double, rejected boolean"
    chosen = docs.select(F.col(f"`{text}`").alias("text"), *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)))
    return map_arrow(chosen, run, schema).toDF(*keep, "lang_pred", "score", "rejected")
