"""Quality classifier from weak labels.

Several heuristic labellers vote good, bad or nothing on every text. Expectation-maximisation over
the counts of their vote patterns, which cover all rows, estimates how far each can be trusted, and
gives every pattern a posterior. The posteriors label a sample on which a hashed linear scorer is
trained; the scorer then reads every whole text. No gold label is used.

There are at most 3 ** labellers patterns, so counts and posteriors are small for any input. The
sample has about SAMPLE rows, spread evenly by a hash; that is the only part that does not use all.

Defined results: a null text is an empty one; a text without words scores 0 and is not kept; repeated rows are scored row by row; an empty table gives no rows. Only the
columns given by ``keep`` and the results are returned.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import map_arrow, portions

NOTHING, GOOD, BAD = 0, 1, 2
DIMENSIONS = 4_096
SAMPLE = 3_000
# Range of the hash that samples: far beyond the rows of any table.
HASHES = 1 << 62
EM_ROUNDS = 200
STEPS = 300
RIDGE = 1e-4
KEEP_FROM = 0.5

# Frequent function words of the corpus' languages.
STOP_WORDS = frozenset(
    "the and of to in is that for it on with as was are this be by from at or an not have "
    "der die das und ist nicht ein eine den dem von zu mit sich auf für im auch als des "
    "le la les et de un une des est que en du dans pour qui au par ce sur avec "
    "el los las y en del que se por con para una es no al su como".split()
)
SYMBOLS = "#*$%&|<>"
ENDS = (".", "!", "?")


class Shape:
    """What the labellers look at, counted once."""

    def __init__(self, text: str) -> None:
        words = text.split()
        letters = sum(map(len, words))
        lines = [line for line in text.split("\n") if line.strip()]
        self.words = len(words)
        self.symbols = sum(map(text.count, SYMBOLS)) / max(len(words), 1)
        self.capitals = (letters and sum(1 for _ in re.finditer("[A-ZÀ-ÖØ-Þ]", text))) / max(letters, 1)
        self.shouts = text.count("!!") / max(len(words), 1)
        self.repeats = sum(a == b for a, b in pairwise(words)) / max(len(words) - 1, 1)
        self.distinct = len(set(words))
        self.copies = 1 - len(set(lines)) / max(len(lines), 1)
        self.lines = len(lines)
        self.stops = sum(map(STOP_WORDS.__contains__, map(str.lower, words))) / max(len(words), 1)
        self.ended = sum(line.rstrip().endswith(ENDS) for line in lines) / max(len(lines), 1)


def _bad(found: bool) -> int:
    return BAD if found else NOTHING


def _good(found: bool) -> int:
    return GOOD if found else NOTHING


# Each speaks for one class only: a defect that is absent is no sign of quality by itself, since
# junk of one kind lacks the defects of the others.
LABELLERS: dict[str, Callable[[Shape], int]] = {
    "symbols": lambda s: _bad(s.symbols > 0.4),
    "capitals": lambda s: _bad(s.capitals > 0.5),
    "shouts": lambda s: _bad(s.shouts > 0.3),
    "repeats": lambda s: _bad(s.repeats > 0.4),
    "variety": lambda s: _bad(s.words >= 20 and s.distinct < 0.2 * s.words ** 0.9),
    "copies": lambda s: _bad(s.copies > 0.4),
    "no_words": lambda s: _bad(s.words < 2),
    # Too few words say nothing against a text.
    "function_words": lambda s: _good(s.stops >= 0.06 or 2 <= s.words < 20),
    "sentences": lambda s: _good(s.ended >= 0.6),
    "length": lambda s: _good(s.words >= 40),
}


def pattern(shape: Shape) -> int:
    code = 0
    for vote in LABELLERS.values():
        code = code * 3 + vote(shape)
    return code


def votes_of(code: int) -> list[int]:
    votes = []
    for _ in LABELLERS:
        code, vote = divmod(code, 3)
        votes.append(vote)
    return votes[::-1]


def pattern_counts(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """Rows of each vote pattern, over the whole table; summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for value in batch.column(0).to_pylist():
                code = pattern(Shape(value or ""))
                seen[code] = seen.get(code, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])

    found = map_arrow(docs.select(F.col(f"`{text}`").alias("text")), run, "code long, n long")
    return {row["code"]: row["n"] for row in found.groupBy("code").agg(F.sum("n").alias("n")).collect()}


def expectation_maximisation(counts: dict[int, int], rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, dict[int, float]]:
    """Share of good rows, each labeller's vote probabilities by class, posterior of each pattern.

    Votes are taken as independent given the class, abstention included. The start believes every
    vote against a text, which also fixes which class is the good one.
    """
    codes = sorted(counts)
    if not codes:
        return 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3), {}
    votes = np.array([votes_of(code) for code in codes])
    weight = np.array([counts[code] for code in codes], dtype=float)
    good = np.where((votes == BAD).any(axis=1), 0.05, 0.95)
    onehot = votes[:, :, None] == np.arange(3)
    for _ in range(rounds):
        both = np.stack([weight * (1 - good), weight * good])
        share = (both[1].sum() + 1) / (weight.sum() + 2)
        tallies = np.einsum("cp,plv->lcv", both, onehot) + 0.5
        chances = tallies / tallies.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,lcv->pc", onehot, np.log(chances)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return float(share), chances, dict(zip(codes, good.tolist()))


def features(text: str, shape: Shape) -> np.ndarray:
    """Hashed byte 1-, 2- and 3-grams of the whole text, and a few places for its shape."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    spread = np.uint32(0x9E3779B1)
    if len(data):
        total += np.bincount(data, minlength=DIMENSIONS)
    for n in (2, 3):
        if len(data) >= n:
            grams = data[: len(data) - n + 1]
            for k in range(1, n):
                grams = grams * np.uint32(257) + data[k : len(data) - n + 1 + k]
            grams = grams * spread
            total += np.bincount(grams >> np.uint32(32 - 12), minlength=DIMENSIONS)
    found = np.log1p(total.astype(np.float32))
    norm = np.linalg.norm(found)
    found = found / norm if norm else found
    own = (shape.symbols, shape.capitals, shape.shouts, shape.repeats, shape.copies, 1 - shape.stops, 1 - shape.ended, 1 / (1 + shape.words))
    return np.concatenate([found, np.clip(np.array(own, dtype=np.float32), 0, 1), np.ones(1, dtype=np.float32)])


def train(x: np.ndarray, target: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression on soft labels, both classes weighing the same; accelerated gradient."""
    if not len(x):
        return np.zeros(x.shape[1], dtype=np.float32)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    weight = (target / share + (1 - target) / (1 - share)) / (2 * len(x))
    step = 1 / (0.25 * float((weight * (x * x).sum(axis=1)).sum()) + ridge)
    w = last = np.zeros(x.shape[1], dtype=np.float64)
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - last)
        error = 1 / (1 + np.exp(-np.clip(x @ ahead, -50, 50))) - target
        last, w = w, ahead - step * (x.T @ (weight * error) + ridge * ahead)
    return w.astype(np.float32)


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict:
    """Posteriors of all vote patterns, labellers' chances, and the scorer's weights."""
    counts = pattern_counts(docs, text)
    share, chances, posterior = expectation_maximisation(counts)
    rows = sum(counts.values())
    part = min(1.0, sample / max(rows, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v or "" for v in batch.column(0).to_pylist()]
            for some in portions(texts, rows=256):
                shapes = [Shape(t) for t in texts[some]]
                found = [features(t, s).tobytes() for t, s in zip(texts[some], shapes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([posterior[pattern(s)] for s in shapes], pa.float64()), pa.array(found, pa.binary())], names=["good", "x"]
                )

    numbered = docs.select(F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"))
    chosen = numbered.where(F.pmod(F.xxhash64("row"), F.lit(HASHES)) < max(1, int(part * HASHES))).select("text")
    found = sorted((bytes(r["x"]), r["good"]) for r in map_arrow(chosen, run, "good double, x binary").collect())
    x = np.array([np.frombuffer(f[0], dtype=np.float32) for f in found]).reshape(len(found), len(features("", Shape(""))))
    return {"posterior": posterior, "chances": chances, "share": share, "weights": train(x, np.array([f[1] for f in found]))}


def score(docs: DataFrame, model: dict, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and votes, posterior, score, kept; one narrow stage over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # patterns and weights, both of bounded number
    keep = [c for c in keep if c not in ("votes", "posterior", "score", "kept")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            codes, scores = [], []
            for value in batch.column(0).to_pylist():
                value = value or ""
                shape = Shape(value)
                codes.append(pattern(shape))
                linear = float(features(value, shape) @ own["weights"])
                scores.append(1 / (1 + np.exp(-min(max(linear, -50.0), 50.0))) if shape.words else 0.0)
            posterior = [own["posterior"].get(code, own["share"]) for code in codes]
            kept = [s >= KEEP_FROM for s in scores]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(codes, pa.int64()), pa.array(posterior, pa.float64()), pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())],
                names=[*(f"k{i}" for i in range(len(keep))), "votes", "posterior", "score", "kept"],
            )

    schema = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    chosen = docs.select(F.col(f"`{text}`").alias("text"), *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)))
    found = map_arrow(chosen, run, schema + "votes long, posterior double, score double, kept boolean")
    return found.toDF(*keep, "votes", "posterior", "score", "kept")
