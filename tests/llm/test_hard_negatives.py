import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm.hard_negatives import Best, Rows, Scores, find_negatives, find_positives, mine, tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    """All pairs with whole numbers."""
    good = []
    for n, (key, vector, label) in enumerate(rows):
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((n, key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    last = lambda key: (key is None, key or 0)
    out = []
    for n, key, vector, label in good:
        if key is None or key % 100:
            continue
        scored = [(sum(a * b for a, b in zip(vector, w)), k, m, own) for m, k, w, own in good if m != n and len(w) == len(vector)]
        scored.sort(key=lambda s: (-s[0], last(s[1]), s[2]))
        for p in [s for s in scored if s[3] == label][:positives]:
            window = [s for s in scored if s[3] != label and 80 * p[0] <= 100 * s[0] <= 100 * p[0]]
            out += [(key, p[1], rank, s[1], p[0], s[0]) for rank, s in enumerate(window[:negatives], 1)]
    return out


def mined(df, **options):
    return [tuple(r) for r in mine(df, **options).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def topics(n, width, draw, spread, unit=True):
    """Vectors around a few directions; a third of all around one."""
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for key in range(n):
        topic = 0 if key % 3 == 0 else draw.randrange(6)
        v = [c + draw.gauss(0, spread) for c in centres[topic]]
        size = math.sqrt(sum(x * x for x in v)) if unit else 1.0
        rows.append((key, [float(np.float32(x / size)) for x in v], (topic + (draw.random() < 0.3)) % 4))
    return rows


@pytest.mark.parametrize("spread, options", [(0.1, {}), (0.6, {"chunk_rows": 97, "block_rows": 5}), (3.0, {"chunk_rows": 200, "block_rows": 1})])
def test_equals_all_pairs(spark, spread, options):
    rows = topics(1_500, 12, random.Random(8), spread)
    rows += [(1_500 + i, rows[i][1], rows[i][2]) for i in range(60)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ordered(mined(df, **options)) == ordered(brute(rows)) != []


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [], 1), (200, [], 2), (300, [], 1), (400, [1.0, 2.0, 3.0], 1), (1, None, 1), (2, [nan, 1.0], 1),
        (3, [1.0, inf], 2), (4, [1.0, None], 2), (5, [0.9, 1.9], None), (6, [0.9, 1.9], 2), (7, [0.95, 1.9], 3), (None, [0.9, 1.9], 2), (None, [1.0, 2.0], 1),
        (None, None, None), (8, [-1.0, -2.0], 1), (500, [0.0, 0.0], 1), (600, [-3.0, 0.5], 9), (9, [-2.0, 0.1], 9), (10, [-1.5, 0.1], 8),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "'x' as block", "2 as row", "3 as id")
    out = mine(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert ordered(tuple(r) for r in out.collect()) == ordered(brute(rows)) != []
    assert mine(df.limit(0)).collect() == [] == mine(df.where("vec_id % 100 <> 0")).collect()


def test_scores_beyond_doubles_are_exact_and_beyond_longs_raise(spark):
    big = float(2**22) + 8.0
    rows = [(0, [big, 1.0], 1), (1, [big, 0.5], 1), (2, [big - 8.0, 0.5], 2), (3, [big, 0.25], 2), (4, [big - 16.0, 3.0], 2)]
    assert ordered(mined(spark.createDataFrame(rows, SCHEMA))) == ordered(brute(rows)) != []
    rows = [(k, [3e38, 1.0], k % 2) for k in range(5)]
    with pytest.raises(Exception):
        mined(spark.createDataFrame(rows, SCHEMA))


def test_labels_and_anchors_of_the_caller(spark):
    rows = topics(200, 4, random.Random(1), 0.4)
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "topic")
    found = mine(df, label=F.col("topic") % 2, anchor=F.col("id") == 7, positives=2, negatives=1).collect()
    assert {r.anchor_id for r in found} == {7} and len({r.positive_id for r in found}) <= 2 and {r["rank"] for r in found} == {1}


def chunk_of(vectors, labels=None, first=0):
    n = len(vectors)
    at = np.arange(first, first + n)
    return Rows(at, at, np.zeros(n, bool), np.array([1] * n if labels is None else labels), np.array(vectors, dtype=np.float64))


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 14), st.integers(1, 5), st.integers(0, 10**6))
def test_tree_is_least_and_orders_parents_first(n, width, seed):
    vectors = np.random.default_rng(seed).integers(-9, 9, (n, width)).astype(float)
    order, parent, length = tree(vectors)
    gaps = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(axis=2))
    assert sorted(order.tolist()) == list(range(n)) and (parent < 0).sum() == 1
    place = {node: k for k, node in enumerate(order.tolist())}
    assert all(place[parent[v]] < place[v] and length[v] == gaps[v, parent[v]] for v in range(n) if parent[v] >= 0)
    joined, total, group = 0, 0.0, list(range(n))
    for gap, a, b in sorted((gaps[a, b], a, b) for a in range(n) for b in range(a)):
        if group[a] != group[b]:
            total, joined = total + gap, joined + 1
            group = [group[a] if g == group[b] else g for g in group]
    assert math.isclose(total, length.sum(), abs_tol=1e-9)


def test_bounds_hold_and_spare_work():
    """Every interval holds the true score; near anchors spare most of the products."""
    draw = np.random.default_rng(4)
    centres = draw.integers(-200, 200, (8, 16)).astype(float)
    anchors = chunk_of(centres[np.arange(64) % 8] + draw.integers(-3, 4, (64, 16)), first=10_000)
    chunk = chunk_of(centres[np.arange(2_000) % 8] + draw.integers(-9, 10, (2_000, 16)), labels=np.arange(2_000) % 5)
    order, parent, length = tree(anchors.vectors)
    scores = Scores(anchors, order, parent, length, chunk)
    for anchor, low, high in scores.walk():
        exact = chunk.vectors @ anchors.vectors[anchor]
        assert (low <= exact).all() and (exact <= high).all()
        if parent[anchor] < 0:
            low[:] = high[:] = exact
    spared = Scores(anchors, order, parent, length, chunk)
    kept = Best(5)
    find_positives(spared, kept, 5)
    same = np.flatnonzero(chunk.label == 1)
    for k in range(64):
        exact = sorted(((-int(chunk.vectors[p] @ anchors.vectors[k]), False, int(p), int(p)) for p in same))[:5]
        assert kept.held[k, 0] == exact
    assert spared.scored < 0.5 * 64 * len(same)
    windows = [[(slot, -kept.held[k, 0][slot][0]) for slot in range(5)] for k in range(64)]
    spared = Scores(anchors, order, parent, length, chunk)
    find_negatives(spared, Best(5), windows)
    assert spared.scored < 0.7 * 64 * (chunk.label != 1).sum()


def test_few_intervals_are_held_at_a_time():
    """A comb: a long spine with a tooth at every node."""
    vectors = np.array([(10.0 * k, 0.0) for k in range(200)] + [(10.0 * k, 1.0) for k in range(200)])
    order, parent, length = tree(vectors)
    children = np.bincount(parent[parent >= 0], minlength=400)
    left, most = {}, 0
    for node in order.tolist():
        if parent[node] >= 0:
            left[parent[node]] -= 1
        if children[node]:
            left[node] = children[node]
        most = max(most, sum(n > 0 for n in left.values()))
    assert most <= 3
