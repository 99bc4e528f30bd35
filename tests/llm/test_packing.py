import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import packing


def padded(lengths, counts, bounds):
    total, low = 0, -1
    for upper in bounds:
        total += upper * sum(c for x, c in zip(lengths, counts) if low < x <= upper)
        low = upper
    return total


@settings(deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_bounds_pad_the_least(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[x] for x in lengths]
    found = packing.optimal_bounds(np.array(lengths), np.array(counts), buckets)
    best = min(
        padded(lengths, counts, [*some, lengths[-1]])
        for k in range(min(buckets, len(lengths)))
        for some in itertools.combinations(lengths[:-1], k)
    )
    assert len(found) <= buckets and found == sorted(set(found)) and padded(lengths, counts, found) == best


@settings(deadline=None, max_examples=30)
@given(st.dictionaries(st.integers(500, 90_000), st.integers(1, 10**6), min_size=1, max_size=40), st.integers(1, 6))
def test_long_lengths_pad_the_least_too(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[x] for x in lengths]
    best = {0: 0}  # shortest lengths that are dealt with: least cost, a bucket more each round
    least = None
    for _ in range(min(buckets, len(lengths))):
        best = {
            j: min(c + lengths[j - 1] * sum(counts[i:j]) for i, c in best.items() if i < j)
            for j in range(1, len(lengths) + 1)
            if any(i < j for i in best)
        }
        last = best.get(len(lengths))
        least = last if least is None or (last is not None and last < least) else least
    found = packing.optimal_bounds(np.array(lengths), np.array(counts), buckets)
    assert padded(lengths, counts, found) == least


def test_lengths_above_any_power_of_two_have_buckets_of_their_own(spark):
    rows = spark.createDataFrame([(512,)] * 1_000 + [(513,), (2_000,)], "length long")
    assert [p[0] for p in packing.plan_buckets(rows, buckets=3)] == [512, 513, 2_000]


def test_many_lengths_are_planned_quickly():
    lengths = np.arange(1, 60_001)
    found = packing.optimal_bounds(lengths, 1 + lengths[::-1] % 97, 12)
    assert len(found) == 12 and found[-1] == 60_000


@pytest.fixture
def packed(documents, hard_rows):
    rows = [*hard_rows, *((100 + i, "w " * (i % 300)) for i in range(900))]
    return rows, packing.pack(documents(*rows, clash=True), buckets=5, budget=1_000).collect()


def test_batches_keep_the_budget_and_every_row(packed):
    rows, found = packed
    assert len(found) == len(rows)
    batches = {}
    for r in found:
        assert r.length == len((r.text or "").split()) and r.length <= r.bucket_length
        batches.setdefault(r.batch, []).append(r)
    for members in batches.values():
        assert len({m.bucket for m in members}) == 1
        assert sorted(m.slot for m in members) == list(range(len(members)))
        assert len(members) * members[0].bucket_length <= 1_000 or len(members) == 1
    assert {r.doc_id for r in found if r.over_budget} == {6, 7}


def test_a_hot_bucket_is_dealt_to_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    found = packing.pack(documents(*((1, "same text here") for _ in range(400))), budget=30).collect()
    sizes = {}
    for r in found:
        sizes[r.batch] = sizes.get(r.batch, 0) + 1
    assert len({b.split("-")[1] for b in sizes}) > 4 and max(sizes.values()) == 10 and sum(sizes.values()) == 400


def test_empty_table(documents):
    assert packing.pack(documents((1, "a")).limit(0)).count() == 0
