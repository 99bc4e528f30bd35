import numpy as np
import pytest

from tripmill.llm import vector_dedup


def brute(rows, cosine=0.95):
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in good:
        for j in good:
            a, b = rows[i][1], rows[j][1]
            if i != j and len(a) == len(b):
                a, b = np.array(a, dtype=float), np.array(b, dtype=float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[i] += 1
                    parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(key, least.get(root(i), key))
    return [(key, links[i], least[root(i)], least[root(i)] == key) for i, (key, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def found(df):
    return sorted(tuple(r) for r in vector_dedup.near_duplicates(df).collect())


@pytest.mark.parametrize("tile", [2_048, 7])
def test_links_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    rng = np.random.default_rng(5)
    rows = []
    for size in (1, 1, 2, 3, 60, 5, 1, 40):
        centre = rng.standard_normal(16)
        rows += [(len(rows) + k, (centre + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(size)]
    rows += [(len(rows) + k, rows[3][1]) for k in range(9)]  # exact copies
    assert found(frame(spark, rows)) == sorted(brute(rows))


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
        (9, [-1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e-30, 0.0]), (12, [3e38, 3e38]), (13, [1.0, 1.0]), (14, [1.0, -0.0]),
    ]
    assert found(frame(spark, rows)) == sorted(brute(rows))


def test_no_rows_and_clashing_columns(spark):
    assert found(frame(spark, []).limit(0)) == []
    df = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.01])]).selectExpr("*", "1 as weight", "2 as rep", "'x' as component")
    assert found(df) == [(1, 1, 1, True), (2, 1, 1, False)]


@pytest.mark.parametrize("tile", [2_048, 5])
def test_links_that_no_window_shows(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    rng = np.random.default_rng(9)
    units = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    topic = units(rng.standard_normal(32))
    many = np.concatenate([rng.standard_normal((200, 32)), 2 * topic + 0.18 * rng.standard_normal((200, 32)), -5 * topic + 0.1 * rng.standard_normal((50, 32))])
    many = units(many)
    across = rng.standard_normal((60, 32))
    across = units(across - np.sum(across * many[:60], axis=1, keepdims=True) * many[:60])
    pairs = 0.955 * many[:60] + np.sqrt(1 - 0.955**2) * across  # single pairs just over the limit
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(np.concatenate([many, pairs]))]
    rows += [(len(rows) + k, [1.0, 0.1 * k]) for k in range(5)]
    result = vector_dedup.near_duplicates(frame(spark, rows), passes=1, window=1, exact=True)
    assert sorted(tuple(r) for r in result.collect()) == sorted(brute(rows))


def planted(rng, many, share):
    """``many`` vectors, each ``share``-th with a partner of its own at a cosine just over the limit."""
    some = many[:: share]
    across = rng.standard_normal(some.shape)
    across -= np.sum(across * some, axis=1, keepdims=True) * some
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    return np.concatenate([many, 0.951 * some + np.sqrt(1 - 0.951**2) * across])


@pytest.mark.parametrize("kind", ["spread", "hot topic"])
def test_recall_of_thousands_of_vectors(spark, kind):
    """Queries are the vectors of ids divisible by 20, each with a partner, against all rows."""
    rng = np.random.default_rng(3)
    many = rng.standard_normal((12_000, 64))
    if kind == "hot topic":  # a third at mutual cosines of 0.8
        many[::3] = 2 * np.sqrt(64) * rng.standard_normal(64) / 8 + rng.standard_normal((4_000, 64))
    many /= np.linalg.norm(many, axis=1, keepdims=True)
    all_rows = planted(rng, many, 20)
    result = vector_dedup.near_duplicates(frame(spark, [(k, v.astype(np.float32).tolist()) for k, v in enumerate(all_rows)]))
    links = {r.vec_id: r.n_links for r in result.collect()}
    unit = all_rows.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    asked = np.arange(0, 12_000, 20)
    truth = (unit[asked] @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([links[k] for k in asked])
    assert len(links) == len(all_rows) and truth.sum() >= 600
    assert (got <= truth).all() and got.sum() >= 0.95 * truth.sum()


def test_large_group_has_whole_counts(spark, monkeypatch):
    """A group of many windows and chunks: every link is counted, though windows show few of them."""
    monkeypatch.setattr(vector_dedup, "TILE", 16)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(k, (centre + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(700)]
    rows += [(700 + k, rng.standard_normal(16).astype(np.float32).tolist()) for k in range(300)]
    result = vector_dedup.near_duplicates(frame(spark, rows), window=20)
    assert sorted(tuple(r) for r in result.collect()) == sorted(brute(rows))
