import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import lexical_search
from tripmill.llm.lexical_search import build_treap, descend, index, search, search_documents, term_hashes

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """Every document for every item, in Python's whole numbers."""
    held = [(n, key, Counter(terms(text))) for n, (key, text, *_) in enumerate(docs)]
    held = [(n, key, tf, sum(tf.values())) for n, key, tf in held if tf]
    total, words = len(held), sum(h[3] for h in held)
    df = Counter(term for _, _, tf, _ in held for term in tf)
    out = []
    for item, text in items:
        scored = []
        for n, key, tf, length in held:
            m = 100 - 90 + (90 * length * total) // words
            score = 0
            for term in set(terms(text)) & tf.keys():
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * tf[term]) // (1_000 * tf[term] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, n, key))
        out += [(item, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return ordered(out)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def texts(n, draw):
    """A few hundred words by falling frequency, hot and rare ones, some copies, some long texts."""
    words = [f"w{k}" if k % 7 else f"É{k}" for k in range(300)]
    rows = []
    for key in range(n):
        if key % 3 == 0 and key > 30:
            rows.append((key, rows[draw.randrange(10)][1]))
            continue
        size = 900 if key % 97 == 0 else draw.randrange(1, 40)
        rows.append((key, " ".join(words[min(int(draw.paretovariate(0.7)) - 1, 299)] for _ in range(size))))
    return rows


@pytest.mark.parametrize("shard_docs, block_items", [(7, 3), (4_096, 256)])
def test_equals_scoring_every_document(spark, shard_docs, block_items):
    draw = random.Random(2)
    docs = texts(1_200, draw)
    items = [(k, " ".join(f"W{draw.randrange(40)}" if j % 3 else f"é{7 * draw.randrange(40)} É{7 * j}" for j in range(k % 30))) for k in range(40)]
    shards = index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_docs=shard_docs)
    found = search(shards, spark.createDataFrame(items, "item_id long, text string"), block_items=block_items)
    assert ordered(found.select("item_id", "rank", "doc_id", "score").collect()) == brute(docs, items) != []


def test_hard_rows(spark, documents, hard_rows):
    docs = [*hard_rows, (30, "One\x7ftwo\x00three_four-5 日本 Straße STRASSE", "de"), (31, "\x00\x7f[]{}", "en"), (9, "lorem one", "en"), (10, "lorem one", "en")]
    items = [(1, "one"), (2, None), (3, ""), (3, "straße 日本 5 two"), (None, "lorem IPSUM lorem"), (4, "nowhere"), (1, "one"), (5, "éé"), (6, " \n")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as term", "2 as item", "'x' as block")
    found = search_documents(documents(*docs, clash=True), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(found.collect()) == brute(docs, items) != []
    assert search_documents(documents(*docs).limit(0), asked).collect() == [] == search_documents(documents(*docs), asked.limit(0)).collect()


@settings(deadline=None, max_examples=300)
@given(st.lists(st.text(alphabet="aZ9 é\x00\x7f_日[", max_size=20), max_size=5))
def test_terms_are_those_of_the_pattern(values):
    own, hashes = term_hashes(values)
    expected = [(k, term) for k, value in enumerate(values) for term in terms(value)]
    assert own.tolist() == [k for k, _ in expected]
    names = {}
    assert all(names.setdefault(term, h) == h for (_, term), h in zip(expected, hashes.tolist()))
    assert len(set(names.values())) == len(names)


def test_long_terms_differ_in_every_place():
    words = ["x" * k + c + "x" * (90 - k) for k in range(90) for c in "ab"] + ["x" * 91, "x" * 92]
    assert len(set(term_hashes([" ".join(words)])[1].tolist())) == len(words)


@settings(deadline=None, max_examples=200)
@given(st.integers(1, 40), st.integers(1, 70), st.integers(0, 10**6), st.integers(1, 5))
def test_descent_finds_the_best_columns(n_terms, columns, seed, top):
    draw = np.random.default_rng(seed)
    grid = draw.integers(1, 9, (n_terms, columns)) * (draw.random((n_terms, columns)) < 0.3)
    grid[:, 0] += 1  # every term has a posting
    row, docs = np.nonzero(grid)
    names = np.sort(draw.choice(10_000, n_terms, replace=False)).astype(np.uint64)
    treap = build_treap(names, (grid > 0).sum(axis=1), docs, grid[row, docs].astype(np.int64), columns)
    asked = draw.choice(n_terms, draw.integers(1, n_terms + 1), replace=False)
    weights = draw.integers(0, 5, len(asked))
    rows = treap.rows_of(names[asked])
    assert treap.rows_of(np.array([20_000], dtype=np.uint64)).tolist() == [-1]
    exact = weights @ grid[asked]
    found, scores = descend(treap, rows, weights, 1, top)
    assert (exact[found] == scores).all() and len(set(found.tolist())) == len(found)
    best = np.sort(exact[exact > 0])[::-1][:top]
    assert np.sort(scores)[::-1][:top].tolist() == best.tolist()
    if len(best) == top:  # every tie of the last place is there
        assert set(np.flatnonzero(exact >= best[-1])) == set(found.tolist())
    beyond = int(best[0]) + 1 if len(best) else 1
    assert len(descend(treap, rows, weights, beyond, top)[0]) == 0


def test_cells_hold_their_highest_impact():
    draw = np.random.default_rng(1)
    grid = draw.integers(1, 99, (13, 21)) * (draw.random((13, 21)) < 0.2)
    grid[:, 3] += 1
    row, docs = np.nonzero(grid)
    treap = build_treap(np.arange(13, dtype=np.uint64), (grid > 0).sum(axis=1), docs, grid[row, docs], 21)

    def cells(node, level, r, c):
        side = 1 << level
        inside = np.zeros((32, 32), dtype=np.int64)
        inside[treap.row, :21] = grid
        assert treap.highest[node] == inside[r : r + side, c : c + side].max() > 0
        if not level:
            return 1
        total = child = 0
        for q in range(4):
            r2, c2 = r + (q >> 1) * side // 2, c + (q & 1) * side // 2
            there = bool(treap.quadrants[node] >> q & 1)
            assert there == bool(inside[r2 : r2 + side // 2, c2 : c2 + side // 2].max())
            if there:
                total += cells(treap.child[node] + child, level - 1, r2, c2)
                child += 1
        return total

    assert cells(treap.root, treap.height, 0, 0) == (grid > 0).sum()


def test_a_good_item_leaves_most_ranges_unread(monkeypatch):
    """One document holds the whole item; rare terms are seen to be absent high up."""
    draw, read = np.random.default_rng(6), []
    grid = (draw.random((64, 4_096)) < 0.01).astype(np.int64) * 500
    grid[:, 77] = 900
    row, docs = np.nonzero(grid)
    treap = build_treap(np.arange(64, dtype=np.uint64), (grid > 0).sum(axis=1), docs, grid[row, docs], 4_096)
    plain = np.argpartition
    monkeypatch.setattr(lexical_search.np, "argpartition", lambda a, k: read.append(len(a)) or plain(a, k))
    found, _ = descend(treap, treap.rows_of(np.arange(30, dtype=np.uint64)), np.ones(30, dtype=np.int64), 1, 1)
    assert found.tolist() == [77] and len(read) < 4
