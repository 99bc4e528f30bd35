import random
import re

import numpy as np
import pytest

from tripmill.llm import jaccard
from tripmill.llm.components import components
from tripmill.llm.shingles import shingle_set, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute(rows, n=4, percent=85):
    """(n_shingles, smallest id reachable) per place of a row; ids are distinct or null."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(len(s), least.get(root(i), key) if s else key) for i, (s, (key, _)) in enumerate(zip(sets, rows))]


def corpus(seed=0):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3_000)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 9, 30, 70, 130, 260]))]
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 4])):
            near = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append(" ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
        if rng.random() < 0.5:
            rows.append(passage + " " + " ".join(rng.choice(words) for _ in range(8)))
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force(documents, seed):
    rows = corpus(seed)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(documents(*rows, clash=True)).collect()}
    expected = brute(rows)
    assert len({c for _, c in expected}) < len(rows) - 20
    assert [found[i] for i in range(len(rows))] == expected


def test_hard_rows(documents, hard_rows):
    rows = [r[:2] for r in hard_rows if r[0] != 5] + [(50, "a b c d e f g h i j k l"), (51, " ")]
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard.similar_documents(documents(*rows)).collect())
    expected = sorted((k or 0, n, c or 0) for (k, _), (n, c) in zip(rows, brute(rows)))
    assert found == expected


def test_one_of_each_group_stays(documents, hard_rows):
    rows = [*hard_rows, (20, "a b c d e f g h i j k l"), (21, "A b c d e f g h i j k l")]
    docs = documents(*rows, clash=True)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    expected = {t: 1 for _, t, *_ in rows if (t or "").strip() and not t.startswith(("lorem", "A b"))}
    assert {t: texts.count(t) for t in expected} == expected
    assert sum((t or "").startswith("lorem") for t in texts) == 2  # 5 of 6 shingles in common
    assert sum(not (t or "").strip() for t in texts) == 4
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_groups_without_ids_keep_one_row(documents):
    same, near = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "A b c d e f g h i j k l m n o p q r s t u v w x y z é"
    docs = documents((None, same), (None, same), (None, near), (5, "other words of a text that stands alone"), (None, "5"), (5, None))
    texts = [r.text for r in jaccard.one_of_each(docs).collect()]
    assert sum(t in (same, near) for t in texts) == 1 and sorted(t or "" for t in texts if t not in (same, near)) == ["", "5", "other words of a text that stands alone"]
    rows = [(None, same), (9, near), (7, same)]
    assert [r.doc_id for r in jaccard.one_of_each(documents(*rows)).collect()] == [7]


def test_rows_of_swapped_nulls_differ(documents):
    from tripmill.llm.shared import row_hash

    rows = documents((None, "5"), (5, None), (None, None)).select(row_hash("doc_id", "text").alias("h")).collect()
    assert len({r.h for r in rows}) == 3


def test_shingle_hashes_follow_words():
    a = "Ab  cd\tef\x0bgh é" + "x" * 200
    assert len(word_hashes(a)) == 5 and (word_hashes(a) == word_hashes("ab cd ef gh é" + "x" * 200)).all()
    assert len(set(word_hashes(" ".join(f"{'y' * i}" for i in range(1, 300))).tolist())) == 299
    assert len(shingle_set("a b c", 4)) == 1 and len(shingle_set("a b c d a b c d a", 4)) == 4 and len(shingle_set(" ", 4)) == 0


def test_bounds_never_hide_a_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 2**63, int(rng.integers(0, 9)), dtype=np.uint64)]))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        differ = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(jaccard.signature(a), jaccard.signature(b)))
        assert 185 * (len(a) + len(b) - differ) >= 2 * 85 * (len(a) + len(b))
        order = rng.integers(0, 5, jaccard.CELLS)
        first = [set(jaccard.first_shingles(x, order, 85).tolist()) for x in (a, b)]
        assert first[0] & first[1] and set(jaccard.bands(len(a), 85)) & set(jaccard.bands(len(b), 85))


@pytest.mark.parametrize("edges, expected", [
    ([], {}), ([(1, 1)], {}), ([(2, 1), (3, 2), (9, 8)], {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}), ([(0, i) for i in range(1, 30)], {i: 0 for i in range(30)}),
    ([(i, 100 - i) for i in range(50)] + [(i, i + 2) for i in range(0, 98, 2)], None),
])
def test_components(spark, edges, expected):
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    if expected is None:
        parent = {}
        root = lambda x: x if parent.get(x, x) == x else root(parent[x])
        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        expected = {x: root(x) for e in edges for x in e}
    assert found == expected


def test_filters_agree_in_spark_and_in_tasks(spark):
    names = [0, 1, -1, 2**63 - 1, -(2**63), *(k << 33 | 5 for k in range(200)), *range(50)]
    bits = jaccard.name_filter(spark.createDataFrame([(n,) for n in names], "x long"), "x")
    assert jaccard.may_be_named(bits, np.array(names, dtype=np.int64)).all()
    others = np.array([k << 33 | 70 for k in range(200)], dtype=np.int64)
    assert jaccard.may_be_named(bits, others).mean() < 0.05


def windows(n):
    """Passages of one text that begin at different words, each with a word of its own."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    return [(i, " ".join([*base[s : s + 120], f"own{i}"])) for i, s in ((i, rng.randrange(40)) for i in range(n))]


def test_comparisons_do_not_grow_with_the_square_of_a_group(documents, monkeypatch):
    own, compared = jaccard.linked, {}
    for n in (40, 160):
        counts = compared[n] = []
        monkeypatch.setattr(jaccard, "linked", lambda pairs, *rest: counts.append(pairs.count()) or own(pairs, *rest))
        found = {r.doc_id: r.component_id for r in jaccard.similar_documents(documents(*windows(n))).collect()}
        assert [found[i] for i in range(n)] == [c for _, c in brute(windows(n))]
    assert sum(compared[160]) < 8 * sum(compared[40])


def test_tiles_of_two_sets_are_done_after_a_round(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "tile_pairs", lambda *_: pytest.fail("no tile is left"))
    rows = [(i, f"the same few words {' '.join(f'w{i}x{k}' for k in range(9))}" if i < 2 else f"a b c d e f g h i j k l {'x' * (i % 2)}") for i in range(4)]
    found = {r.doc_id: r.component_id for r in jaccard.similar_documents(documents(*rows)).collect()}
    assert [found[i] for i in range(4)] == [c for _, c in brute(rows)]
