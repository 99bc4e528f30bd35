import numpy as np

from tripmill.llm import weak_labels

GOOD = "The {} is in the house of the {} and it was on the table with a {}."
NOUNS = "cat dog garden window river stone book cup lamp chair road field bird tree".split()


def corpus(n=120, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        text = "\n".join(GOOD.format(*rng.choice(NOUNS, 3)) for _ in range(5))
        kind = i % 8
        if kind == 1:
            text = " ".join(w + "***" for w in text.split())
        elif kind == 2:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 3:
            text = " ".join(w for w in text.split()[:4] for _ in range(15))
        rows.append((i, text, kind not in (1, 2, 3)))
    return rows


def test_junk_goes_and_clean_texts_stay(documents):
    rows = corpus()
    docs = documents(*((k, t) for k, t, _ in rows), clash=True)
    found = {r.doc_id: r for r in weak_labels.score(docs, weak_labels.fit(docs)).collect()}
    assert all(0 <= found[k].score <= 1 and 0 <= found[k].posterior <= 1 for k, _, _ in rows)
    assert all(found[k].kept for k, _, good in rows if good)
    assert sum(not found[k].kept for k, _, good in rows if not good) >= 0.9 * sum(not good for _, _, good in rows)


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    goods = {"function_words", "sentences", "length"}
    counts = {}
    chance = {name: (0.25, 0.9) if name in goods else (0.6, 0.02) for name in weak_labels.LABELLERS}
    for good in truth:
        code = 0
        for name in weak_labels.LABELLERS:
            hit = rng.random() < chance[name][int(good)]
            code = code * 3 + ((weak_labels.GOOD if name in goods else weak_labels.BAD) if hit else weak_labels.NOTHING)
        counts[code] = counts.get(code, 0) + 1
    share, chances, posterior = weak_labels.expectation_maximisation(counts)
    assert abs(share - 0.8) < 0.02 and len(posterior) == len(counts)
    for k, name in enumerate(weak_labels.LABELLERS):
        vote = weak_labels.GOOD if name in goods else weak_labels.BAD
        assert abs(chances[k, 0, vote] - chance[name][0]) < 0.05 and abs(chances[k, 1, vote] - chance[name][1]) < 0.05


def test_pattern_counts_cover_all_rows(documents):
    rows = corpus()
    counts = weak_labels.pattern_counts(documents(*((k, t) for k, t, _ in rows)))
    expected = {}
    for _, text, _ in rows:
        code = weak_labels.pattern(weak_labels.Shape(text))
        expected[code] = expected.get(code, 0) + 1
        assert weak_labels.votes_of(code) == [vote(weak_labels.Shape(text)) for vote in weak_labels.LABELLERS.values()]
    assert counts == expected


def test_hard_rows(documents, hard_rows):
    docs = documents(*hard_rows, clash=True)
    found = weak_labels.score(docs, weak_labels.fit(docs)).collect()
    assert len(found) == len(hard_rows)
    assert all(r.score == 0 and not r.kept for r in found if r.doc_id in (1, 2, 3))
    none = docs.limit(0)
    assert weak_labels.score(none, weak_labels.fit(none)).count() == 0


def em_by_loops(counts, rounds):
    """Every row on its own, in plain numbers: class shares, chances, posteriors, round after round."""
    labellers = range(len(weak_labels.LABELLERS))
    rows = [(code, weak_labels.votes_of(code)) for code, n in counts.items() for _ in range(n)]
    good = [0.05 if weak_labels.BAD in votes else 0.95 for _, votes in rows]
    for _ in range(rounds):
        share = (sum(good) + 1) / (len(rows) + 2)
        weights = [1 - g for g in good], good
        tally = [[[0.5 + sum(w for w, (_, votes) in zip(of, rows) if votes[k] == v) for v in range(3)] for of in weights] for k in labellers]
        chance = [[[x / sum(of) for x in of] for of in both] for both in tally]
        good = []
        for _, votes in rows:
            bad, fine = 1 - share, share
            for k in labellers:
                bad, fine = bad * chance[k][0][votes[k]], fine * chance[k][1][votes[k]]
            good.append(fine / (bad + fine))
    return share, dict(zip((code for code, _ in rows), good))


def test_expectation_maximisation_equals_plain_loops():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3 ** len(weak_labels.LABELLERS), 25)
    counts = {int(code): int(n) for code, n in zip(codes, rng.integers(1, 6, 25))}
    share, _, posterior = weak_labels.expectation_maximisation(counts, rounds=7)
    expected_share, expected = em_by_loops(counts, 7)
    assert abs(share - expected_share) < 1e-9 and posterior.keys() == expected.keys()
    assert all(abs(posterior[code] - expected[code]) < 1e-9 for code in expected)


def test_agreement_with_the_labels(spark):
    """The labels judge the result only; nothing is learned from them."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    found = weak_labels.score(docs, weak_labels.fit(docs)).join(labels, "doc_id").select("quality", "kept", "score").toPandas()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    ranks = found.score.rank()
    area = (ranks[found.quality == 1].sum() - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad))
    figures = {"good kept": good.kept.mean(), "junk dropped": 1 - bad.kept.mean(), "area": area}
    print(figures)
    assert figures["good kept"] >= 0.95 and figures["junk dropped"] >= 0.8 and area >= 0.9, figures
