import re
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import quality_rules as rules
from tripmill.llm.oracles import ablations_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def checked(df):
    found = rules.judge(rules.ledger(df)).collect()
    for r in found:
        expected = brute(r.text)
        assert {k: r[k] for k in expected} == expected, r.text
        base = expected["n_words"] < 10 or 100 * expected["n_repeat_words"] > 20 * expected["n_words"]
        assert r.base_failed == base and not (base and r.kept)
    return found


def test_hard_rows_and_clashing_columns(documents, hard_rows):
    assert len(checked(documents(*hard_rows, clash=True))) == len(hard_rows)


def test_measurements_equal_brute_force(documents):
    words = ["a", "b", "c", "|", "x#", "\n", "  ", "é", "\x00"]
    pieces = [" ".join(words[(i * k + j) % len(words)] for j in range(i)) for i in range(60) for k in (1, 2, 5)]
    lines = ["same line here\nother\nsame line here\n\n \nother", "a b c d e " * 5, "a b c d e f a b c d e"]
    checked(documents(*enumerate(pieces + lines)))


@settings(deadline=None, max_examples=8)
@given(st.lists(st.text(alphabet="ab \n\t#", max_size=80), min_size=40, max_size=60))
def test_random_texts(spark, texts):
    checked(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_policies_and_ablations(documents):
    good = "the quick brown fox jumps over a lazy dog while another one sleeps"
    rows = [(1, good), (2, "x"), (3, good.upper()), (4, " ".join(w + "***" for w in good.split()))]
    ledger = rules.ledger(documents(*rows))
    kept = lambda policy: {r.doc_id for r in rules.judge(ledger, policy).where("kept").collect()}
    assert kept("base") == {1, 3, 4} and kept("v1") == {1}
    found = {(r.policy, r.rule): (r.n_failed, r.n_only_this) for r in rules.ablations(ledger).collect()}
    assert found["v1", "symbols"] == (1, 1) and found["v1", "capitals"] == (1, 1)
    assert found["base", "few_words"] == (1, 1) and found["base", "repeated_words"] == (0, 0)


def test_empty_table(documents):
    assert rules.judge(rules.ledger(documents((1, "a")).limit(0))).count() == 0


def test_filters_do_not_reach_below_the_measurements(documents):
    plan = rules.judge(rules.ledger(documents((1, "a b")))).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.index("Filter") < plan.index("Generate")


def test_ablations_equal_their_sql(documents, hard_rows):
    good = "the quick brown fox jumps over a lazy dog while another one sleeps"
    rows = [(100 + k, text) for k, text in enumerate([good, "x", good.upper(), good.upper() + " ***" * 9, "a b c d e " * 8])]
    short = [r for r in hard_rows if len(r[1] or "") < 10_000]  # the SQL copies a text's words per window
    for df in (documents(*short, *rows), documents((1, "a")).limit(0)):
        con = duckdb.connect()
        con.register("documents", df.select("doc_id", "text").toPandas().astype({"text": "string"}))
        expected = con.execute(ablations_sql()).fetchall()
        assert sorted(tuple(r) for r in rules.ablations(rules.ledger(df)).collect()) == sorted(expected)
