import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import automaton, secret_scan
from tripmill.llm.secret_scan import MORE, RULES, Rule, compile_rules

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SCANNER = compile_rules()


def brute(text):
    """Every rule by the regular expressions of the contract, then the others by their own pattern."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    heads = {"github": 4, "slack": 5, "google": 4, "stripe": 8, "jwt": 3}
    for number, rule in enumerate(MORE, 3):
        for m in re.finditer(rule.pattern, text):
            if rule.kind == "key" or m.end() - m.start() - heads[rule.kind] >= rule.least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


PIECES = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "=", ":", " ", "  ", '"', "'", "é", "日", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6", "x"]
PIECES += ["0123456789abcdef" * 2, "deadbeef", "ghp_", "ghp_" + "a1" * 18, "xoxb-", "12-34-56-78", "AIza" + "b_" * 18, "AIza", "sk_live_", "k" * 16, "eyJ", ".eyJ", "a." * 20, "\n"]
PIECES += ["-----BEGIN ", "RSA ", "PRIVATE KEY-----", "-", "==", "hunter2222"]


@settings(deadline=None, max_examples=400)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=4))
def test_scanner_equals_regular_expressions(texts):
    assert SCANNER.texts(texts) == [brute(text) for text in texts]


@pytest.mark.parametrize("pattern", ["ab|a(b|c)+d", "[^a-c]x{2,3}", "a{3}b?", r"\x41[\x41-\x43]*\.", "(ab){2,}", "a?b*c+", "[]-]?x|[a\\-]z"])
def test_automata_equal_regular_expressions(pattern):
    """Acceptance of whole words, and of some match ending at every byte; also least in size."""
    if pattern.startswith("[]"):
        pattern = r"[\]-]?x|[a\-]z"
    own, anywhere = automaton.compile_patterns([pattern], anywhere=False), automaton.compile_patterns([pattern])
    known, draw = re.compile(pattern, re.S), random.Random(5)
    for _ in range(400):
        word = "".join(draw.choice("abcdxzAB].-") for _ in range(draw.randint(1, 9)))
        states = own.walk(word.encode())
        for k in range(1, len(word) + 1):
            assert (k <= len(states) and bool(own.accepts[states[k - 1]])) == bool(known.fullmatch(word[:k]))
        found = anywhere.accepts[anywhere.states(np.frombuffer(word.encode(), dtype=np.uint8))].astype(bool).tolist()
        assert found == [any(known.fullmatch(word[a:k]) for a in range(k)) for k in range(1, len(word) + 1)]


def test_automaton_is_least():
    """(a|b)*abb has four states in its least automaton, two patterns with the same ends share them."""
    assert len(automaton.compile_patterns(["abb"]).table) == 4
    assert len(automaton.compile_patterns(["(a|b)*abb"]).table) == 4


def test_patterns_that_are_not_understood():
    for pattern in ("é", "(a", "a)", "[a"):
        with pytest.raises(ValueError):
            automaton.parse(pattern)


def test_states_over_many_chunks_equal_reading_byte_by_byte():
    draw = random.Random(3)
    long = "token=" + "".join(draw.choice("abcdef0123456789") for _ in range(20_000))
    data = (" word " * 3_000 + long + " " + "AKIA" + "Z9" * 4_000 + " secret: '" + "x" * 6_000).encode() + b"\xff" * 5_000
    rows, kinds, state, expected = SCANNER.combined.table.tolist(), SCANNER.combined.kinds, 0, []
    for byte in data:
        state = rows[state][kinds[byte]]
        expected.append(state)
    assert SCANNER.combined.states(np.frombuffer(data, dtype=np.uint8)).tolist() == expected


def test_spent_bytes_and_overlapping_kinds():
    for text in ("token=token:abcdefgh", "token==abcdefgh", "tokentoken=abcdefgh", "secret = 'deadbeefdeadbeefdeadbeefdeadbeef'", "AKIA" * 5, "api_key:apikey=12345678"):
        assert SCANNER.texts([text]) == [brute(text)]


def test_hard_rows(spark, documents, hard_rows):
    long = "é " * 100_000 + "password: hunter22hunter22 " + "0a" * 30_000
    rows = [*hard_rows, (20, long, "en"), (21, "token=\"abcdefgh", "en"), (21, "token=\"abcdefgh", "en")]
    out = secret_scan.report(documents(*rows, clash=True)).collect()
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    for (key, text, *_), got in zip(rows, out):
        expected = brute(text or "")
        base = ",".join(f"{RULES[r].kind}:{a}:{b}" for a, r, b in expected if r < 3)
        assert (got.doc_id, got.base_sha256) == (key, hashlib.sha256(base.encode()).hexdigest())
        assert got.spans == ",".join(f"{RULES[r].kind}:{a}:{b}" for a, r, b in expected)
        assert (got.n_assign, got.n_hex) == (sum(r == 0 for _, r, _ in expected), sum(r == 2 for _, r, _ in expected))


def test_empty_table_and_rules_of_the_caller(documents):
    assert secret_scan.report(documents((1, "x")).limit(0)).collect() == []
    found = secret_scan.find(documents((1, "id 4711-22, id 99")), rules=[Rule("id", "id [0-9-]+", 4)]).first()
    assert [tuple(s) for s in found.spans] == [("id", 0, 10)]


def test_redact_keeps_rows_columns_and_nulls(documents):
    docs = documents((1, "my token=abcdefgh1 and é"), (2, None), (2, None), (3, "nothing"), clash=True)
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and [r.text for r in out.collect()] == ["my [ASSIGN] and é", None, None, "nothing"]
