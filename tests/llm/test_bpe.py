import hashlib
import itertools

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(VOCABULARY)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)


def ids(text):
    return [int(i) for i in CODEC.encode(text).split()]


@settings(deadline=None, max_examples=300)
@given(st.text())
def test_ids_equal_the_library_and_decode_to_the_text(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_white_space_and_contractions():
    parts = ["a", " ", "\n", "\x1c", "\x85", "\xa0", "'s", "1", "!", "é"]
    for text in map("".join, itertools.product(parts, repeat=3)):
        assert ids(text) == LIBRARY.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("piece", ["a" * 5_000, "qzxj" * 2_000, "ab", "é" * 700])
def test_long_pieces(piece):
    assert ids(piece) == LIBRARY.encode_ordinary(piece)


def test_one_tree_and_many_trees_agree():
    words = ("unbelievableness", "zzzzzzzq", "Ünïcödé", "x1y2z3", "thhently", "qq", "ndwhstor")
    pieces = [w.encode() for w in words if w.encode() not in RANKS]
    assert len(pieces) > 4 and bpe.merge_many(pieces, CODEC.pairs) == [bpe.merge(p, RANKS) for p in pieces]


def test_query_rows(spark, documents, hard_rows):
    found = bpe.digests(documents(*hard_rows, clash=True), VOCABULARY, public_tokenizers.PATTERN).collect()
    assert len(found) == len(hard_rows)
    texts = sorted((r[0] or 0, r[1] or "") for r in hard_rows)
    for row, (key, text) in zip(sorted(found, key=lambda r: (r.doc_id or 0, r.n_tokens)), sorted(texts, key=lambda t: (t[0], len(LIBRARY.encode_ordinary(t[1]))))):
        expected = LIBRARY.encode_ordinary(text)
        assert (row.doc_id or 0, row.n_tokens) == (key, len(expected))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(documents(*hard_rows).limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode_frames(spark, documents):
    encoded = bpe.encode(documents((1, "Hello there"), (2, None)), VOCABULARY, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, VOCABULARY, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.bytes) for r in decoded.collect()} == {1: b"Hello there", 2: b""}
