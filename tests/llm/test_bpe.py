"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tripgrid.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.parse_ranks(bpe.read_ranks(PATH))
    own = bpe.Encoder(ranks, P.PATTERN)
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, bpe.Decoder(ranks), lambda x: b"".join(i.to_bytes(4, "little") for i in known.encode_ordinary(x))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abcdeinrst 'éA0\n", max_size=60))
def test_like_tiktoken(both, text):
    own, decoder, known = both
    ids = own.encode(text)
    assert ids == known(text)
    assert decoder.decode(ids) == text.encode()


def test_every_token_and_pairs_of_tokens(both):
    own, _, known = both
    tokens = list(own.ranks)[::37]
    for a, b in zip(tokens, reversed(tokens), strict=True):
        text = (a + b).decode("utf-8", "ignore")
        assert own.encode(text) == known(text)


def test_long_piece_without_spaces(both):
    own, decoder, known = both
    text = "ab" * 2000 + "é" * 1500
    assert own.encode(text) == known(text)
    assert decoder.decode(own.encode("x" * 200_000)) == b"x" * 200_000


def test_small_memos_change_nothing(both, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_MEMO", 2)
    monkeypatch.setattr(bpe, "PAIR_MEMO", 2)
    tight = bpe.Encoder(both[0].ranks, P.PATTERN)
    text = "the quick brown foxes jumped over lazily inexplicable dogs " * 3
    assert tight.encode(text) == both[2](text)


def test_frames(spark, both):
    texts = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "long " * 50_000)]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in texts], "doc_id bigint, text string, ids string, n_tokens int")
    out = bpe.decode_documents(bpe.encode_documents(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in out) == sorted((i or 0, (t or "").encode()) for i, t in texts)
    assert {r.doc_id: r.n_tokens for r in out}[1] == 0
    both_ways = bpe.encode_documents(df, PATH, P.PATTERN, decode=True).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in both_ways) == sorted((i or 0, (t or "").encode()) for i, t in texts)
    ids = bpe.encode_documents(df.where("doc_id = 3"), PATH, P.PATTERN).collect()
    assert {hashlib.sha256(r.ids).hexdigest() for r in ids} == {hashlib.sha256(both[2]("same")).hexdigest()}
    assert bpe.encode_documents(df.where("false"), PATH, P.PATTERN).count() == 0


def test_vocabulary_without_bytes_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Encoder({b"a": 0}, P.PATTERN)
