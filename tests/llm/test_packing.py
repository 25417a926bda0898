"""Packing: ids against the library, pieces and sequences by their rules, placing against a plain list."""

import random
import zlib

import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

from tripgrid.llm import packing
from tripgrid.llm.queries import TOKENIZER, tokenizer_json

DOCS = "/root/testdata/sf0.01/documents.parquet"
ODD = [
    None,
    "",
    " ",
    "a",
    "<|endoftext|> is text",
    "tabs\t and\n\n lines  of   blanks ",
    "don't we'll it's THEY'RE 'sabc 12 3456 ٣٤ é🙂 漢字かな ñandú",
    "x" * 5000,
    "word " * 30_000,
    "no'blank," * 4000,
    "Ünïcödé wörds änd möre " * 2000,
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def pieces_of(df, **more):
    return packing.document_pieces(df, tokenizer_json(), P.PATTERN, 2, **more)


def check_sequences(rows, size=packing.SEQUENCE):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= size
    return len(by)


def test_ids_equal_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 40)
    encoder = packing.Encoder(tokenizer_json(), P.PATTERN)
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x20, 0x3000) if chr(c).isprintable()]
    made = ["".join(rng.choice([" ", " a", "é", "\n", "'s", "7", " ab, ", "\u00a0", "\u3000", "\t ", rng.choice(letters), rng.choice(letters)]) for _ in range(400)) for _ in range(200)]
    parts = ["a", "é", "'s", "'re", "7", ",", "\n", ".\n\nB", "\u00a0", "ñ-", *letters]
    # Words of any characters between single blanks, white space inside them too.
    words = ["x".join(rng.choices(parts, k=rng.randint(1, 4))).strip() or "w" for _ in range(4000)]
    made += [" ".join(rng.choices(words, k=60)) for _ in range(100)] + [" " + " ".join(rng.choices(words, k=60)) for _ in range(20)]
    latin = [chr(c) for c in range(0x250)]
    made += ["".join(rng.choices([" ", "a", "é", *latin], k=300)) for _ in range(300)]
    for text in [t for t in ODD if t is not None] + made:
        assert encoder(text) == b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)
    assert encoder.size < packing.MEMO_BYTES and len(encoder.memo) > 100


def test_memo_starts_anew_when_full(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    encoder = packing.Encoder(tokenizer_json(), P.PATTERN)
    for k in range(20):
        text = " ".join(f"word{k}x{j} letters{chr(97 + j)}{chr(97 + k)}" for j in range(20))
        assert len(encoder(text)) == 4 * len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert len(encoder.memo) < 200 and len(encoder.older) < 200


def test_cut():
    assert packing.cut(1) == [(0, 1)] and packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1025) == [(0, 1), (1, 1024)] and packing.cut(2048) == [(0, 1024), (1024, 1024)]


def test_placing_against_a_plain_list():
    rng = random.Random(3)
    for most in (1, 3, 20):
        sequences, open_, n = packing.OpenSequences(50, most), [], 0
        for _ in range(2000):
            length = rng.randint(1, 49)
            fits = [space for space, _ in open_ if space >= length]
            if fits:
                space = min(fits)
            else:
                if len(open_) == most:
                    fullest = min(space for space, _ in open_)
                    del open_[max(i for i, (space, _) in enumerate(open_) if space == fullest)]
                space = 50
            sequence, offset = sequences.place(length)
            assert offset == 50 - space
            if space == 50:
                assert sequence == n
                n += 1
            else:
                assert (space, sequence) in open_
                open_.remove((space, sequence))
            if space > length:
                open_.append((space - length, sequence))
            assert len(open_) == sequences.n_open <= most


def test_documents(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 300)  # several shards
    df = spark.read.parquet(DOCS).select("doc_id", "text")
    extra = [(-1 - i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, "no id"), (5, "an id again")]
    df = df.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    df = df.selectExpr("*", "'clash' as ids", "1 as piece", "2 as sequence_id", "3 as offset", "4 as piece_no")
    pieces = pieces_of(df)
    packed = packing.pack_pieces(pieces).collect()
    assert sorted(map(str, packed)) == sorted(map(str, packing.pack_pieces(pieces).collect()))  # a rerun packs alike
    want = {}
    for r in df.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        for k, (start, n) in enumerate(packing.cut(len(ids))):
            data = b"".join(i.to_bytes(4, "little") for i in ids[start : start + n])
            want.setdefault((r.doc_id, k, start, n, zlib.crc32(data)), []).append(data)
    got = {}
    for r in packed:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(bytes(r.ids))
    assert got == want
    n = check_sequences(packed)
    assert n <= 1.02 * sum(r.length for r in packed) / packing.SEQUENCE + 10
    # Few open sequences still give right, if more, sequences.
    monkeypatch.setattr(packing, "OPEN", 2)
    assert check_sequences(packing.pack_pieces(pieces).collect()) > n


def test_sequences_hold_the_ids(spark):
    df = spark.read.parquet(DOCS).where("doc_id < 200").select("doc_id", "text")
    packed = packing.pack_pieces(pieces_of(df))
    parts = {r.piece_no: r for r in packed.collect()}
    whole = packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in parts.values())
    for r in whole:
        assert len(r.ids) == 4 * r.n_tokens
        for p in r["pieces"]:
            assert bytes(r.ids)[4 * p.offset : 4 * (p.offset + p.length)] == bytes(parts[p.piece_no].ids)


def test_empty_and_tiny_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    rows = packing.pack_pieces(pieces_of(df, with_ids=False)).collect()
    assert [(r.piece, r.start, r.length) for r in rows] == [(0, 0, 1)] * 2 and check_sequences(rows) == 1
    assert rows[0].ids_crc32 == zlib.crc32((2).to_bytes(4, "little"))
    assert packing.pack_pieces(pieces_of(df.where("false"))).count() == 0
    assert TOKENIZER.endswith(".json")
