"""Exact dedup against grouping by the text."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tripgrid.llm import exact_dedup as d

BIG = "0123456789abcdef" * 150_000  # several chunks
ROWS = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, None), (4, ""), (5, "b "), (6, "b"), (7, BIG), (8, BIG), (9, BIG[:-1] + "X"), (None, "z")]


def frame(spark, rows=ROWS):
    schema = "doc_id bigint, text string, text_sha256 int, kept string, h1 int, row string"
    return spark.createDataFrame([(*r, 1, "clash", 2, "r") for r in rows], schema)


@given(st.binary(max_size=300), st.binary(max_size=300))
@settings(max_examples=200, deadline=None)
def test_hashes_combine(x, y):
    for k, prime in enumerate(d.PRIMES):
        assert d.chunk_hash(x + y)[k] == d.combine(d.chunk_hash(x)[k], d.chunk_hash(y)[k], len(y), prime)


def test_hash_is_the_polynomial():
    data = bytes(range(256)) * 300
    want = 0
    for b in data:
        want = (want * d.BASE + b + 1) % d.PRIMES[0]
    assert d.chunk_hash(data)[0] == want


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups(spark):
    out = d.exact_duplicates(frame(spark)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out], key=str) == expected(ROWS)
    kept = [r for r in out if r.kept]
    assert len(kept) == len({t or "" for _, t in ROWS}) and all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay_keep_their_columns(spark):
    out = d.drop_exact_duplicates(frame(spark))
    assert out.columns == frame(spark).columns
    got = [(r.doc_id, r.text or "") for r in out.collect()]
    assert sorted(got, key=str) == sorted({2: "a", 4: "", 5: "b ", 6: "b", 8: BIG, 9: BIG[:-1] + "X", None: "z"}.items(), key=str)


def test_different_texts_of_one_fingerprint(spark):
    """Groups that fail the comparison go by their texts."""
    rows = [(1, "p"), (2, "p"), (2, "p"), (3, "q"), (4, "other")]
    df = frame(spark, rows)
    prints = d.fingerprints(df).where("id < 4").select(*d.FINGERPRINT).distinct()
    out = d._by_whole_text(df, "doc_id", "text", prints).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in out) == [(1, 2, 3), (2, 2, 3), (2, 2, 3), (3, 3, 1)]
    assert sum(r.kept for r in out) == 2


def test_empty_table(spark):
    assert d.exact_duplicates(frame(spark).where("false")).count() == 0
    assert d.drop_exact_duplicates(frame(spark).where("false")).count() == 0
