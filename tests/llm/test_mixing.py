"""Source mixing: targets against iterated resharing, totals and limits exactly."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripgrid.llm import mixing


def rows_of(spec, seed=3):
    """(doc_id, source, words) from {source: sizes}."""
    out = []
    for source, sizes in spec.items():
        for size in sizes:
            out.append((len(out), source, " ".join(f"{source}-{len(out)}-{k}" for k in range(size))))
    return out


SPEC = {
    "a": [700, 1, 0, 5000, 33],
    "b": [3] * 40,
    "c": [100, 250, 17],
    "é": [2000, 2000, 9],
    "z": [1],
    None: [400, 60, 0],
}


def frame(spark, rows):
    schema = "doc_id bigint, source string, text string, size int, sid string, n_chars bigint"
    return spark.createDataFrame([(*r, 5, "clash", len(r[2] or "")) for r in rows], schema)


def targets(spec, weights=(5, 2, 1), most=3):
    """Share by weight, cap, reshare the excess until none is above."""
    names = sorted((s for s in spec if s is not None), key=lambda s: s.encode()) + ([None] if None in spec else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: most * sum(spec[s]) for s in names}
    total, capped = sum(map(sum, spec.values())), set()
    while True:
        rest = total - sum(cap[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: cap[s] if s in capped else rest * weight[s] / share for s in names}
        new = {s for s in names if s not in capped and target[s] > cap[s]}
        if not new:
            return target
        capped |= new


@pytest.mark.parametrize("block_words,shard_slots", [(256, 4096), (16, 8), (1, 50)])
def test_totals_and_limits(spark, block_words, shard_slots):
    df = frame(spark, rows_of(SPEC))
    out = mixing.mixed_sizes(df, block_words=block_words, shard_slots=shard_slots)
    first, again = sorted(map(tuple, out.collect())), sorted(map(tuple, mixing.mixed_sizes(df, block_words=block_words, shard_slots=shard_slots).collect()))
    assert first == again
    want, sources = targets(SPEC), {i: s for i, s, _ in rows_of(SPEC)}
    taken = defaultdict(int)
    for doc_id, size, source_size, target, n in first:
        s = sources[doc_id]
        assert source_size == sum(SPEC[s]) and target == pytest.approx(want[s])
        assert 0 <= n <= 3 * size
        taken[s] += n
    for s in SPEC:
        assert abs(taken[s] - want[s]) <= 0.5


def test_slots_are_dealt_once_and_blocks_permuted(spark):
    rows = mixing.sized_rows(frame(spark, rows_of(SPEC)))
    pieces, sources = mixing.mix_pieces(rows, block_words=16, shard_slots=8)
    sized = {r.sid: r for r in sources.collect()}
    seen = Counter()
    for p in pieces.collect():
        assert 0 <= p.slot < sized[p.sid].n_slots and p.n_words <= 16
        for k in range(p.first, p.first + p.n_words):
            seen[p.row_no, k, p.pass_no] += 1
    assert max(seen.values()) == 1  # a pass takes a word once at most
    slots = mixing.drawn_slots(sources, 8, 1)
    assert slots.count() == sum(r.n_slots for r in sized.values()) == slots.select("sid", "slot").distinct().count()


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97])
def test_shuffle_is_a_permutation(spark, n):
    key = [F.lit(1), F.lit(2)]
    df = spark.range(n).select("id", mixing._shuffled(F.col("id"), F.lit(n), key).alias("to"))
    df = df.withColumn("back", mixing._shuffled(F.col("to"), F.lit(n), key, inverse=True))
    found = df.collect()
    assert sorted(r.to for r in found) == list(range(n)) and all(r.back == r.id for r in found)
    assert n < 10 or [r.to for r in found] != list(range(n))


def test_documents(spark):
    rows = rows_of(SPEC)
    rows[0] = (0, "a", rows[0][2].replace(" ", "\t \n"))
    df = frame(spark, [*rows, (None, "a", None), (0, "b", "twice the id")])
    spec = {**SPEC, "b": [*SPEC["b"], 3]}
    out = mixing.mix_documents(df, block_words=16)
    assert out.columns == df.columns
    texts, got = defaultdict(str), Counter()
    for i, s, t in rows:
        texts[i, s] = t
    for r in out.collect():
        words = r.text.split()
        got[r.source] += len(words)
        assert r.n_chars == len(r.text)
        if (r.doc_id, r.source) != (0, "b"):
            whole = texts[r.doc_id, r.source]
            assert set(words) <= set(whole.split()) and len(set(words)) == len(words)
            assert r.text == whole or len(words) < len(whole.split())
    for s, target in targets(spec).items():
        assert abs(got[s] - target) <= 0.5


def test_empty_tables(spark):
    df = frame(spark, rows_of(SPEC))
    assert mixing.mixed_sizes(df.where("false")).count() == 0
    assert mixing.mix_documents(df.where("false")).count() == 0
    only_empty = mixing.mixed_sizes(frame(spark, [(1, "a", None), (2, None, " ")])).collect()
    assert [(r["size"], r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 2
