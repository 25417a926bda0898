"""Nearest neighbours against all distances."""

import math

import numpy as np
from pyspark.sql import functions as F

from tripgrid.llm import ann


def frame(spark, rows):
    schema = "vec_id bigint, embedding array<double>, vector string, block int, rank int"
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], schema)


def brute_force(rows, query, k):
    target = np.array(dict(rows)[query])
    scored = [(-float(np.dot(v, target) / np.linalg.norm(v) / np.linalg.norm(target)), i) for i, v in rows if i != query and len(v) == len(target)]
    return sorted(scored)[:k]


def test_recall_on_hard_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)  # several blocks
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(48).tolist()) for i in range(2000)]
    out = ann.nearest_neighbours(frame(spark, rows), F.col("id") % 50 == 0).collect()
    found = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(range(0, 2000, 50))
    hits = 0
    for query, got in found.items():
        want = brute_force(rows, query, 5)
        hits += len({i for _, i in want} & {i for i, _ in got})
        exact = {i: -s for s, i in brute_force(rows, query, 2000)}
        assert all(math.isclose(exact[i], s, abs_tol=1e-12) for i, s in got)
    assert hits >= 0.9 * 5 * len(found)


def test_near_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    rows = [(i, base.tolist()) for i in range(300)]  # a third and more of all vectors are equal
    rows += [(300 + i, rng.standard_normal(16).tolist()) for i in range(300)]
    good = list(rows)
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (1150, [1.0, None] * 8), (None, base.tolist()), (1200, []), (1250, [float("inf")] * 16)]
    rows += [(0, base.tolist()), (2000, [3e200, 4e200]), (2001, [3e-200, 4e-200]), (2002, [0.0, 1.0])]
    out = ann.nearest_neighbours(frame(spark, rows), F.col("id") % 50 == 0).collect()
    found = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert [i for i, _ in found[0]] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]  # two rows ask, each finds the other
    assert [i for i, _ in found[50]] == [0, 0, 1, 2, 3]
    assert all(abs(s - 1) < 1e-12 for _, s in found[50])
    assert [i for i, _ in found[300]] == [i for _, i in brute_force([*good, (0, base.tolist())], 300, 5)]
    # fewer candidates than asked for: all of them
    assert [(i, round(s, 12)) for i, s in found[2000]] == [(2001, 1.0), (2002, 0.8)]
    assert not {1000, 1050, 1100, 1150, 1200, 1250} & set(found)


def test_rows_of_one_id_are_all_candidates(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (7, [1.0, 0.01]), (7, [-1.0, 0.0]), (8, [0.5, 0.5])])
    out = ann.nearest_neighbours(df, F.col("id") == 0, k=2).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [7, 8] and out[0].score > 0.9999


def test_empty_tables(spark):
    df = frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])
    assert ann.nearest_neighbours(df.where("false"), F.col("id") % 50 == 0).count() == 0
    assert ann.nearest_neighbours(df, F.col("id") % 50 == 0).count() == 0
