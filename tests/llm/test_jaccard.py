"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tripgrid.llm import jaccard, sigtree
from tripgrid.llm.components import connected_components
from tripgrid.llm.shingles import shingle_sets


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 80 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return sorted(((i, len(s), least.get(x)) for (i, _), s, x in zip(rows, sets, label, strict=True)), key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for base in range(40):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 60, 300]))]
        if base % 3 == 0:
            text += passage
        for _ in range(rng.choice([1, 1, 2, 12])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), (" " if rng.random() < 0.9 else "\t\n").join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "one two three"), (1005, "one two three")]
    rows += [(None, rows[0][1]), (None, "a lonely text of null id here"), (1006, "A B C D E"), (1007, "a b c d e"), (1008, "é\xa0x y")]
    return rows


def frame(spark, rows):
    schema = "doc_id bigint, text string, key string, n int, component_id string, row int"
    return spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], schema)


@pytest.mark.parametrize("unit", [2048, 8])
def test_components(spark, monkeypatch, unit):
    monkeypatch.setattr(jaccard, "UNIT", unit)  # small units: buckets and clusters of several blocks
    rows = corpus()
    out = jaccard.jaccard_components(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute_force(rows)


def test_one_row_of_each_component_stays(spark):
    rows = [r for r in corpus(2) if r[0] is not None and r[0] != 1005]
    out = jaccard.drop_near_duplicates(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in brute_force(rows)})


def test_null_and_repeated_ids_stay_apart(spark):
    rows = corpus(4)
    near = [r for r in rows if r[0] is not None and r[0] < 1000]
    rows += [(None, "another lonely text that has no id at all"), (None, None), (None, "")]
    rows += [(i, f"unrelated text number {i} under an id that is not its own") for i, _ in near[::3]]
    rows += [(i, t + " more") for i, t in near[::5]] + [(None, t) for _, t in near[::7]]
    label = list(range(len(rows)))
    sets = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    stay = {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)):
        stay.setdefault(label[k], k)
    schema = "doc_id bigint, text string, row_no string, who int, component_id string, row int"
    df = spark.createDataFrame([(*r, "clash", 1, "clash", k) for k, r in enumerate(rows)], schema)
    out = jaccard.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r.row for r in out.collect()) == sorted(stay.values())


def test_empty_table(spark):
    assert jaccard.jaccard_components(frame(spark, corpus()).where("false")).count() == 0


def test_shingle_sets(monkeypatch):
    texts = [t for _, t in corpus(3)] + ["x" * 5000 + " y", "ab" * 40 + " " + "ba" * 40]
    found = list(shingle_sets(pa.array(texts)))
    assert [len(f) for f in found] == [len(shingles(t)) for t in texts]
    monkeypatch.setattr("tripgrid.llm.shingles.SLAB_BYTES", 100)
    again = list(shingle_sets(pa.array(["", *texts]).slice(1)))
    assert all(np.array_equal(a, b) for a, b in zip(found, again, strict=True))


def test_trees_keep_every_similar_pair():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(150):
        base = np.unique(rng.integers(0, 1 << 63, size=rng.choice([3, 40, 400, 1500])).astype(np.uint64))
        sets.append(base)
        kept = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 0.97])]
        if len(kept):
            sets.append(kept)
    rows = np.arange(len(sets))
    signatures = sigtree.Signatures(np.array([len(s) for s in sets]), [sigtree.bitmap(s) for s in sets], 80)
    found = {(min(a, b), max(a, b)) for x, y in signatures.tree_pairs(rows) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                want.add((j, i))
    assert want <= found
    assert len(found) < len(sets) * (len(sets) - 1) / 4


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 7), (200, 201), (201, 200), (5, 5), (300, 250)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert out == {**{i: 0 for i in range(31)}, 100: 0, 200: 200, 201: 200, 250: 250, 300: 250}
