"""Lexical search against all scores, and the bounds of blocks against their documents."""

import collections
import math
import random
import re

import numpy as np

from tripgrid.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k):
    """Sorted ``(item_id, rank, doc_id, score)``."""
    counted = [(i, collections.Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in set(terms(text)) & set(c):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def made(n, seed):
    rng = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"é{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    topics = [[rng.choice(words) for _ in range(12)] for _ in range(15)]
    docs = []
    for i in range(n):
        text = rng.choices(words, weights, k=rng.randint(0, 40)) + rng.choices(rng.choice(topics), k=rng.randint(0, 25))
        docs.append((i, " ".join(text) + rng.choice(["", ".", "\n", "-the-", " "])))
    items = [(i, " ".join(rng.choices(words, weights, k=4) + rng.choices(rng.choice(topics), k=6))) for i in range(25)]
    return docs, items


def frames(spark, docs, items):
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in docs], "doc_id bigint, text string, item_id string, rank int, score int")
    return df, spark.createDataFrame([(*i, 7) for i in items], "item_id bigint, text string, doc_id int")


def found(df, items, k):
    return sorted(map(tuple, lexical.ranked_search(df, items, k).collect()), key=str)


def test_equals_all_scores(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 128)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "SAMPLE", 4)
    monkeypatch.setattr(lexical, "PACK_BYTES", 800)  # several packs
    docs, items = made(1500, 1)
    docs += [docs[7]] * 40 + [(5000 + i, docs[11][1]) for i in range(60)]  # copies and ties
    for k in (1, 5, 50):
        assert found(*frames(spark, docs, items), k) == brute_force(docs, items, k)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 1000)
    docs = [(1, None), (2, ""), (3, " .,- "), (None, "apple pie"), (None, "apple pie"), (4, "Apple"), (4, "apple tart"), (5, "apple, " * 20_000), (6, "x" * 5000 + " pie")]
    docs += [(i, f"plain {i}") for i in range(10, 40)]
    items = [(1, "APPLE pie"), (1, "apple"), (2, None), (3, ""), (None, "pie"), (4, "unknown words"), (5, "plain " * 1000)]
    df, asked = frames(spark, docs, items)
    assert found(df, asked, 4) == brute_force(docs, items, 4)
    assert found(df.where("false"), asked, 4) == [] and found(df, asked.where("false"), 4) == []


def test_terms_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = "".join(random.Random(5).choices(["a", "B", "é", " ", "9", "\n", "🙂", "-"], k=20_000))
    whole = [t.decode() for part in lexical.text_terms(text.encode()) for t in part]
    monkeypatch.setattr(lexical, "CHUNK", 50)
    assert whole == [t.decode() for part in lexical.text_terms(text.encode()) for t in part] == terms(text)


def test_blocks_bound_their_documents_and_spare_work():
    rng = np.random.default_rng(2)
    n, width = 4000, 200
    sizes = rng.integers(1, 20, n)
    topic = rng.integers(0, 20, n)
    rows = [np.unique(np.append(rng.integers(0, 20, s), 20 + 9 * t + rng.integers(0, 9, s))) for s, t in zip(sizes, topic, strict=True)]
    flat, starts = np.concatenate(rows), np.append(0, np.cumsum([len(r) for r in rows]))
    impacts = rng.integers(1, 1000, len(flat))
    weights = np.append(np.full(20, 10), np.full(width - 20, 900)).astype(np.int64)
    shard = lexical.Shard(weights, np.arange(n), np.zeros(n, bool), starts, flat, impacts)
    for term in (0, 25, 100):
        docs, begins, summary_term, summary, heads = shard.blocked(term)
        assert sorted(docs) == [d for d, r in enumerate(rows) if term in r]
        ends = np.append(heads[1:], len(summary))
        for b in range(len(begins) - 1):
            most = {}
            for d in docs[begins[b] : begins[b + 1]]:
                for t, x in zip(flat[starts[d] : starts[d + 1]].tolist(), impacts[starts[d] : starts[d + 1]].tolist(), strict=True):
                    most[t] = max(most.get(t, 0), x)
            assert most == dict(zip(summary_term[heads[b] : ends[b]].tolist(), summary[heads[b] : ends[b]].tolist(), strict=True))
    asked, best = np.zeros(width, np.int64), lexical.Best(10, 0)
    wanted = np.array([0, 1, 2, 26, 27, 28, 29])
    n_scored = lexical.search_shard(shard, wanted, weights, asked, best)
    asked[wanted] = weights[wanted]
    scores = shard.scores(np.arange(n), asked)
    want = np.lexsort((np.arange(n), -scores))[:10]
    assert best.ids.tolist() == want.tolist() and best.scores.tolist() == scores[want].tolist()
    assert n_scored < 0.2 * (scores > 0).sum()
