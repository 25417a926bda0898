"""Collocations against a plain count, also where fingerprints collide."""

import collections
import random
import re

import numpy as np

from tripgrid.llm import phrases

SPLIT = re.compile("[.,;:!?\n\x0b\x0c\r]")
WORD = re.compile("[^ \t]+")


def counted(rows):
    f = collections.Counter()
    n = collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in SPLIT.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    return f, n


def brute_force(rows, least, most):
    f, n = counted(rows)
    out = []
    frequent = [(k[0], k[1:], v) for k, v in f.items() if len(k) >= 3 and v >= least]
    longer = collections.defaultdict(int)
    for lang, words, a in frequent:
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = (lang, words[i : i + m])
                longer[part] = max(longer[part], a)
    for lang, words, a in frequent:
        if 100 * longer[lang, words] >= 80 * a and (lang, words) in longer:
            continue
        cuts = [(2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    ranked, place = [], collections.Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= most:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(ranked)


def made(n, seed):
    rng = random.Random(seed)
    words = [f"Word{i}" if i % 4 else f"é{i}" for i in range(60)] + ["(a)", "ÀB", " x", "x" * 70]
    weights = [1 / (i + 1) for i in range(len(words))]
    idioms = [rng.sample(words, rng.randint(2, 5)) for _ in range(12)]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 30)):
            some = rng.choice(idioms) if rng.random() < 0.3 else rng.choices(words, weights, k=rng.randint(1, 4))
            text += rng.choice([" ", "  ", "\t", ""]) + " ".join(some) + rng.choice([" ", ". ", ",", "\n", " ;:", "\r\n", "! "])
        rows.append((rng.choice(["en", "en", "de", None]), text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "clash", 1, 2, 3) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string, phrase string, n int, a int, key int")


def found(spark, rows, least, most):
    return sorted(map(tuple, phrases.collocations(frame(spark, rows).repartition(5), least, most).collect()))


def test_equals_a_plain_count(spark, monkeypatch):
    rows = made(700, 1) + [(None, None), ("fr", ""), ("fr", " .,;\t\n"), ("fr", "un deux " * 40), ("de", "x" * 300_000 + " y"), ("und", "the und text " * 50)]
    want = brute_force(rows, 30, 2000)
    assert len({r[0] for r in want}) >= 4 and len(want) > 100
    assert found(spark, rows, 30, 2000) == want
    # Small slabs and tallies, and ranks that are cut off.
    monkeypatch.setattr(phrases, "SLAB_BYTES", 3000)
    monkeypatch.setattr(phrases, "TALLY", 500)
    monkeypatch.setattr(phrases, "TEXTS", 300)
    assert found(spark, rows, 30, 40) == brute_force(rows, 30, 40)


def test_colliding_fingerprints_are_told_apart_by_their_texts():
    rows = made(60, 2)
    words = phrases.Words("\n".join(t for _, t in rows).encode())
    words.keys = lambda firsts, order: (firsts % 7).astype(np.uint64)  # nearly everything collides
    everything = np.full(phrases.FILTER_BITS // 64, ~np.uint64(0))
    f, _ = counted([("en", t) for _, t in rows])
    for order in (1, 2, 4):
        got = collections.Counter()
        for text, n in phrases._verified_slab(words, order, everything):
            got[text.decode()] += n
        assert got == {" ".join(k[1:]): v for k, v in f.items() if len(k) == order + 1}


def test_fingerprints_do_not_depend_on_the_place_and_differ():
    one = phrases.Words(b"a b c. zz a b c")
    other = phrases.Words(b"q q q q\n  A\tB  c")
    keys = {one.text(f, 3): int(k) for f, k in zip(one.firsts(3), one.keys(one.firsts(3), 3), strict=True)}
    assert sorted(keys) == [b"a b c", b"zz a b"]
    assert int(other.keys(np.array([4]), 3)[0]) == keys[b"a b c"] and other.text(4, 3) == b"a b c"
    words = phrases.Words(" ".join(f"w{i}" for i in range(50_000)).encode())
    assert len(np.unique(np.concatenate([words.keys(words.firsts(m), m) for m in (1, 2, 3, 4)]))) == 4 * 50_000 - 6


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 9_000_000_000_000_000_000 // 1000
    df = spark.createDataFrame([(big, big, big + 7)], "a bigint, l bigint, r bigint")
    expr = F.expr("cast(a as decimal(28, 0)) * 2000000 div (cast(l as decimal(28, 0)) + r)").cast("bigint")
    assert df.select(expr.alias("s")).first().s == 2_000_000 * big // (2 * big + 7)


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [("en", "a b")]).where("false")).count() == 0
    assert phrases.collocations(frame(spark, [("en", "a b")])).count() == 0


def test_tasks_of_the_last_pass_do_not_grow_with_the_splits(spark):
    context = spark.sparkContext
    most = max(phrases.VERIFY_TASKS_PER_CORE * context.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = context.parallelize([("en", b"one two three. " * 3)] * 400, 3 * most)
    texts = spark.createDataFrame(rows, "lang string, data binary")
    everything = np.full(phrases.FILTER_BITS // 64, ~np.uint64(0))
    context.setJobGroup("verify", "last pass")
    try:
        found, sizes = phrases._verified(texts, everything, 30)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("verify") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= most
    assert {(r.phrase, r.f) for r in found.collect()} == {(p, 1200) for p in ("one", "two", "three", "one two", "two three", "one two three")}
    assert sizes.first().n == 3600


def test_texts_that_share_a_fingerprint_stay_apart_in_a_tally():
    rows = made(40, 5)
    everything = np.full(phrases.FILTER_BITS // 64, ~np.uint64(0))
    texts = phrases.Texts()
    for i in range(0, 40, 10):
        words = phrases.Words("\n".join(t for _, t in rows[i : i + 10]).encode())
        words.keys = lambda firsts, order: (firsts % 5).astype(np.uint64)
        texts.add("en", words, everything)
        texts._merge()
    got = collections.Counter()
    for batch in texts.flush():
        for r in batch.to_pylist():
            got[r["words"], r["phrase"]] += r["n"]  # a text has several of these fingerprints
    f, n = counted([("en", t) for _, t in rows])
    assert got == {(0, ""): n["en"], **{(len(k) - 1, " ".join(k[1:])): v for k, v in f.items()}}


def test_a_tally_is_full_only_of_different_texts(monkeypatch):
    monkeypatch.setattr(phrases, "TEXTS", 12)
    everything = np.full(phrases.FILTER_BITS // 64, ~np.uint64(0))
    texts = phrases.Texts()
    for _ in range(50):
        texts.add("en", phrases.Words(b"one two three"), everything)
        assert not texts.full()
    texts.add("en", phrases.Words(b"four five six seven"), everything)
    assert texts.full()
    got = {(r["words"], r["phrase"]): r["n"] for b in texts.flush() for r in b.to_pylist()}
    assert got[0, ""] == 154 and got[3, "one two three"] == 50 and got[4, "four five six seven"] == 1 and len(got) == 17
