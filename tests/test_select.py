"""Selection of a prefix by counts, against sorting."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripgrid.operators.select import select_first

SCHEMA = "t timestamp_ntz, k bigint, s string, d decimal(10,2), b boolean, day date, x double, id int"


def made(n, seed):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.1 else v
    return [
        (
            maybe(dt.datetime(2013, 1, 1) + dt.timedelta(microseconds=rng.choice([0, 1, 5, 10**6, rng.randrange(10**12)]))),
            maybe(rng.choice([-(2**62), -5, 0, 7, 2**62, rng.randrange(10**9)])),
            maybe(rng.choice(["", "a", "ab", "abc", "ñ", "漢", "T" + str(rng.randrange(500)), "z" * rng.randint(1, 40), "🙂"])),
            maybe(Decimal(rng.randint(-9999, 9999)) / 100),
            maybe(rng.random() < 0.5),
            maybe(dt.date(2013, 1, 1) + dt.timedelta(days=rng.randint(0, 900))),
            maybe(rng.random()),
            i,
        )
        for i in range(n)
    ]


def key(row, columns):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    out = []
    for c in columns:
        v = row[names.index(c)]
        out.append((v is None, 0 if v is None else v.encode() if isinstance(v, str) else v))
    return out


@pytest.mark.parametrize("order", [("t", "id"), ("k", "s", "id"), ("s", "k", "id"), ("d", "b", "day", "id"), ("b", "s", "id"), ("x", "id"), ("day", "t", "id")])
def test_selects_what_sorting_selects(spark, order):
    rows = made(600, len(order))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    ordered = sorted(rows, key=lambda r: key(r, order))
    for n in (0, 1, 60, 300, 541, 700):
        found = select_first(df, n, order, F.lit(True), bound=20)
        assert sorted(r.id for r in found.rows(df, order).collect()) == sorted(r[-1] for r in ordered[:n]), n
        if order[0] != "x":  # floating-point columns are not divided
            assert found.n_last <= 20 or not found.rest
    inside = F.col("id") % 2 == 0
    found = select_first(df, 100, order, inside, bound=20)
    assert sorted(r.id for r in found.rows(df, order).collect()) == sorted(r[-1] for r in [r for r in ordered if r[-1] % 2 == 0][:100])


def test_equal_rows_cannot_be_divided(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 2)] * 5, "s string, k int")
    found = select_first(df, 300, ("s", "k"), F.lit(True), bound=20)
    assert found.rows(df, ("s", "k")).count() == 300 and found.n_last == 500


def test_a_second_and_missing_times_with_a_third_of_all_rows(spark):
    from tripgrid.operators.sample import ladder_summary, prefix_sample

    rows = [(dt.datetime(2013, 1, 1, 8) if i % 3 else None, i * 7919 % 3001, f"L{i % 50}") for i in range(3000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k int, s string")
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2].encode(), r[1]))
    for n in (700, 2001, 2500):
        got = prefix_sample(df, n, ("t", "s", "k"), bound=50).collect()
        assert sorted(map(str, got)) == sorted(str(r) for r in spark.createDataFrame(ordered[:n], df.schema).collect())
    summary = {r.tamano: r for r in ladder_summary(df, ("t", "s", "k"), sizes=[1, 1999, 2500]).collect()}
    assert all(summary[n].filas == n for n in summary) and summary[2500].max_subida == dt.datetime(2013, 1, 1, 8)
