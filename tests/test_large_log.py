"""Logs larger than the checks' tables: sums past 64 bits, the rules on a derived log, many small files."""

from __future__ import annotations

import pytest

from conftest import raw_row, trips_frame
from tripgrid import catalog
from tripgrid.operators.clean import process_trips
from tripgrid.sources.fixture import raw_trips
from tripgrid.sources.trip_store import in_band_sql
from tripgrid.sources.trips_io import layout_frame, open_trips, write_trips

LINEITEM = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int"


def k_of(row):
    return row[0] * 1000003 + row[1] * 8191 + row[2] * 131 + row[3]


def lineitem(spark, path, rows):
    spark.createDataFrame(rows, LINEITEM).coalesce(2).write.parquet(f"{path}/lineitem.parquet")
    return path


def signed(n):
    return (n + 2**63) % 2**64 - 2**63


@pytest.mark.parametrize("name", ["raw_trips_profile", "roundtrip_parquet", "roundtrip_csv", "compacted_trips"])
def test_sums_past_64_bits(spark, scratch, name):
    rows = [(9 * 10**12 + i, i % 7, i % 11, i % 5) for i in range(80)]
    sf_dir = lineitem(spark, scratch, rows)
    found = catalog.queries()[name](spark, sf_dir)
    kept = [k_of(r) for r in rows] if name == "raw_trips_profile" else [r[0] for r in catalog.trips(spark, sf_dir).select("k").collect()]
    assert sum(kept) > 2**64
    assert dict(found.dtypes)["sum_k"] == "bigint" and found.first()["sum_k"] == signed(sum(kept))


def test_checksum_is_the_plain_sum_where_it_fits(spark):
    for rows in ([5, -7, None], [2**63 - 1], [-(2**63)], [2**63 - 1, 1, -1], []):
        df = spark.createDataFrame([(x,) for x in rows], "k bigint")
        assert df.agg(catalog.checksum("k")).first()[0] == (sum(x for x in rows if x is not None) if rows else None)


def test_formulas_of_the_derived_log_are_not_repeated_in_the_rules(spark, scratch):
    rows = [(i, i % 97, i % 11, i % 5) for i in range(1, 400)]
    sf_dir = lineitem(spark, scratch, rows)
    trips = catalog.trips(spark, sf_dir)
    filters = [line for line in trips._jdf.queryExecution().executedPlan().toString().splitlines() if " Filter " in line]
    assert filters and not any(word in line for line in filters for word in (" div ", "CASE WHEN", "l_partkey", "timestampadd"))
    want = process_trips(raw_trips(spark, sf_dir), extra=("k",))
    assert trips.dtypes == want.dtypes and sorted(trips.collect()) == sorted(want.collect()) and trips.count() > 50


def test_small_files_are_written_by_few_tasks(spark, scratch):
    rows = [raw_row(licencia=f"L{i}", pickup=f"2013-01-08 {i % 24:02d}:{i // 24 % 60:02d}:00", dropoff=f"2013-01-08 {i % 24:02d}:{i // 24 % 60:02d}:30") for i in range(2880)]
    rows += [raw_row(licencia=f"H{i}", pickup=f"2013-01-09 09:{30 + i % 10}:{i % 60:02d}", dropoff="2013-01-09 09:50:00") for i in range(1500)]
    trips, path = trips_frame(spark, rows), f"{scratch}/many"
    tasks = layout_frame(trips, "by_date", rows_per_file=20).rdd.getNumPartitions()
    write_trips(trips, path, layout="by_date", rows_per_file=20)
    store = open_trips(spark, path)
    files = store.files().collect()
    assert len(files) >= 4380 // 20 and tasks < len(files) / 2
    assert max(r.filas for r in files) <= 20 and sum(r.filas for r in files) == 4380
    assert sorted(store.frame().select("licencia").collect()) == sorted(trips.select("licencia").collect())
    # A file covers a short time still: half an hour of the busy day opens few files.
    day = "to_date(min_hora_subida) = DATE '2013-01-08'"
    in_band = store.files(f"{day} AND {in_band_sql('hora_subida', '09:05', '09:35')}").count()
    assert in_band <= store.files(day).count() / 10


def test_lines_of_the_broken_log(spark, scratch):
    rows = [(i, i % 97, i % 11, i % 5) for i in range(0, 40)] + [(0, 0, 0, catalog.SHORT), (0, 0, 0, catalog.LONG), (0, 0, 0, catalog.SHORT * catalog.LONG), (0, 0, 0, 1), (0, 0, 0, None)]
    sf_dir = lineitem(spark, scratch, rows)
    lines = [r[0] for r in spark.read.text(catalog._broken_csv(spark, sf_dir)).collect()]
    commas = sorted(line.count(",") for line in lines)
    want = []
    for r in rows:
        k = None if None in r else k_of(r)
        want.append(16 - (k is not None and k % catalog.SHORT == 0) + 2 * (k is not None and k % catalog.LONG == 0))
    assert commas == sorted(want)


def test_large_stages_are_compiled(spark, scratch):
    """HotSpot compiles no method of more than 8000 bytes."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
