from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import raw_frame, raw_row
from tripgrid import schema as S
from tripgrid.operators.clean import process_trips
from tripgrid.plans.frequent_routes import frequent_routes
from tripgrid.sources.trips_io import read_trips
from tripgrid.streaming.process_stream import process_stream
from tripgrid.streaming.routes_stream import INSTANT, frequent_routes_stream, rank_per_instant, route_counts_by_instant


def _rows():
    rows = []
    for day in (1, 2, 3):
        for i in range(12):
            rows.append(
                raw_row(
                    medallon=f"T{i % 4}",
                    pickup=f"2013-01-0{day} 09:{10 + 3 * i:02d}:00",
                    dropoff=f"2013-01-0{day} 09:{20 + 3 * i:02d}:00",
                    pickup_cell=(150 + i % 3, 155),
                    dropoff_cell=(160, 156 + i % 2),
                )
            )
    rows.append(raw_row(medallon=""))  # removed by cleaning
    return rows


def test_process_stream_equals_batch(spark, scratch):
    raw_dir = os.path.join(scratch, "raw")
    raw = raw_frame(spark, _rows())
    raw.repartition(3).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(raw_dir)
    out = os.path.join(scratch, "trips")
    q = process_stream(spark, raw_dir, out, checkpoint_location=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    streamed = read_trips(spark, out).select(*S.PROCESSED_COLUMNS)
    batch = process_trips(raw)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert set(S.LAYOUT_COLUMNS) <= set(read_trips(spark, out).columns)


def test_routes_by_instant_equals_batch(spark):
    trips = process_trips(raw_frame(spark, _rows()))
    counts = route_counts_by_instant(trips, 30, 5)
    ranked = rank_per_instant(counts)
    for t in ("2013-01-02 09:45", "2013-01-02 10:00", "2013-01-03 09:40"):
        at = dt.datetime.fromisoformat(t)
        got = ranked.where(F.col(INSTANT) == F.lit(t).cast("timestamp_ntz")).drop(INSTANT).collect()
        assert got == frequent_routes(trips, at).collect()


def test_frequent_routes_stream(spark, scratch):
    path = os.path.join(scratch, "trips")
    process_trips(raw_frame(spark, _rows())).write.parquet(path)
    stream = spark.readStream.schema(read_trips(spark, path).schema).parquet(path)
    out = os.path.join(scratch, "ranked")

    def sink(batch, epoch_id):
        batch.write.mode("append").parquet(out)

    q = frequent_routes_stream(stream, sink, os.path.join(scratch, "ckpt"), 30, 5, watermark="1 hour")
    q.awaitTermination(120)
    ranked = spark.read.parquet(out)
    # Instants well behind the watermark (the last input is on 01-03) are final.
    at = "2013-01-02 10:00"
    got = ranked.where(F.col(INSTANT) == F.lit(at).cast("timestamp_ntz")).drop(INSTANT).orderBy("rank").collect()
    batch = frequent_routes(read_trips(spark, path), at).collect()
    assert got == batch and len(got) > 0


def test_process_stream_restarts_exactly_once(spark, scratch):
    """A second run from the same checkpoint picks up only the new files."""
    raw_dir = os.path.join(scratch, "raw")
    out = os.path.join(scratch, "trips")
    ckpt = os.path.join(scratch, "ckpt")
    rows = _rows()
    first, second = rows[:20], rows[20:]
    raw_frame(spark, first).coalesce(1).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(os.path.join(raw_dir, "a"))
    process_stream(spark, raw_dir + "/*", out, checkpoint_location=ckpt, layout="flat").awaitTermination(120)
    n_first = read_trips(spark, out).count()
    raw_frame(spark, second).repartition(3).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(os.path.join(raw_dir, "b"))
    process_stream(
        spark, raw_dir + "/*", out, checkpoint_location=ckpt, layout="flat", max_files_per_trigger=1
    ).awaitTermination(120)
    total = read_trips(spark, out)
    expected = process_trips(raw_frame(spark, rows))
    assert n_first == process_trips(raw_frame(spark, first)).count()
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, expected.collect()))


def test_process_stream_called_again_without_a_checkpoint(spark, scratch):
    """The checkpoint belongs to the output: 5 rows, then 7 new ones, are 12."""
    raw_dir, out = os.path.join(scratch, "raw"), os.path.join(scratch, "trips")
    rows = [raw_row(licencia=f"L{i}", pickup=f"2013-01-02 09:{i:02d}:00", dropoff=f"2013-01-02 10:{i:02d}:00") for i in range(12)]
    for name, part in (("a", rows[:5]), ("b", rows[5:])):
        raw_frame(spark, part).coalesce(1).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(os.path.join(raw_dir, name))
        process_stream(spark, raw_dir + "/*", out).awaitTermination(120)
    assert sorted(r.licencia for r in read_trips(spark, out).collect()) == sorted(r[1] for r in rows)
