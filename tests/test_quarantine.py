"""Malformed records of a raw log are put aside and counted."""

from __future__ import annotations

import os

from conftest import raw_frame, raw_row
from test_io import SAMPLE
from tripgrid import schema as S
from tripgrid.operators.clean import clean_report, malformed_report, process_trips, quarantine
from tripgrid.plans.benchmark import performance_summary, run_process
from tripgrid.sources.trips_io import open_trips, read_raw_trips, read_timings

LINES = {
    SAMPLE: [],
    SAMPLE.replace(",120,", ",x,"): ["duracion_viaje_seg"],
    SAMPLE.replace("2013-01-01 00:02:00", "2013-13-01 00:02:00").replace("3.50", "3,50"): None,  # a comma too many moves the rest
    SAMPLE.rsplit(",", 1)[0]: ["numero_de_campos"],
    SAMPLE + ",more": ["numero_de_campos"],
    SAMPLE.replace("CSH", "UNK"): [],
    "," + SAMPLE.split(",", 1)[1]: [],
    SAMPLE.replace("-73.956528", "west").replace("0.44", "far"): ["distancia_viaje", "longitud_subida"],
    SAMPLE.replace("0.44", ""): [],
}


def test_records_are_stored_rejected_or_put_aside(spark, scratch):
    path, out, aside = (os.path.join(scratch, x) for x in ("raw.csv", "out", "aside"))
    with open(path, "w") as file:
        file.write("\n".join(LINES) + "\n")
    raw = read_raw_trips(spark, path, rescue=True)
    r = clean_report(raw).first()
    assert (r.n_raw, r.n_malformed, r.n_rejected, r.n_clean) == (9, 5, 2, 2)
    assert (r.fail_ids, r.fail_payment, r.fail_times) == (1, 1, 0)
    found = {x[S.RESCUE]: x.campos for x in quarantine(raw).collect()}
    assert set(found) == {line for line, bad in LINES.items() if bad is None or bad}
    for line, bad in LINES.items():
        assert not bad or found[line] == bad
    run_process(spark, path, out, timing_path=os.path.join(scratch, "timings"), quarantine_path=aside)
    assert open_trips(spark, out).frame().count() == 2
    stored = spark.read.parquet(aside)
    assert stored.count() == 5
    assert {x.campo: x.registros for x in malformed_report(stored).collect()}["numero_de_campos"] == 3
    assert performance_summary(read_timings(spark, os.path.join(scratch, "timings"))).first().filas == 9
    # Without a quarantine the fields that were not read are NULL, as before.
    assert process_trips(read_raw_trips(spark, path)).count() >= 2


def test_a_log_without_malformed_records_leaves_no_quarantine(spark, scratch):
    csv, out, aside = (os.path.join(scratch, x) for x in ("csv", "out", "aside"))
    raw_frame(spark, [raw_row(), raw_row(medallon="")]).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(csv)
    run_process(spark, csv, out, quarantine_path=aside)
    assert open_trips(spark, out).frame().count() == 1 and not os.path.exists(aside)
    r = clean_report(read_raw_trips(spark, csv, rescue=True)).first()
    assert (r.n_raw, r.n_malformed, r.n_rejected, r.n_clean) == (2, 0, 1, 1)
