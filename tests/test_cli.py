from __future__ import annotations

import os

from conftest import raw_frame, raw_row
from tripgrid import schema as S
from tripgrid.cli import main


def test_command_lines(spark, scratch, capsys):
    rows = [
        raw_row(medallon=f"T{i % 3}", pickup=f"2013-01-{1 + 7 * (i % 2):02d} 09:{35 + i % 20}:00",
                dropoff=f"2013-01-{1 + 7 * (i % 2):02d} 09:{45 + i % 14}:00",
                pickup_cell=(150 + i % 3, 155), dropoff_cell=(160, 156 + i % 2))
        for i in range(30)
    ]
    raw_csv = os.path.join(scratch, "raw")
    raw_frame(spark, rows).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(raw_csv)
    out = os.path.join(scratch, "trips")
    results = os.path.join(scratch, "results")
    timings = os.path.join(scratch, "timings")
    common = ["--results", results, "--timings", timings]
    assert main(["process", raw_csv, out, "--timings", timings], spark=spark) == 0
    assert main(["frequent-routes", out, "2013-01-08", "10:00", *common], spark=spark) == 0
    assert main(["frequent-routes-day", out, "enero", "martes", "10:00", *common], spark=spark) == 0
    assert main(["profitable-areas", out, "2013-01-08", "10:00", *common], spark=spark) == 0
    assert main(["profitable-areas-day", out, "martes", "01-08", "10:00", *common], spark=spark) == 0
    assert main(["summary", timings], spark=spark) == 0
    lines = sorted(r.value for r in spark.read.text(results).collect())
    assert len(lines) == 4
    assert any(line.startswith("09:30:00, 10:00:00, 0: (") for line in lines)
    assert any(line.startswith("2013-01-08 09:30:00, 2013-01-08 10:00:00, 0: (") for line in lines)
    assert spark.read.parquet(timings).count() == 5
    printed = capsys.readouterr().out
    assert "rank=0" in printed and "elapsed" in printed


def test_grid_and_scan_commands(spark, scratch, capsys):
    out = os.path.join(scratch, "grid")
    assert main(["grid", out], spark=spark) == 0
    grid = spark.read.option("header", "true").csv(out)
    assert grid.count() == 90_000 and grid.columns == ["X", "Y", "LATITUD", "LONGITUD"]
    raw_csv = os.path.join(scratch, "raw")
    raw_frame(spark, [raw_row(), raw_row(medallon="T9")]).write.option("timestampNTZFormat", S.TIME_FORMAT).csv(raw_csv)
    assert main(["scan-benchmark", raw_csv, os.path.join(scratch, "scan")], spark=spark) == 0
    assert "parquet" in capsys.readouterr().out
