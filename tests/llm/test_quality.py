"""The ordinal classifier: gradient, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tripgrid.llm import quality
from tripgrid.llm.queries import N_GRADES, rated

SF = "/root/testdata/sf0.1"


def test_loss_gradient():
    rng = np.random.default_rng(0)
    grades, scores, thresholds = rng.integers(0, 4, 50), rng.standard_normal(50), np.array([-1.0, 0.2, 1.5])
    _, by_score, by_threshold = quality._loss(grades, scores, thresholds)
    step = 1e-6
    for k in range(50):
        moved = scores.copy()
        moved[k] += step
        slope = (quality._loss(grades, moved, thresholds)[0] - quality._loss(grades, scores, thresholds)[0]) / step
        assert abs(slope - by_score[k]) < 1e-4
    for k in range(3):
        moved = thresholds.copy()
        moved[k] += step
        slope = (quality._loss(grades, scores, moved)[0] - quality._loss(grades, scores, thresholds)[0]) / step
        assert abs(slope - by_threshold[k]) < 1e-3


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"), rated(), N_GRADES)
    assert list(model.thresholds) == sorted(model.thresholds)
    out = quality.grades(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    by = {r.quality: r for r in out.groupBy("quality").agg(F.avg((F.col("p_at_least_1") >= 0.5).cast("int")).alias("kept"), F.avg("expected_grade").alias("grade")).collect()}
    assert by[1].kept >= 0.995 and by[0].kept <= 0.08
    assert by[0].grade < 0.5 < 1.7 < by[1].grade


def test_odd_rows(spark):
    rows = [(i, ("Plain words, and more of them. " * 5) if i % 2 else "JUNK!!! *** %%% " * 20) for i in range(60)]
    rows += [(None, None), (70, ""), (71, " \n"), (72, "é🙂" * 100_000), (1, rows[1][1])]
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id bigint, text string, grade int, data string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(2, 1, 0), (None, 1, 0), (70, None, None)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(df, labels, rated(), N_GRADES)
    out = quality.grades(df, model)
    assert out.count() == len(rows)
    one = [r for r in out.collect() if r.doc_id == 1]
    assert len(one) == 2 and one[0] == one[1]
    kept = quality.select_documents(df, model)
    assert kept.columns == df.columns and {i for i in range(1, 60, 2)} <= {r.doc_id for r in kept.collect()}
    assert not {i for i in range(0, 60, 2)} & {r.doc_id for r in kept.collect()}
    assert quality.grades(df.where("false"), model).count() == 0
    untrained = quality.fit(df, labels.where("false"), rated(), N_GRADES)
    assert quality.select_documents(df, untrained).count() == len(rows)
