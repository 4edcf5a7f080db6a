"""Curves by threshold: hand example, range-count invariance, ML cross-check."""
import pytest
from pyspark.sql import functions as F

from searchscore.operators import metrics as mt

ROWS = [(0.9, 1.0), (0.9, 0.0), (0.8, 1.0), (0.5, 0.0), (0.5, 1.0), (0.1, 0.0), (0.1, 0.0)]


def curve(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "score double, label double")
    return {r.threshold: r for r in mt.curves_by_threshold(df).collect()}


def test_hand_example(spark):
    c = curve(spark)
    # P = 3. thresholds from the top: 0.9 -> tp1 fp1; 0.8 -> tp2 fp1; 0.5 -> tp3 fp2; 0.1 -> tp3 fp4
    assert c[0.9].precision == pytest.approx(0.5) and c[0.9].recall == pytest.approx(1 / 3)
    assert c[0.8].precision == pytest.approx(2 / 3) and c[0.8].recall == pytest.approx(2 / 3)
    assert c[0.5].precision == pytest.approx(0.6) and c[0.5].recall == pytest.approx(1.0)
    assert c[0.1].precision == pytest.approx(3 / 7) and c[0.1].recall == pytest.approx(1.0)
    p, r = 2 / 3, 2 / 3
    assert c[0.8].f_measure == pytest.approx(2 * p * r / (p + r))


def test_no_positives(spark):
    c = curve(spark, [(0.3, 0.0), (0.2, 0.0)])
    assert all(v.recall == 0.0 and v.f_measure == 0.0 for v in c.values())


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_sums_independent_of_ranges(spark, ranges):
    df = spark.range(0, 500).select(F.col("id").cast("double").alias("score"),
                                    (F.col("id") % 3).alias("v"))
    run = mt.running_sums(df, "score", ["v"], descending=True, num_ranges=ranges)
    got = {r.score: r.cum_v for r in run.collect()}
    vals = sorted(((float(i), i % 3) for i in range(500)), reverse=True)
    acc, expect = 0, {}
    for s, v in vals:
        acc += v
        expect[s] = acc
    assert got == expect


def test_mse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    assert mt.mean_squared_error(df).first().mse == pytest.approx(0.5)
