"""k-means without a seed: against plain Python, other partitionings, missing values and empty tables."""
import random

import pytest

from searchscore.operators import models as md


def points(seed=3, n=300):
    r = random.Random(seed)
    middles = [(0.0, 0.0), (9.0, 1.0), (4.0, 12.0)]
    return [(i, *(m + r.gauss(0, 1) for m in middles[i % 3])) for i in range(n)]


def slow_lloyd(rows, k, rounds):
    n, xs = len(rows), [r[1:] for r in rows]
    mean = [sum(x[f] for x in xs) / n for f in range(2)]
    sd = [(sum((x[f] - mean[f]) ** 2 for x in xs) / n) ** 0.5 for f in range(2)]
    centers = [[mean[f] + (2 * j - (k - 1)) / max(k - 1, 1) * sd[f] for f in range(2)] for j in range(k)]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min(range(k), key=lambda j: (far(x, centers[j]), j))
    for _ in range(rounds):
        groups = [[x for x in xs if nearest(x) == j] for j in range(k)]
        centers = [[sum(x[f] for x in g) / len(g) for f in range(2)] if g else c for g, c in zip(groups, centers)]
    return {r[0]: nearest(r[1:]) for r in rows}, centers


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_against_plain_python(spark, k):
    rows = points()
    want, centers = slow_lloyd(rows, k, 6)
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "id int, a double, b double").repartition(parts)
        got = md.lloyd_clusters(df, ["a", "b"], k, iterations=6, tolerance=0.0).collect()
        assert {r["id"]: r["prediction"] for r in got} == want
        for x, y in zip(md.lloyd_centers(df, ["a", "b"], k, 6, 0.0), centers):
            assert x == pytest.approx(y, abs=1e-9)


def test_cost_equals_the_estimator(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(points(), "id int, a double, b double")
    own = sum(r["cost"] for r in md.lloyd_clusters(df, ["a", "b"], 3).collect())
    model = KMeans(k=3, seed=1).fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    assert own == pytest.approx(model.summary.trainingCost, rel=1e-3)


def test_missing_values_ties_and_empty_tables(spark):
    rows = [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 4.0, 0.0), (4, None, 1.0), (5, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    got = {r["id"]: r["prediction"] for r in md.lloyd_clusters(df, ["a", "b"], 2).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: None, 5: None}
    same = spark.createDataFrame([(i, 1.0, 1.0) for i in range(4)], "id int, a double, b double")
    assert {r["prediction"] for r in md.lloyd_clusters(same, ["a", "b"], 3).collect()} == {0}
    assert md.lloyd_clusters(df.limit(0), ["a", "b"]).collect() == []
    assert [r["prediction"] for r in md.lloyd_clusters(df.where("id = 4"), ["a", "b"]).collect()] == [None]
