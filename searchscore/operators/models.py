"""Regression and clustering on the feature table (Spark ML).

Thin functions over the built-in estimators with explicit seeds (a Python
default seed depends on the process). Tuning fits its candidate models in
parallel (``parallelism``). Every result is a DataFrame: predictions, or a
metrics table with one row per candidate and a ``split`` column saying which
rows the number was measured on.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import binary_label, snap_to_levels
from ..session import cut_lineage
from . import metrics as mt

# The tuning grids and settings of the model runs.
LR_REG_PARAMS = (100.0, 0.1)
LR_FIT_INTERCEPT = (True, False)
LR_ELASTIC_NET = (0.0, 0.5, 1.0)
RF_NUM_TREES = (10, 15, 20, 25)
RF_MAX_DEPTH = (2, 4, 6, 8, 10)
TRAIN_RATIO = 0.6
BINARY_THRESHOLD = 2.0
KMEANS_K = 2
KMEANS_SEED = 1


def _evaluator():
    from pyspark.ml.evaluation import RegressionEvaluator
    return RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="mse")


def _tvs(estimator, grid, seed: int, parallelism: int, train_ratio: float = TRAIN_RATIO):
    from pyspark.ml.tuning import TrainValidationSplit
    return TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid, evaluator=_evaluator(),
                                trainRatio=train_ratio, seed=seed, parallelism=parallelism)


def linear_regression_tuned(train: DataFrame, seed: int = 42, parallelism: int = 4):
    """Linear regression tuned over the 12-point grid (ratio 0.6, mse)."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    lr = LinearRegression(featuresCol="features", labelCol="label")
    grid = (ParamGridBuilder().addGrid(lr.regParam, list(LR_REG_PARAMS))
            .addGrid(lr.fitIntercept, list(LR_FIT_INTERCEPT))
            .addGrid(lr.elasticNetParam, list(LR_ELASTIC_NET)).build())
    return _tvs(lr, grid, seed, parallelism).fit(train)


def moment_matrix(df: DataFrame, features, label: str = "label", by=()) -> DataFrame:
    """(*by, i, j, value) for i <= j: sums over rows of z_i z_j, where z is 1, the features, the label.

    One aggregate with a map-side combine; everything that least squares needs of
    the rows, whatever their number."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label).cast("double")]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = df.groupBy(*by).agg(*[F.sum(z[i] * z[j]).alias(f"m_{i}_{j}") for i, j in pairs])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"m_{i}_{j}").alias("value")) for i, j in pairs])
    return sums.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def solve_linear(m, reg_param: float, elastic_net: float, fit_intercept: bool, sweeps: int = 10_000, tolerance: float = 1e-12):
    """(coefficients, intercept) of the penalised least squares that moment matrix ``m`` (numpy, symmetric) stands for.

    Features and label are scaled by their standard deviation and the penalty is
    reg_param / sd(label), as Spark ML's linear regression has it, so the
    coefficients are the same. Without an L1 part in closed form; else by
    coordinate descent. Constant features get coefficient 0."""
    import numpy as np

    n, d = m[0, 0], m.shape[0] - 2
    mean, second = m[0, 1:] / n, m[1:, 1:] / n
    centred = second - np.outer(mean, mean)
    sd = np.sqrt(np.clip(np.diag(centred), 0.0, None))
    if not sd[d]:
        return np.zeros(d), float(mean[d]) if fit_intercept else 0.0
    live = np.flatnonzero(sd[:d] > 1e-12 * np.maximum(1.0, np.abs(mean[:d])))
    at = np.append(live, d)
    s = (centred if fit_intercept else second)[np.ix_(at, at)] / np.outer(sd[at], sd[at])
    a, b, penalty = s[:-1, :-1], s[:-1, -1], reg_param / sd[d]
    l1, l2 = elastic_net * penalty, (1.0 - elastic_net) * penalty
    if l1 == 0:
        w = np.linalg.lstsq(a + l2 * np.eye(len(live)), b, rcond=None)[0]
    else:
        w = np.zeros(len(live))
        for _ in range(sweeps):
            before = w.copy()
            for j in range(len(w)):
                rest = b[j] - a[j] @ w + a[j, j] * w[j]
                w[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (a[j, j] + l2)
            if np.abs(w - before).max(initial=0.0) < tolerance:
                break
    coefficients = np.zeros(d)
    coefficients[live] = w * sd[d] / sd[live]
    return coefficients, float(mean[d] - coefficients @ mean[:d]) if fit_intercept else 0.0


def mse_of_moments(m, coefficients, intercept: float) -> float:
    """Mean squared error on the rows behind ``m``."""
    import numpy as np

    c = np.concatenate(([intercept], coefficients, [-1.0]))
    return float(max(c @ m @ c, 0.0) / m[0, 0])


def linear_regression_grid(df: DataFrame, features, label: str = "label", split: str = "split",
                           train: str = "train", validation: str = "validation") -> DataFrame:
    """R1-R3 from sufficient statistics: every candidate of the 12-point grid, from one pass over the rows.

    ``split`` names the rows that are fitted and those the candidates are compared
    on. (candidate, reg_param, fit_intercept, elastic_net, mse, intercept,
    coefficients), mse on the validation rows. What reaches the driver are two moment
    matrices of (features + 2)^2 numbers."""
    import numpy as np

    d = len(features) + 2
    moments = {name: np.zeros((d, d)) for name in (train, validation)}
    for r in moment_matrix(df.where(F.col(split).isin(train, validation)), features, label, (split,)).collect():
        moments[r[split]][r["i"], r["j"]] = moments[r[split]][r["j"], r["i"]] = r["value"]
    if not moments[train][0, 0] or not moments[validation][0, 0]:
        raise ValueError("no rows to fit or to compare on")
    rows = []
    for reg in LR_REG_PARAMS:
        for intercept in LR_FIT_INTERCEPT:
            for net in LR_ELASTIC_NET:
                w, b = solve_linear(moments[train], reg, net, intercept)
                rows.append((len(rows), reg, intercept, net, mse_of_moments(moments[validation], w, b), b, [float(x) for x in w]))
    return df.sparkSession.createDataFrame(rows, "candidate int, reg_param double, fit_intercept boolean, elastic_net double, mse double, intercept double, coefficients array<double>")


def random_forest_tuned(train: DataFrame, seed: int = 42, parallelism: int = 4):
    """Random-forest regression tuned over numTrees x maxDepth (20 points)."""
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import ParamGridBuilder

    rf = RandomForestRegressor(featuresCol="features", labelCol="label", seed=seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(RF_NUM_TREES))
            .addGrid(rf.maxDepth, list(RF_MAX_DEPTH)).build())
    return _tvs(rf, grid, seed, parallelism).fit(train)


def gradient_boosted_trees(train: DataFrame, seed: int = 42):
    """Gradient-boosted tree regression with default settings."""
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(featuresCol="features", labelCol="label", seed=seed).fit(train)


def validation_metrics(tuned, spark=None) -> DataFrame:
    """R3 report: (candidate, params, mse, split='validation') per grid point."""
    rows = []
    for i, (pm, m) in enumerate(zip(tuned.getEstimatorParamMaps(), tuned.validationMetrics)):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((i, params, float(m), "validation"))
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "candidate int, params string, mse double, split string")


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def binarize_labels(df: DataFrame, threshold=BINARY_THRESHOLD, label: str = "label") -> DataFrame:
    """T11 + E5: label -> 1.0 above the threshold else 0.0.

    ``threshold="mean"`` uses the mean label as threshold (a scalar subquery).
    """
    if threshold == "mean":
        t = df.select(F.avg(label)).scalar()
        return df.withColumn(label, (F.col(label) > t).cast("double"))
    return df.withColumn(label, binary_label(label, float(threshold)))


def snap_predictions(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Snap predictions to the nearest relevance level."""
    return df.withColumn(col, snap_to_levels(col))


def kmeans_clusters(df: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED,
                    align: bool = True) -> DataFrame:
    """K-means on the feature vectors; adds ``prediction`` (double)."""
    from pyspark.ml.clustering import KMeans
    model = KMeans(k=k, seed=seed, featuresCol="features").fit(df)
    out = model.transform(df).withColumn("prediction", F.col("prediction").cast("double"))
    if align and k == 2:
        out = cut_lineage(out)
    return align_clusters(out) if align and k == 2 else out


def bisecting_kmeans_clusters(df: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED,
                              align: bool = True) -> DataFrame:
    """Bisecting k-means; adds ``prediction`` (double)."""
    from pyspark.ml.clustering import BisectingKMeans
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(df)
    out = model.transform(df).withColumn("prediction", F.col("prediction").cast("double"))
    if align and k == 2:
        out = cut_lineage(out)
    return align_clusters(out) if align and k == 2 else out


def spread_centers(df: DataFrame, features, k: int = KMEANS_K) -> list[list[float]]:
    """``k`` starting centers on a line through the mean, one standard deviation to
    either side of it at the ends; from one aggregate, without a seed. Without rows: none."""
    one = df.where(_usable(features)).agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(f"f{i}") for i, c in enumerate(features)]).first()
    if not len(features) or one[0]["mean"] is None:
        return []
    at = [(2 * j - (k - 1)) / max(k - 1, 1) for j in range(k)]
    return [[f["mean"] + a * f["sd"] for f in one] for a in at]


def _usable(features) -> Column:
    """No feature is NULL or NaN."""
    ok = F.lit(True)
    for c in features:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def assign_to_centers(df: DataFrame, features, centers) -> DataFrame:
    """``df`` with ``prediction`` (int), the nearest center's number (the lower one of
    two equally near), and ``cost``, the squared distance to it. NULL for rows with a
    NULL or NaN feature, and where there are no centers."""
    if not centers:
        return df.withColumns({"prediction": F.lit(None).cast("int"), "cost": F.lit(None).cast("double")})
    square = lambda c, v: (F.col(c).cast("double") - F.lit(v)) * (F.col(c).cast("double") - F.lit(v))
    far = []
    for center in centers:
        total = F.lit(0.0)
        for c, v in zip(features, center):
            total = total + square(c, float(v))
        far.append(F.struct(total.alias("cost"), F.lit(len(far)).alias("no")))
    best = F.when(_usable(features), F.array_min(F.array(*far)))
    return (df.withColumn("_best", best).withColumns({"prediction": F.col("_best.no"), "cost": F.col("_best.cost")}).drop("_best"))


def lloyd_centers(df: DataFrame, features, k: int = KMEANS_K, iterations: int = 20, tolerance: float = 1e-4) -> list[list[float]]:
    """R6 without a seed: k-means centers from ``spread_centers``, the same in any partitioning.

    Each round is one aggregate with a map-side combine; what comes to the driver is a
    count and the feature sums of each of the k clusters. A cluster without rows keeps its
    center. Ends after ``iterations``, or when no center moved by more than ``tolerance``.
    ``df`` is read once a round: pass a stored table or a checkpoint."""
    centers = spread_centers(df, features, k)
    for _ in range(iterations if centers else 0):
        sums = (assign_to_centers(df.select(*features), features, centers).where("prediction is not null")
                .groupBy("prediction").agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(features)]))
        moved = [list(c) for c in centers]
        for r in sums.collect():  # k rows
            moved[r["prediction"]] = [r[f"s{i}"] / r["n"] for i in range(len(features))]
        shift = max(sum((a - b) ** 2 for a, b in zip(x, y)) ** 0.5 for x, y in zip(centers, moved))
        centers = moved
        if shift <= tolerance:
            break
    return centers


def lloyd_clusters(df: DataFrame, features, k: int = KMEANS_K, iterations: int = 20, tolerance: float = 1e-4) -> DataFrame:
    """``df`` with ``prediction`` and ``cost`` under ``lloyd_centers``; all rows stay.
    Values can be checked in SQL, unlike those of a seeded start."""
    rows = cut_lineage(df)
    return assign_to_centers(rows, features, lloyd_centers(rows, features, k, iterations, tolerance))


def align_clusters(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """With two clusters, number the one with the higher mean label 1.

    Cluster numbers are arbitrary; without this the curves may come out inverted.
    Both means come from one aggregate (a scalar subquery each, same scan).
    """
    means = df.agg(F.avg(F.when(F.col(prediction) == 1.0, F.col(label))).alias("m1"),
                   F.avg(F.when(F.col(prediction) == 0.0, F.col(label))).alias("m0"))
    mean1 = means.select("m1").scalar()
    mean0 = means.select("m0").scalar()
    swap = F.coalesce(mean0, F.lit(-1.0)) > F.coalesce(mean1, F.lit(-1.0))
    return df.withColumn(prediction, F.when(swap, F.lit(1.0) - F.col(prediction))
                         .otherwise(F.col(prediction)))


def score_clusters(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Precision, recall and F1 by threshold of cluster number vs binary label."""
    return mt.curves_by_threshold(df, score=prediction, label=label)
