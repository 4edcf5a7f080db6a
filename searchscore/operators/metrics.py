"""Precision, recall and F-measure by threshold; mean squared error.

The curves follow the binary-classification metrics of Spark MLlib: every
distinct score is a threshold (highest first), a row counts as positive when
its label is above 0.5, and at threshold t

  TP = positives with score >= t, FP = negatives with score >= t,
  precision = TP / (TP + FP)   (1 when nothing is predicted positive)
  recall    = TP / P           (0 when there are no positives)
  F(beta)   = (1 + beta^2) p r / (beta^2 p + r)   (0 when p + r = 0)

Plan: the scored rows are first aggregated to one row per distinct score
(partial aggregation, one shuffle). The running sums over scores (W1) are a
distributed prefix sum: scores are cut into ranges at quantiles, each range is
summed locally in its own window, and the totals of the earlier ranges (one row
per range, a handful of rows) are added as an offset. No window ever spans the
whole table, so even billions of distinct scores stay spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Ranges of a running sum at most; each is one sorted task.
MAX_RANGES = 256


def score_counts(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, pos, neg) per distinct score."""
    pos = F.col(label) > F.lit(0.5)
    return (df.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum(pos.cast("long")).alias("pos"), F.sum((~pos).cast("long")).alias("neg")))


def running_sums(df: DataFrame, order: str, cols, descending: bool = True,
                 num_ranges: int | None = None, totals: bool = False) -> DataFrame:
    """cum_<c> = sum of c over rows whose ``order`` value comes first
    (ties of ``order`` must be pre-aggregated; each value appears once).

    ``order`` is numeric. Range bounds are approximate quantiles of ``order``,
    taken first; a row's range follows from its value and these bounds alone, so
    ranges and their totals agree under any plan and on any retry. NULL comes
    last when descending and first when ascending, NaN counts as the largest.
    ``totals`` adds total_<c>, the sum over all rows, from the range totals.
    """
    n = num_ranges or min(MAX_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    v = F.col(order).cast("double")
    cuts = df.where(~F.isnan(v)).agg(F.percentile_approx(v, [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(cuts or []))
    up = F.when(v.isNull(), F.lit(-1)).when(F.isnan(v), F.lit(len(bounds) + 1)) \
        .otherwise(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < v)) if bounds else F.lit(0))
    o = F.col(order).desc() if descending else F.col(order).asc()
    ranged = df.withColumn("_range", -up if descending else up)
    local_w = (Window.partitionBy("_range").orderBy(o)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({f"_loc_{c}": F.sum(c).over(local_w) for c in cols})
    sums = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    # At most MAX_RANGES + 2 rows: the offset is the sum of all earlier ranges.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = sums.select("_range", *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in cols],
                          *[F.sum(f"_tot_{c}").over(whole).alias(f"total_{c}") for c in cols if totals])
    out = local.join(F.broadcast(offsets), "_range")
    return out.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in cols],
                      *[f"total_{c}" for c in cols if totals])


def confusion_by_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, tp, fp, positives) for each distinct score.

    The counts per score are read several times (bounds, sums, offsets), so they
    are kept in the shared checkpoint folder: the rows are scanned once."""
    counts = cut_lineage(score_counts(df, score, label))
    run = running_sums(counts, "score", ["pos", "neg"], descending=True, totals=True)
    return run.select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"),
                      F.col("cum_neg").alias("fp"), F.coalesce("total_pos", F.lit(0)).alias("positives"))


def _precision():
    tpfp = F.col("tp") + F.col("fp")
    return F.when(tpfp == 0, F.lit(1.0)).otherwise(F.col("tp") / tpfp)


def _recall():
    return F.when(F.col("positives") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("positives"))


def precision_by_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, precision)."""
    return confusion_by_threshold(df, score, label).select("threshold", _precision().alias("precision"))


def recall_by_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, recall)."""
    return confusion_by_threshold(df, score, label).select("threshold", _recall().alias("recall"))


def f_measure_by_threshold(df: DataFrame, score: str = "score", label: str = "label",
                           beta: float = 1.0) -> DataFrame:
    """A5: (threshold, f_measure) with the given beta (1 = F1)."""
    c = confusion_by_threshold(df, score, label).select("threshold", _precision().alias("p"),
                                                         _recall().alias("r"))
    b2 = beta * beta
    f = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)).otherwise(
        (1.0 + b2) * F.col("p") * F.col("r") / (b2 * F.col("p") + F.col("r")))
    return c.select("threshold", f.alias("f_measure"))


def curves_by_threshold(df: DataFrame, score: str = "score", label: str = "label",
                        beta: float = 1.0) -> DataFrame:
    """A5-A7 in one table: (threshold, precision, recall, f_measure)."""
    c = confusion_by_threshold(df, score, label).select("threshold", _precision().alias("precision"),
                                                         _recall().alias("recall"))
    b2 = beta * beta
    p, r = F.col("precision"), F.col("recall")
    return c.withColumn("f_measure", F.when(p + r == 0, F.lit(0.0))
                        .otherwise((1.0 + b2) * p * r / (b2 * p + r)))


def binned_curves(df: DataFrame, score: str = "score", label: str = "label", bins: int = 100,
                  accuracy: int = 100_000, beta: float = 1.0) -> DataFrame:
    """A5-A7 at a bounded number of thresholds, for scores that are nearly all distinct.

    Thresholds are quantiles from a mergeable sketch (``percentile_approx``), each
    off by at most 1 / ``accuracy`` of the rows in rank; NaN scores count as the
    largest threshold of their own. Rows are then counted exactly at every
    threshold, so each point lies on the exact curve, and two neighbouring points
    are no more than 1 / ``bins`` + 2 / ``accuracy`` of the rows apart, ties aside.
    Shuffled are ``bins`` counts a task, not a row a score. Columns as
    ``curves_by_threshold``; a null score counts nowhere but among the positives."""
    v = F.col(score).cast("double")
    cuts = df.where(v.isNotNull() & ~F.isnan(v)).agg(F.percentile_approx(v, [i / bins for i in range(bins)], accuracy)).first()[0]
    bounds = sorted(set(cuts or []))
    inside = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    # the largest bound that is not above the score; the lowest one takes what lies below it by the sketch's error
    at = F.when(F.isnan(v), v).when(v.isNotNull(), F.greatest(F.array_max(F.filter(inside, lambda b: b <= v)), F.lit(bounds[0] if bounds else None).cast("double")))
    return curves_by_threshold(df.select(at.alias("score"), F.col(label).alias("label")), "score", "label", beta).where("threshold is not null")


def mean_squared_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with the mean of (label - prediction)^2."""
    return df.agg(F.avg((F.col(label) - F.col(prediction)) ** 2).alias("mse"))
