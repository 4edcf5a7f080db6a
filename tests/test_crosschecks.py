"""Cross-checks against Spark's own implementations and simple properties."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from searchscore.operators import metrics as mt
from searchscore.operators import models as md
from searchscore.operators import similarity as sim
from searchscore.plans import features as ft
from searchscore.plans import registry as rg


def test_curve_counts_match_mllib_roc(spark):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics
    scored = rg._order_scores(spark, SF_SMALL, bucketed=False)
    c = sorted(mt.confusion_by_threshold(scored).collect(), key=lambda r: -r.threshold)
    pos = c[0].positives
    neg = scored.count() - pos
    pts = [(0.0, 0.0)] + [(r.fp / neg, r.tp / pos) for r in c] + [(1.0, 1.0)]
    auc = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    expected = BinaryClassificationMetrics(scored.select("score", "label").rdd.map(tuple)).areaUnderROC
    assert auc == pytest.approx(expected, abs=1e-9)


def test_validity_filter_equals_assembler_skip(spark):
    from pyspark.ml.feature import VectorAssembler
    feats = rg._feat(spark, SF_SMALL)
    ours = ft.model_table(feats).count()
    va = VectorAssembler(inputCols=list(ft.MODEL_FEATURES), outputCol="v", handleInvalid="skip")
    theirs = va.transform(feats.select(*ft.MODEL_FEATURES)).count()
    assert ours == theirs


def test_dimsum_threshold_zero_equals_exact(spark):
    from pyspark.ml.linalg import Vectors
    rows = [[1.0, 0.0, 2.0, 0.0], [0.0, 3.0, 1.0, 1.0], [2.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 4.0]]
    vec = spark.createDataFrame([(Vectors.sparse(4, {j: v for j, v in enumerate(r) if v}),)
                                 for r in rows], ["v"])
    dims = {(r.i, r.j): r.similarity for r in sim.term_similarity_dimsum(vec, "v", 0.0).collect()}
    entries = spark.createDataFrame([(i, str(j), v) for i, r in enumerate(rows)
                                     for j, v in enumerate(r) if v != 0.0],
                                    "id long, term string, value double")
    exact = {(int(r.term_a), int(r.term_b)): r.similarity for r in sim.term_similarity(entries).collect()}
    assert set(dims) == set(exact)
    for k, v in exact.items():
        assert dims[k] == pytest.approx(v, abs=1e-9)


def test_common_words_bounded_by_query_words(spark):
    feats = rg._feat(spark, SF_SMALL)
    from searchscore.functions import text as tx
    nq = F.size(tx.words("stemmed_search_term"))
    bad = feats.where(F.col("stemmed_search_term").isNotNull() & (
        (F.col("commonWords_term_title") > nq) | (F.col("commonWords_term_description") > nq)
        | (F.col("commonWords_term_attr") > nq))).count()
    assert bad == 0


def test_linear_regression_beats_constant_mean(spark):
    train, test = rg._train_test(spark, SF_SMALL)
    model = md.linear_regression_tuned(train, seed=1, parallelism=2)
    mse = mt.mean_squared_error(model.transform(test)).first().mse
    mean = train.agg(F.avg("label")).first()[0]
    base = mt.mean_squared_error(test.withColumn("prediction", F.lit(mean))).first().mse
    assert mse <= base * 1.05


def test_minhash_recall_in_range(spark):
    pre = rg._pre(spark, SF_SMALL)
    exact = sim.jaccard_pairs(pre, "stemmed_search_term", 0.8)
    approx = sim.minhash_pairs(pre, "stemmed_search_term", 0.8, seed=1)
    r = sim.minhash_recall(exact, approx).first()
    assert r.n_exact == exact.count()
    assert 0.0 <= r.recall <= 1.0 and r.n_found <= r.n_exact
