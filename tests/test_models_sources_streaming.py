"""Models (rows and invariants), source round trips, stemming order, streaming."""
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from searchscore.operators import models as md
from searchscore.operators import sampling as sp
from searchscore.plans import full_run as pl
from searchscore.plans import registry as rg
from searchscore.sources import fixtures, read_csv, read_parquet, write_csv, write_parquet
from searchscore.sources.readers import DESCRIPTIONS_SCHEMA, TRAIN_SCHEMA


def test_forest_is_really_a_forest(spark):
    train, test = rg._train_test(spark, SF_SMALL)
    model = md.random_forest_tuned(train, seed=3, parallelism=2)
    assert type(model.bestModel).__name__ == "RandomForestRegressionModel"
    assert len(model.validationMetrics) == 20


def test_fixed_seed_reproducible(spark):
    train, test = rg._train_test(spark, SF_SMALL)
    a = md.gradient_boosted_trees(train, seed=5).transform(test).select("prediction").collect()
    b = md.gradient_boosted_trees(train, seed=5).transform(test).select("prediction").collect()
    assert a == b


def test_clusters_two_and_aligned(spark):
    inp = md.binarize_labels(rg._model_input(spark, SF_SMALL))
    out = md.kmeans_clusters(inp)
    assert {r.prediction for r in out.select("prediction").distinct().collect()} <= {0.0, 1.0}
    means = {r.prediction: r.m for r in out.groupBy("prediction").agg(F.avg("label").alias("m")).collect()}
    if len(means) == 2:
        assert means[1.0] >= means[0.0]


def test_hash_split_disjoint_and_complete(spark):
    train = fixtures(spark, SF_SMALL)[0]
    parts = sp.split(train, (0.9, 0.1))
    n = train.count()
    assert sum(p.count() for p in parts) == n
    assert parts[0].join(parts[1], "id").count() == 0


def test_hash_sample_independent_of_partitioning(spark):
    train = fixtures(spark, SF_SMALL)[0]
    a = {r.id for r in sp.sample(train.repartition(3), 0.1).select("id").collect()}
    b = {r.id for r in sp.sample(train.repartition(7), 0.1).select("id").collect()}
    assert a == b and len(a) > 0


def test_csv_and_parquet_round_trip(spark, tmpdir_path):
    train = fixtures(spark, SF_SMALL)[0]
    csv_path = os.path.join(tmpdir_path, "train_csv")
    write_csv(train, csv_path)
    back = read_csv(spark, csv_path, TRAIN_SCHEMA, null_value="\\N")
    assert back.schema == TRAIN_SCHEMA
    assert back.exceptAll(train).count() == 0 and train.exceptAll(back).count() == 0
    pq = os.path.join(tmpdir_path, "train_pq")
    write_parquet(train, pq)
    assert read_parquet(spark, pq).exceptAll(train).count() == 0


def test_stemming_before_merge_equals_reference_order(spark):
    a = pl.feature_table(*fixtures(spark, SF_SMALL), with_cosine=False)
    b = pl.feature_table_reference_order(*fixtures(spark, SF_SMALL), with_cosine=False)
    cols = sorted(a.columns)
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_streaming_features_equal_batch(spark, tmpdir_path):
    from searchscore.streaming import feature_stream, write_feature_stream
    train, desc, attrs = fixtures(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "pairs")
    train.write.parquet(src)
    stream = spark.readStream.schema(TRAIN_SCHEMA).parquet(src)
    out = os.path.join(tmpdir_path, "scored")
    q = write_feature_stream(feature_stream(stream, desc, attrs), out,
                             os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    batch = pl.feature_table(train, desc, attrs, with_cosine=False).select(*got.columns)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_full_run_from_csv(spark, tmpdir_path):
    train, desc, attrs = fixtures(spark, SF_SMALL)
    paths = []
    for name, df in (("train", train), ("desc", desc), ("attrs", attrs)):
        p = os.path.join(tmpdir_path, name)
        write_csv(df, p)
        paths.append(p)
    # the \N marker keeps empty strings apart from NULL in CSV
    out = pl.run_relevance(spark, *paths, fmt="csv", fit_forest=False, parallelism=2,
                           csv_null_value="\\N", csv_multi_line=True)  # descriptions span lines
    assert read_csv(spark, paths[1], DESCRIPTIONS_SCHEMA, null_value="\\N", multi_line=True).exceptAll(desc).count() == 0
    mm = {(r.model, r.split): r.mse for r in out["model_metrics"].collect()}
    assert ("linear_regression", "test") in mm and ("gbt", "test") in mm
    v = out["validity"].first()
    assert v.n_pairs == train.count() and v.n_valid + v.n_dropped == v.n_pairs
    assert {r.model for r in out["cluster_curves"].select("model").distinct().collect()} == {
        "kmeans", "bisecting_kmeans"}


def test_fill_missing_keeps_pairs(spark):
    from searchscore.plans import features as ft
    feats = rg._feat(spark, SF_SMALL)
    dropped = ft.model_table(feats).count()
    filled = ft.model_table(feats, fill_missing={"levenshtein_dist_description": -1,
                                                 "levenshtein_dist_attr": -1}).count()
    rep = ft.validity_report(feats).first()
    assert rep.n_valid == dropped and filled >= dropped


def test_bernoulli_modes(spark):
    train = fixtures(spark, SF_SMALL)[0]
    n = train.count()
    s = sp.sample(train, 0.1, mode="bernoulli", seed=323)
    assert 0 < s.count() < n
    parts = sp.split(train, (0.9, 0.1), mode="bernoulli", seed=12345)
    assert sum(p.count() for p in parts) == n
    assert sp.preview(train, 5).count() == 5
    ordered = [r.product_uid for r in sp.sort_by(train, "product_uid").select("product_uid").collect()]
    assert ordered == sorted(ordered)
