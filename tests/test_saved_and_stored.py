"""Bucketed tables, hot products, rejected lines, binned curves, saved runs."""
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from searchscore.operators import merge as mg
from searchscore.operators import metrics as mt
from searchscore.operators import tfidf as tfm
from searchscore.plans import features as ft
from searchscore.plans import registry as rg
from searchscore.plans import saved_run as sr
from searchscore.sources import bucketed as bk
from searchscore.sources import fixtures
from searchscore.sources import readers as rd
from test_skew import conf


def test_merge_from_buckets_moves_nothing(spark, tmpdir_path):
    train, desc, attrs = fixtures(spark, SF_SMALL)
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pairs, products = bk.bucket_sources(train, desc, attrs, f"t_{uuid.uuid4().hex}", buckets=8, folder=tmpdir_path)
        merged = bk.merge_bucketed(pairs, products)
        rows = merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(map(str, rows)) == sorted(map(str, mg.merge_sources(train, desc, attrs).collect()))
    assert len([f for f in os.listdir(os.path.join(tmpdir_path, [d for d in os.listdir(tmpdir_path) if d.endswith("_pairs")][0])) if f.endswith(".parquet")]) <= 8


def test_hot_product_is_sorted_in_many_tasks(spark):
    rows = [(7, f"name{i % 50:02d}", f"value {i * 37 % 1000}") for i in range(3_000)] + [(i, "Brand", f"b{i}") for i in range(100, 200)] + [(None, "x", "y"), (8, None, None), (9, "a", None)]
    rows += [(10, "same", "text")] * 500
    df = spark.createDataFrame(rows, "product_uid long, name string, value string")
    want = {r[0]: r[1] for r in mg.flatten_attributes(df).collect()}
    assert {r[0]: r[1] for r in mg.flatten_attributes_by_ranges(df, ranges=12).collect()} == want
    parts = df.select("product_uid", F.concat_ws(" ", "name", "value").alias("_nv")).repartitionByRange(12, "product_uid", "_nv")
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2] + 500  # equal texts are one row in the operator


def test_broken_lines_are_kept_apart(spark, tmpdir_path):
    lines = ["id,product_uid,product_title,search_term,relevance", '1,2,"a ""quoted"", title",q,2.0', "x3,2,t,q,1.0", "4,2,t,q", "5,2,t,q,1.0,more", "6,,\\N,,", '7,8,"open,q,1', "9,9,t,q,3"]
    path = os.path.join(tmpdir_path, "train.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    rows = rd.read_csv_with_rejects(spark, path, rd.TRAIN_SCHEMA, null_value="\\N")
    good, bad = rd.good_rows(rows), rd.rejected_lines(rows)
    assert good.columns == rd.TRAIN_SCHEMA.names
    kept = {r["id"]: tuple(r) for r in good.collect()}
    assert kept[1] == (1, 2, 'a "quoted", title', "q", "2.0") and kept[6][2] is None and 9 in kept
    lost = {r["line"].split(",")[0] for r in bad.collect()}
    assert {"x3", "4", "5"} <= lost and not lost & {str(k) for k in kept}
    # one column alone is asked for: the line is still told by all of its fields
    assert sorted(r[0] for r in good.select("product_title").collect() if r[0] is not None) == sorted(v[2] for v in kept.values() if v[2] is not None)
    report = rd.reject_report(rows).first()
    assert report["n_lines"] == len(lines) - 1 and report["n_rejected"] == bad.count() == report["n_lines"] - good.count()


def test_binned_curve_lies_on_the_exact_one(spark):
    df = spark.range(5_000).select((F.abs(F.xxhash64("id")) % 100_003 / 7).alias("score"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    exact = {r["threshold"]: tuple(r) for r in mt.curves_by_threshold(df).collect()}
    binned = [tuple(r) for r in mt.binned_curves(df, bins=20).collect()]
    assert 18 <= len(binned) <= 20 and all(exact[r[0]] == r for r in binned)
    rank = sorted(exact)
    places = sorted(rank.index(r[0]) for r in binned)
    assert max(b - a for a, b in zip(places, places[1:])) <= len(rank) * (1 / 20 + 0.01)


def test_binned_curve_edge_cases(spark):
    rows = [(float("nan"), 1.0), (1.0, 0.0), (1.0, 1.0), (None, 1.0), (2.0, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    got = {str(r["threshold"]): r["recall"] for r in mt.binned_curves(df, bins=4).collect()}
    assert got == {"nan": 0.25, "2.0": 0.5, "1.0": 0.75}
    assert mt.binned_curves(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def saved(spark):
    import tempfile
    pairs = rg._train_pre(spark, SF_SMALL).withColumn("split", F.when(F.col("id") % 10 == 0, "test").otherwise("train")).checkpoint()
    path = tempfile.mkdtemp(prefix="ss-run-")
    feats = rg._grid_rows(spark, SF_SMALL).checkpoint()
    return pairs, feats, path, sr.fit_run(pairs.where("split = 'train'"), feats, ft.MODEL_FEATURES, path, "v1")


def test_saved_run_scores_as_fitted(spark, saved):
    pairs, _, path, _ = saved
    run = sr.load_run(spark, path, "v1")
    test = pairs.where("split = 'test'")
    got = {r[0]: r[1] for r in run.cosine(test).collect()}
    assert len(got) == test.count()
    # the training pairs are scored as by the form that fits and transforms in one go
    train = pairs.where("split = 'train'")
    one = {r[0]: r[1] for r in tfm.title_term_cosine(train).collect()}
    two = {r[0]: r[1] for r in run.cosine(train).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)
    unknown = spark.createDataFrame([(1, "zzz yyy", "zzz"), (2, None, "")], "id long, stemmed_product_title string, stemmed_search_term string")
    assert {r[0]: r[1] for r in run.cosine(unknown).collect()} == {1: 0.0, 2: 0.0}


def test_saved_run_predicts(spark, saved):
    _, feats, _, run = saved
    best = run.linear.orderBy("mse", "candidate").first()
    other = run.predict(feats.where("split = 'validation'"))
    mse = other.agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(best["mse"], abs=1e-9)


def test_versions_are_kept_apart(spark, saved):
    pairs, feats, path, _ = saved
    run = sr.fit_run(pairs.limit(50), feats, ft.MODEL_FEATURES, path, "v2")
    assert run.idf.count() < sr.load_run(spark, path, "v1").idf.count()
    with pytest.raises(Exception):
        sr.fit_run(pairs, feats, ft.MODEL_FEATURES, path, "v2")


def test_stream_equals_batch(spark, saved, tmpdir_path):
    pairs, _, _, run = saved
    test = pairs.where("split = 'test'").select("id", "stemmed_product_title", "stemmed_search_term")
    test.repartition(3).write.parquet(f"{tmpdir_path}/in")
    stream = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in")
    sr.score_stream(stream, run, f"{tmpdir_path}/out", f"{tmpdir_path}/log").awaitTermination(120)
    out = spark.read.parquet(f"{tmpdir_path}/out")
    assert out.select("batch").distinct().count() == 3
    assert {r[0]: round(r[1], 9) for r in out.select("id", "title_term_similarity").collect()} == {r[0]: round(r[1], 9) for r in run.cosine(test).collect()}
