"""Registered queries: Spark builders and the equivalent DuckDB SQL.

Each Spark builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole derived tables. The oracle texts compute the same columns with the same
names and types in DuckDB, starting from the shared fixture SQL. Doubles that
come out of sums of products are rounded to 6 digits on both sides.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import cleaning as cl
from ..functions import text as tx
from ..operators import merge as mg
from ..operators import metrics as mt
from ..operators import models as md
from ..operators import sampling as sp
from ..operators import similarity as sim
from ..operators import tfidf as tfm
from ..session import cut_lineage
from ..sources.fixtures import cte, fixture, fixtures
from . import features as ft
from .full_run import feature_table

R = 6  # rounding digits for double results

# ---------------------------------------------------------------- Spark side


def _merged(spark, sf_dir):
    return mg.merge_sources(*fixtures(spark, sf_dir))


def _pre(spark, sf_dir):
    return ft.preprocess(_merged(spark, sf_dir), stemmer="none")


def _train_pre(spark, sf_dir):
    """The pairs alone, for what needs titles and queries only: no product text is read."""
    low = fixture(spark, sf_dir, "train").withColumns({c: F.lower(c) for c in ("product_title", "search_term")})
    return low.withColumns({"stemmed_product_title": F.col("product_title"), "stemmed_search_term": F.col("search_term")})


def _feat(spark, sf_dir, separator_aware=True):
    """Features of every pair; lower-casing and the product texts' spaced forms are made per product, before the merge."""
    return feature_table(*fixtures(spark, sf_dir), stemmer="none", with_cosine=False, separator_aware=separator_aware)


def q_merge_left(spark, sf_dir):
    return _merged(spark, sf_dir)


def q_attr_group_concat(spark, sf_dir):
    return mg.flatten_attributes(fixture(spark, sf_dir, "attributes"))


def q_lower_project(spark, sf_dir):
    return mg.lower_text(_merged(spark, sf_dir))


def q_rename_drop(spark, sf_dir):
    return mg.rename_stemmed(mg.drop_raw_text(_pre(spark, sf_dir)))


def q_relevance_cast(spark, sf_dir):
    return mg.relevance_to_double(fixture(spark, sf_dir, "train")).select("id", "relevance")


def q_tokenize_ws(spark, sf_dir):
    toks = tx.tokenize_ws("product_title")
    return (_merged(spark, sf_dir)
            .select("id", F.size(toks).alias("n_tokens"), F.array_join(toks, "|").alias("tokens")))


def q_levenshtein_all(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "levenshtein_dist_description",
                                       "levenshtein_dist_title", "levenshtein_dist_attr")


def q_len_query(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "len_of_query")


def q_len_num_attr(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "len_of_attr", "num_of_attr")


def q_common_words_all(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "commonWords_term_title",
                                       "commonWords_term_description", "commonWords_term_attr")


def q_common_words_raw(spark, sf_dir):
    return _feat(spark, sf_dir, separator_aware=False).select(
        "id", "commonWords_term_title", "commonWords_term_description", "commonWords_term_attr")


def q_ratio_all(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "ratio_title", "ratio_description", "ratio_attr")


def q_features_valid(spark, sf_dir):
    return ft.model_table(_feat(spark, sf_dir))


def q_binary_label(spark, sf_dir):
    tr = mg.relevance_to_double(fixture(spark, sf_dir, "train"))
    return tr.select("id", F.col("relevance").alias("label"),
                     tx.binary_label("relevance", 2.0).alias("binary_label"))


def q_source_counts(spark, sf_dir):
    train, desc, attrs = fixtures(spark, sf_dir)
    parts = [(n, d) for n, d in (("train", train), ("product_descriptions", desc),
                                  ("attributes", attrs), ("merged", mg.merge_sources(train, desc, attrs)))]
    out = None
    for name, d in parts:
        one = d.agg(F.count("*").cast("long").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_sort_by_uid(spark, sf_dir):
    return _merged(spark, sf_dir).select("product_uid", "id").orderBy("product_uid", "id")


def _tfidf_field(spark, sf_dir, name):
    return tfm.tfidf_long(_train_pre(spark, sf_dir), {name: {"title": "stemmed_product_title", "term": "stemmed_search_term"}[name]})


def _rounded_weights(w):
    return w.select("id", "token", "tf", F.round("idf", R).alias("idf"), F.round("weight", R).alias("tfidf"))


def q_tfidf_title(spark, sf_dir):
    return _rounded_weights(_tfidf_field(spark, sf_dir, "title"))


def q_tfidf_term(spark, sf_dir):
    return _rounded_weights(_tfidf_field(spark, sf_dir, "term"))


def q_tfidf_description(spark, sf_dir):
    train, descriptions, _ = fixtures(spark, sf_dir)
    summ = tfm.tfidf_summary_by_product(train, descriptions.withColumn("product_description", F.lower("product_description")), "product_description")
    return summ.select("id", "n_terms", "n_tokens", F.round("sum_tfidf", R).alias("sum_tfidf"),
                       F.round("l2_norm", R).alias("l2_norm"))


def q_idf(spark, sf_dir):
    pre = _train_pre(spark, sf_dir)
    tf = tfm.term_frequency(tfm.token_table(pre, {"title": "stemmed_product_title",
                                                  "term": "stemmed_search_term"}))
    idf = tfm.fit_idf(tf, tfm.document_count(pre))
    return idf.select("field", "token", "df", F.round("idf", R).alias("idf"))


def q_tf_exact(spark, sf_dir):
    pre = _train_pre(spark, sf_dir)
    return tfm.term_frequency(tfm.token_table(pre, {"title": "stemmed_product_title",
                                                    "term": "stemmed_search_term"}))


def q_cosine_title_term(spark, sf_dir):
    cos = tfm.title_term_cosine(_train_pre(spark, sf_dir))
    return cos.select("id", F.round("title_term_similarity", R).alias("title_term_similarity"))


def q_jaccard_exact_pairs(spark, sf_dir):
    pairs = sim.jaccard_pairs(_train_pre(spark, sf_dir), "stemmed_search_term", max_distance=0.8)
    return pairs.select("set_a", "set_b", "n_rows_a", "n_rows_b", "intersection",
                        F.round("jaccard_distance", R).alias("jaccard_distance"),
                        F.round("jaccard_similarity", R).alias("jaccard_similarity"))


def q_jaccard_raw_pairs(spark, sf_dir):
    pairs = sim.jaccard_pairs(_train_pre(spark, sf_dir), "stemmed_search_term", max_distance=0.5,
                              include_self_and_mirror=True)
    return pairs.select("set_a", "set_b", F.round("jaccard_distance", R).alias("jaccard_distance"))


def q_minhash_pairs(spark, sf_dir):
    pairs = sim.minhash_pairs(_train_pre(spark, sf_dir), "stemmed_search_term", max_distance=0.8)
    return pairs.select("set_a", "set_b", F.round("jaccard_distance", R).alias("jaccard_distance"),
                        F.round("jaccard_similarity", R).alias("jaccard_similarity"))


def q_minhash_recall(spark, sf_dir):
    """Share of all pairs of titles within distance 0.5 that banding finds."""
    pre = _train_pre(spark, sf_dir)
    exact = sim.jaccard_pairs(pre, "stemmed_product_title", max_distance=0.5)
    approx = sim.minhash_pairs(pre, "stemmed_product_title", max_distance=0.5, rows=2)
    return sim.minhash_recall(exact, approx).withColumn("recall", F.round("recall", R))


def _title_term_entries(spark, sf_dir):
    pre = _train_pre(spark, sf_dir)
    tf = tfm.term_frequency(tfm.token_table(pre, {"title": "stemmed_product_title",
                                                  "term": "stemmed_search_term"}))
    return sim.concat_fields(tf, value="tf")


def q_term_similarity_exact(spark, sf_dir):
    out = sim.term_similarity(_title_term_entries(spark, sf_dir))
    return out.select("term_a", "term_b", F.round("similarity", R).alias("similarity"))


def q_term_similarity_dimsum(spark, sf_dir):
    out = sim.term_similarity_sampled(_title_term_entries(spark, sf_dir), threshold=0.1, min_similarity=0.1)
    return out.select("term_a", "term_b", F.round("similarity", R).alias("similarity"))


def q_dimsum_error(spark, sf_dir):
    """How many of the pairs of similarity 0.1 are estimated within four standard errors."""
    entries = _title_term_entries(spark, sf_dir)
    gamma = sim.sampling_gamma(entries.select("term").distinct().count(), 0.1)
    return sim.sampling_error(sim.term_similarity(entries), sim.term_similarity_sampled(entries, 0.1), gamma).withColumn("inside", F.round("inside", R))


def q_tf_hashed(spark, sf_dir):
    pre = _train_pre(spark, sf_dir)
    tf = tfm.term_frequency(tfm.token_table(pre, {"title": "stemmed_product_title", "term": "stemmed_search_term"}))
    return tfm.hashed_term_frequency(tf)


def q_tf_hashed_narrow(spark, sf_dir):
    """Eight slots only, so that most tokens share theirs."""
    pre = _train_pre(spark, sf_dir)
    tf = tfm.term_frequency(tfm.token_table(pre, {"title": "stemmed_product_title"}))
    return tfm.hashed_term_frequency(tf, 8)


def q_stem_terms(spark, sf_dir):
    from ..operators.stemming import stem_vocabulary
    return stem_vocabulary(_merged(spark, sf_dir),
                           ["product_title", "search_term", "product_description", "attributes"])


def q_features_stemmed(spark, sf_dir):
    from .full_run import flagship
    return flagship(spark, sf_dir, stemmer="porter2")


def q_hash_sample(spark, sf_dir):
    return sp.sample(fixture(spark, sf_dir, "train"), 0.1, key="id").select("id", "product_uid")


def q_hash_split(spark, sf_dir):
    return sp.with_split(fixture(spark, sf_dir, "train"), (0.9, 0.1), ("train", "test"),
                         key="id").select("id", "split")


def _fixed_predictions(spark, sf_dir):
    tr = fixture(spark, sf_dir, "train")
    return tr.select("id", F.col("relevance").cast("double").alias("label"),
                     (F.lit(1.0) + (F.col("product_uid") % 21) / 10.0).alias("prediction"))


def q_mse_fixed(spark, sf_dir):
    return mt.mean_squared_error(_fixed_predictions(spark, sf_dir)).select(F.round("mse", R).alias("mse"))


def _order_scores(spark, sf_dir, bucketed=True):
    from ..sources.fixtures import base_table
    o = base_table(spark, sf_dir, "orders")
    score = F.floor(F.col("o_totalprice") / 20000).cast("double") if bucketed else F.col("o_totalprice")
    return o.select(score.alias("score"), (F.col("o_orderstatus") == "F").cast("double").alias("label"))


def _round_curve(c, *cols):
    return c.select("threshold", *[F.round(x, R).alias(x) for x in cols])


def q_pr_curve_fixed(spark, sf_dir):
    c = mt.curves_by_threshold(_order_scores(spark, sf_dir))
    return _round_curve(c, "precision", "recall")


def q_f1_curve_fixed(spark, sf_dir):
    return _round_curve(mt.f_measure_by_threshold(_order_scores(spark, sf_dir)), "f_measure")


def q_pr_curve_all_scores(spark, sf_dir):
    c = mt.curves_by_threshold(_order_scores(spark, sf_dir, bucketed=False))
    return _round_curve(c, "precision", "recall", "f_measure")


def q_pr_curve_binned(spark, sf_dir):
    c = mt.binned_curves(_order_scores(spark, sf_dir, bucketed=False), bins=100)
    return _round_curve(c, "precision", "recall", "f_measure")


def q_merge_from_buckets(spark, sf_dir):
    from ..sources import bucketed as bk
    prefix, folder = bk.scratch_name(spark)
    return bk.merge_bucketed(*bk.bucket_sources(*fixtures(spark, sf_dir), prefix, buckets=16, folder=folder))


def q_attr_group_concat_ranges(spark, sf_dir):
    return mg.flatten_attributes_by_ranges(fixture(spark, sf_dir, "attributes"))


def q_csv_rejects(spark, sf_dir):
    """Pairs through CSV, every fiftieth with a broken id: which lines come back, and which are rejected."""
    from ..session import checkpoint_dir
    from ..sources import readers as rd
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    broken = F.when(F.col("id") % 50 == 0, F.concat(F.lit("x"), F.col("id"))).otherwise(F.col("id").cast("string"))
    rd.write_csv(fixture(spark, sf_dir, "train").withColumn("id", broken).select(*rd.TRAIN_SCHEMA.names), path)
    rows = rd.read_csv_with_rejects(spark, path, rd.TRAIN_SCHEMA, null_value="\\N")
    good = rd.good_rows(rows).select("id", "product_uid", "product_title", "search_term", "relevance", F.lit(False).alias("rejected"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("product_uid", "long"), ("product_title", "string"), ("search_term", "string"), ("relevance", "string"))]
    bad = rd.rejected_lines(rows).select(F.regexp_extract("line", r"^x(\d+),", 1).cast("long").alias("id"), *none, F.lit(True).alias("rejected"))
    return good.unionByName(bad)


def q_cosine_saved_idf(spark, sf_dir):
    """Test pairs scored with the saved IDF of the training pairs."""
    from ..session import checkpoint_dir
    from . import saved_run as sr
    pairs = sp.with_split(_train_pre(spark, sf_dir), (0.9, 0.1), ("train", "test"), key="id")
    path = f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    run = sr.fit_run(pairs.where("split = 'train'"), _grid_rows(spark, sf_dir), ft.MODEL_FEATURES, path, "v1")
    cos = run.cosine(pairs.where("split = 'test'"))
    return cos.withColumn("title_term_similarity", F.round("title_term_similarity", R))


def q_snap_levels(spark, sf_dir):
    p = _fixed_predictions(spark, sf_dir).withColumn(
        "prediction", F.col("prediction") + (F.col("id") % 13) / 100.0)
    return md.snap_predictions(p.select("id", "prediction").withColumn("raw", F.col("prediction"))) \
        .select("id", F.round("raw", R).alias("raw"), F.col("prediction").alias("snapped"))


def q_mean_threshold_label(spark, sf_dir):
    tr = fixture(spark, sf_dir, "train").select("id", F.col("relevance").cast("double").alias("label"))
    return md.binarize_labels(tr, "mean")


#: Clusters and rounds of the queries that start k-means without a seed.
LLOYD_K, LLOYD_ROUNDS = 3, 8


def _model_input(spark, sf_dir):
    # Iterative fits scan their input many times: materialise it once.
    return cut_lineage(ft.assemble(ft.model_table(_feat(spark, sf_dir))))


def _train_test(spark, sf_dir):
    feats = sp.with_split(_feat(spark, sf_dir), (0.9, 0.1), ("train", "test"), key="id")
    v = cut_lineage(ft.assemble(ft.model_table(feats, keep=("split",)), keep=("split",)))
    return v.where(F.col("split") == "train"), v.where(F.col("split") == "test")


def q_assembled_features(spark, sf_dir):
    return _model_input(spark, sf_dir)


def q_lr_tuned(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = md.linear_regression_tuned(train, seed=42, parallelism=4)
    return model.transform(test).select("label", "prediction")


def _grid_rows(spark, sf_dir):
    """Valid pairs, six tenths of the training pairs to fit and the others to compare candidates on."""
    feats = sp.with_split(_feat(spark, sf_dir), (0.9, 0.1), ("train", "test"), key="id").where("split = 'train'")
    feats = sp.with_split(feats, (md.TRAIN_RATIO, 1 - md.TRAIN_RATIO), ("train", "validation"), key="id", salt="tune-")
    return ft.model_table(feats, keep=("split",))


def q_lr_moments(spark, sf_dir):
    m = md.moment_matrix(_grid_rows(spark, sf_dir), ft.MODEL_FEATURES, by=("split",))
    return m.withColumn("value", F.round("value", 3))


def q_lr_grid(spark, sf_dir):
    """The twelve candidates with their error on the rows that are not fitted."""
    out = md.linear_regression_grid(_grid_rows(spark, sf_dir), ft.MODEL_FEATURES)
    return out.select("candidate", "reg_param", "fit_intercept", "elastic_net", F.round("mse", 5).alias("mse"))


def q_lr_ridge(spark, sf_dir):
    """Coefficients of the candidates without an L1 part."""
    out = md.linear_regression_grid(_grid_rows(spark, sf_dir), ft.MODEL_FEATURES).where("elastic_net = 0")
    named = F.arrays_zip(F.array(*map(F.lit, ft.MODEL_FEATURES)).alias("feature"), F.col("coefficients").alias("coefficient"))
    return (out.select("reg_param", "fit_intercept", F.explode(named).alias("c"))
            .select("reg_param", "fit_intercept", F.col("c.feature").alias("feature"), F.round("c.coefficient", R).alias("coefficient")))


def q_rf_tuned(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model = md.random_forest_tuned(train, seed=42, parallelism=4)
    return model.transform(test).select("label", "prediction")


def q_gbt(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return md.gradient_boosted_trees(train, seed=42).transform(test).select("label", "prediction")


def q_kmeans_clusters(spark, sf_dir):
    return md.kmeans_clusters(md.binarize_labels(_model_input(spark, sf_dir))).select("label", "prediction")


def _point_rows(spark, sf_dir):
    return ft.model_table(_feat(spark, sf_dir), keep=("id",))


def q_kmeans_lloyd(spark, sf_dir):
    """Cluster and squared distance of every valid pair, three clusters, started without a seed."""
    out = md.lloyd_clusters(_point_rows(spark, sf_dir), ft.MODEL_FEATURES, k=LLOYD_K, iterations=LLOYD_ROUNDS, tolerance=0.0)
    return out.select("id", "prediction", F.round("cost", 4).alias("cost"))


def q_kmeans_lloyd_curves(spark, sf_dir):
    """Two clusters against the binary label, numbered by their mean label."""
    rows = md.binarize_labels(_point_rows(spark, sf_dir))
    out = md.lloyd_clusters(rows, ft.MODEL_FEATURES, k=2, iterations=LLOYD_ROUNDS, tolerance=0.0)
    out = md.align_clusters(out.withColumn("prediction", F.col("prediction").cast("double")))
    return _round_curve(md.score_clusters(out), "precision", "recall", "f_measure")


def q_bisecting_clusters(spark, sf_dir):
    return md.bisecting_kmeans_clusters(md.binarize_labels(_model_input(spark, sf_dir))) \
        .select("label", "prediction")


def q_kmeans_curves(spark, sf_dir):
    clusters = md.kmeans_clusters(md.binarize_labels(_model_input(spark, sf_dir)))
    return md.score_clusters(clusters)


def q_regex_tokenize(spark, sf_dir):
    toks = tx.regex_tokenize("product_title")
    return _merged(spark, sf_dir).select("id", F.size(toks).alias("n_tokens"),
                                         F.array_join(toks, "|").alias("tokens"))


def q_stop_words_removed(spark, sf_dir):
    toks = cl.remove_stop_words(tx.regex_tokenize("product_description"))
    return fixture(spark, sf_dir, "product_descriptions").select(
        "product_uid", F.size(toks).alias("n_tokens"), F.array_join(toks, "|").alias("tokens"))


def q_clean_text(spark, sf_dir):
    return fixture(spark, sf_dir, "product_descriptions").select(
        "product_uid", cl.clean_text("product_description").alias("cleaned"))


def q_query_frequency(spark, sf_dir):
    return ft.query_frequency(fixture(spark, sf_dir, "train")).select("id", "search_term",
                                                                    "query_frequency")


def q_letter_histogram(spark, sf_dir):
    return ft.letter_histogram(fixture(spark, sf_dir, "train"), "search_term")


def q_title_length(spark, sf_dir):
    return ft.with_title_length(_train_pre(spark, sf_dir)).select("id", "len_of_title")


def q_cosine_term_description(spark, sf_dir):
    _, descriptions, _ = fixtures(spark, sf_dir)
    cos = tfm.product_cosine(_train_pre(spark, sf_dir), descriptions.withColumn("product_description", F.lower("product_description")),
                             "stemmed_search_term", "product_description", out="term_description_similarity")
    return cos.select("id", F.round("term_description_similarity", R).alias("term_description_similarity"))


def q_jaccard_term_title(spark, sf_dir):
    sim_ = tx.row_jaccard("stemmed_search_term", "stemmed_product_title")
    return _train_pre(spark, sf_dir).select("id", F.round(sim_, R).alias("jaccard_term_title"))


def q_jaccard_term_description(spark, sf_dir):
    """Attributes, one row a product, change no pair and are not read."""
    products = (fixture(spark, sf_dir, "product_descriptions").where("product_uid is not null")
                .select("product_uid", F.lower("product_description").alias("_text")))
    sim_ = tx.row_jaccard_to_text("stemmed_search_term", "_text")
    return (_train_pre(spark, sf_dir).join(products, "product_uid", "left")
            .select("id", F.round(sim_, R).alias("jaccard_term_description")))


def q_cosine_term_attributes(spark, sf_dir):
    cos = tfm.field_cosine(_pre(spark, sf_dir), "stemmed_search_term", "stemmed_attributes",
                           out="term_attributes_similarity")
    return cos.select("id", F.round("term_attributes_similarity", R).alias("term_attributes_similarity"))


def q_l2_normalized_title(spark, sf_dir):
    n = tfm.l2_normalize(_tfidf_field(spark, sf_dir, "title"))
    return n.select("id", "token", F.round("weight", R).alias("normalized_tfidf"))


def q_jaccard_term_attributes(spark, sf_dir):
    sim_ = tx.row_jaccard("stemmed_search_term", "stemmed_attributes")
    return _pre(spark, sf_dir).select("id", F.round(sim_, R).alias("jaccard_term_attributes"))


def q_letter_histogram_title(spark, sf_dir):
    return ft.letter_histogram(fixture(spark, sf_dir, "train"), "product_title")


def q_ratio_by_words(spark, sf_dir):
    n = tx.word_count("stemmed_search_term")
    return _feat(spark, sf_dir).select("id", *[
        tx.ratio_of_common_words(f"commonWords_term_{c}", n).alias(f"word_ratio_{c}") for c in ("title", "description", "attr")])


def q_features_with_cosine(spark, sf_dir):
    """The flagship's path, without stemming: the form whose values SQL can check."""
    from .full_run import flagship
    return flagship(spark, sf_dir, stemmer="none").withColumn("title_term_similarity", F.round("title_term_similarity", R))


def q_cosine_repeated_ids(spark, sf_dir):
    """Title-query cosine of pairs whose ids repeat: each id is cut to its hundreds."""
    pairs = _train_pre(spark, sf_dir).withColumn("id", F.floor(F.col("id") / 100))
    cos = tfm.title_term_cosine(pairs)
    return cos.select("id", F.round("title_term_similarity", R).alias("title_term_similarity"))


def q_assembled_as_columns(spark, sf_dir):
    """The assembled vectors taken apart again."""
    from pyspark.ml.functions import vector_to_array
    v = ft.assemble(ft.model_table(_feat(spark, sf_dir))).select("label", vector_to_array("features").alias("v"))
    return v.select("label", *[F.round(F.col("v")[i], R).alias(c) for i, c in enumerate(ft.MODEL_FEATURES)])


def q_cluster_curves_fixed(spark, sf_dir):
    """Curves of a fixed clustering: cluster number = customer modulo 8."""
    from ..sources.fixtures import base_table
    o = base_table(spark, sf_dir, "orders")
    fixed = o.select((F.col("o_custkey") % 8).cast("int").alias("prediction"), (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    return _round_curve(md.score_clusters(fixed), "precision", "recall", "f_measure")


def q_jaccard_title_pairs(spark, sf_dir):
    """Raw self-join form over the product titles, where sets differ by a word."""
    pairs = sim.jaccard_pairs(_train_pre(spark, sf_dir), "stemmed_product_title", max_distance=0.5, include_self_and_mirror=True)
    return pairs.select("set_a", "set_b", F.round("jaccard_distance", R).alias("jaccard_distance"))


def q_validity_report(spark, sf_dir):
    return ft.validity_report(_feat(spark, sf_dir))


SPARK_QUERIES = {
    "merge_left": q_merge_left,
    "attr_group_concat": q_attr_group_concat,
    "lower_project": q_lower_project,
    "rename_drop": q_rename_drop,
    "relevance_cast": q_relevance_cast,
    "tokenize_ws": q_tokenize_ws,
    "levenshtein_all": q_levenshtein_all,
    "len_query": q_len_query,
    "len_num_attr": q_len_num_attr,
    "common_words_all": q_common_words_all,
    "common_words_raw": q_common_words_raw,
    "ratio_all": q_ratio_all,
    "features_valid": q_features_valid,
    "binary_label": q_binary_label,
    "source_counts": q_source_counts,
    "sort_by_uid": q_sort_by_uid,
    "tf_exact": q_tf_exact,
    "idf": q_idf,
    "tfidf_title": q_tfidf_title,
    "tfidf_term": q_tfidf_term,
    "tfidf_description": q_tfidf_description,
    "cosine_title_term": q_cosine_title_term,
    "jaccard_exact_pairs": q_jaccard_exact_pairs,
    "jaccard_raw_pairs": q_jaccard_raw_pairs,
    "minhash_pairs": q_minhash_pairs,
    "minhash_recall": q_minhash_recall,
    "term_similarity_exact": q_term_similarity_exact,
    "term_similarity_dimsum": q_term_similarity_dimsum,
    "dimsum_error": q_dimsum_error,
    "tf_hashed": q_tf_hashed,
    "tf_hashed_narrow": q_tf_hashed_narrow,
    "stem_terms": q_stem_terms,
    "features_stemmed": q_features_stemmed,
    "hash_sample": q_hash_sample,
    "hash_split": q_hash_split,
    "mse_fixed": q_mse_fixed,
    "pr_curve_fixed": q_pr_curve_fixed,
    "f1_curve_fixed": q_f1_curve_fixed,
    "pr_curve_all_scores": q_pr_curve_all_scores,
    "pr_curve_binned": q_pr_curve_binned,
    "merge_from_buckets": q_merge_from_buckets,
    "attr_group_concat_ranges": q_attr_group_concat_ranges,
    "csv_rejects": q_csv_rejects,
    "cosine_saved_idf": q_cosine_saved_idf,
    "snap_levels": q_snap_levels,
    "mean_threshold_label": q_mean_threshold_label,
    "assembled_features": q_assembled_features,
    "lr_tuned": q_lr_tuned,
    "lr_moments": q_lr_moments,
    "lr_grid": q_lr_grid,
    "lr_ridge": q_lr_ridge,
    "rf_tuned": q_rf_tuned,
    "gbt": q_gbt,
    "kmeans_clusters": q_kmeans_clusters,
    "bisecting_clusters": q_bisecting_clusters,
    "kmeans_curves": q_kmeans_curves,
    "kmeans_lloyd": q_kmeans_lloyd,
    "kmeans_lloyd_curves": q_kmeans_lloyd_curves,
    "regex_tokenize": q_regex_tokenize,
    "stop_words_removed": q_stop_words_removed,
    "clean_text": q_clean_text,
    "query_frequency": q_query_frequency,
    "letter_histogram": q_letter_histogram,
    "title_length": q_title_length,
    "cosine_term_description": q_cosine_term_description,
    "jaccard_term_title": q_jaccard_term_title,
    "l2_normalized_title": q_l2_normalized_title,
    "jaccard_term_description": q_jaccard_term_description,
    "cosine_term_attributes": q_cosine_term_attributes,
    "validity_report": q_validity_report,
    "jaccard_term_attributes": q_jaccard_term_attributes,
    "letter_histogram_title": q_letter_histogram_title,
    "ratio_by_words": q_ratio_by_words,
    "features_with_cosine": q_features_with_cosine,
    "cosine_repeated_ids": q_cosine_repeated_ids,
    "assembled_as_columns": q_assembled_as_columns,
    "cluster_curves_fixed": q_cluster_curves_fixed,
    "jaccard_title_pairs": q_jaccard_title_pairs,
}

# ---------------------------------------------------------------- DuckDB side

NUL = "chr(0)"
WS = r"'[ \t\n\x0B\f\r]'"


def _sql_java_split(x: str, sep_class: str) -> str:
    """String.split semantics in DuckDB SQL (sep_class: a one-char regex class)."""
    trimmed = f"regexp_replace({x}, '({sep_class})+$', '')"
    return (f"(case when {x} is null then null when {x} = '' then [''] "
            f"when {trimmed} = '' then []::varchar[] "
            f"else regexp_split_to_array({trimmed}, '{sep_class}') end)")


def _sql_common(a: str, b: str, aware: bool = True) -> str:
    sep = r"[ \x00]" if aware else " "
    wa, wb = _sql_java_split(a, sep), _sql_java_split(b, sep)
    overlap = (f"coalesce(list_sum(list_transform(list_distinct({wa}), lambda w: "
               f"least(len(list_filter({wa}, lambda x: x = w)), len(list_filter({wb}, lambda x: x = w))))), 0)")
    return (f"cast(case when {a} is null or {b} is null or {a} = '' or {b} = '' then 0 "
            f"else {overlap} end as integer)")


def _sql_ratio(common: str, length: str) -> str:
    return (f"cast(case when {common} is null or {length} is null then null "
            f"when {length} = 0 then (case when {common} = 0 then 'NaN'::double else 'Infinity'::double end) "
            f"else cast({common} as double) / {length} end as float)")


def _sql_num_attr(a: str) -> str:
    t = f"regexp_replace(coalesce({a}, ''), '\\x00+$', '')"
    return (f"cast(case when {t} = '' then 0 else length({t}) - length(replace({t}, {NUL}, '')) + 1 end "
            f"as integer)")


def _sql_tokens(x: str) -> str:
    """Tokenizer semantics: lower, split at single whitespace chars."""
    return _sql_java_split(f"lower({x})", r"[ \t\n\x0B\f\r]")


MERGED_CTE = cte("train", "product_descriptions", "attributes") + """,
flat as (
  select product_uid,
         string_agg(concat_ws(' ', name, value), chr(0) order by concat_ws(' ', name, value)) as attributes
  from attributes where product_uid is not null group by product_uid),
merged as (
  select t.product_uid, t.id, t.product_title, t.search_term, t.relevance,
         d.product_description, f.attributes
  from train t left join product_descriptions d on t.product_uid = d.product_uid
  left join flat f on t.product_uid = f.product_uid),
pre as (
  select product_uid, id, lower(product_title) as product_title, lower(search_term) as search_term,
         relevance, lower(product_description) as product_description, lower(attributes) as attributes,
         lower(product_title) as stemmed_product_title,
         lower(product_description) as stemmed_product_description,
         lower(attributes) as stemmed_attributes, lower(search_term) as stemmed_search_term
  from merged)
"""

_Q, _T, _D, _A = ("stemmed_search_term", "stemmed_product_title", "stemmed_product_description",
                  "stemmed_attributes")


def _one_byte(x: str) -> str:
    """Each non-ASCII character as one control character: DuckDB's levenshtein counts
    bytes, Spark's characters, and against an ASCII query the distance stays the same."""
    return f"regexp_replace({x}, '[^\\x00-\\x7F]', chr(1), 'g')"


def _features_cte(aware: bool = True) -> str:
    return MERGED_CTE + f""",
feat0 as (
  select *,
    cast(levenshtein({_one_byte(_D)}, {_Q}) as integer) as levenshtein_dist_description,
    cast(levenshtein({_T}, {_Q}) as integer) as levenshtein_dist_title,
    cast(levenshtein({_A}, {_Q}) as integer) as levenshtein_dist_attr,
    cast(length({_Q}) as integer) as len_of_query,
    cast(coalesce(length({_A}), 0) as integer) as len_of_attr,
    {_sql_num_attr(_A)} as num_of_attr,
    {_sql_common(_Q, _T, aware)} as commonWords_term_title,
    {_sql_common(_Q, _D, aware)} as commonWords_term_description,
    {_sql_common(_Q, _A, aware)} as commonWords_term_attr
  from pre),
feat as (
  select *,
    {_sql_ratio('commonWords_term_title', 'len_of_query')} as ratio_title,
    {_sql_ratio('commonWords_term_description', 'len_of_query')} as ratio_description,
    {_sql_ratio('commonWords_term_attr', 'len_of_query')} as ratio_attr
  from feat0)
"""


FEATURE_LIST = ", ".join(ft.MODEL_FEATURES)
VALID = " and ".join(f"{c} is not null and not isnan({c})" for c in ft.MODEL_FEATURES)

TOKENS_CTE = MERGED_CTE + f""",
ndocs as (select count(*) as m from pre),
tok as (
  select 'title' as field, id, unnest({_sql_tokens(_T)}) as token from pre
  union all select 'description', id, unnest({_sql_tokens(_D)}) from pre
  union all select 'term', id, unnest({_sql_tokens(_Q)}) from pre),
tf as (select field, id, token, count(*) as tf from tok where token <> '' group by field, id, token),
dfreq as (select field, token, count(*) as df from tf group by field, token),
idf as (select field, token, df, ln((cast((select m from ndocs) as double) + 1) / (df + 1)) as idf from dfreq),
w as (select tf.field, tf.id, tf.token, tf.tf, idf.idf, tf.tf * idf.idf as weight
      from tf join idf on tf.field = idf.field and tf.token = idf.token)
"""

ORACLE_SQL = {
    "merge_left": MERGED_CTE + "select * from merged",
    "attr_group_concat": cte("attributes") + """
select product_uid,
       string_agg(concat_ws(' ', name, value), chr(0) order by concat_ws(' ', name, value)) as attributes
from attributes group by product_uid""",
    "lower_project": MERGED_CTE + """
select product_uid, id, lower(product_title) as product_title, lower(search_term) as search_term,
       relevance, lower(product_description) as product_description, lower(attributes) as attributes
from merged""",
    "rename_drop": MERGED_CTE + """
select product_uid, id, relevance, stemmed_product_title as title,
       stemmed_product_description as description, stemmed_attributes as attributes,
       stemmed_search_term as search_term
from pre""",
    "relevance_cast": cte("train") + "select id, cast(relevance as double) as relevance from train",
    "tokenize_ws": MERGED_CTE + f"""
select id, cast(len({_sql_tokens('product_title')}) as integer) as n_tokens,
       array_to_string({_sql_tokens('product_title')}, '|') as tokens
from merged""",
    "levenshtein_all": _features_cte() + """
select id, levenshtein_dist_description, levenshtein_dist_title, levenshtein_dist_attr from feat""",
    "len_query": _features_cte() + "select id, len_of_query from feat",
    "len_num_attr": _features_cte() + "select id, len_of_attr, num_of_attr from feat",
    "common_words_all": _features_cte() + """
select id, commonWords_term_title, commonWords_term_description, commonWords_term_attr from feat""",
    "common_words_raw": _features_cte(aware=False) + """
select id, commonWords_term_title, commonWords_term_description, commonWords_term_attr from feat""",
    "ratio_all": _features_cte() + "select id, ratio_title, ratio_description, ratio_attr from feat",
    "features_valid": _features_cte() + f"""
select cast(relevance as double) as label, {FEATURE_LIST} from feat where {VALID}""",
    "binary_label": cte("train") + """
select id, cast(relevance as double) as label,
       cast(case when cast(relevance as double) > 2.0 then 1.0 else 0.0 end as double) as binary_label
from train""",
    "source_counts": MERGED_CTE + """
select 'train' as source, count(*) as n_rows from train
union all select 'product_descriptions', count(*) from product_descriptions
union all select 'attributes', count(*) from attributes
union all select 'merged', count(*) from merged""",
    "sort_by_uid": MERGED_CTE + "select product_uid, id from merged order by product_uid, id",
    "tf_exact": TOKENS_CTE + "select field, id, token, tf from tf where field in ('title', 'term')",
    "idf": TOKENS_CTE + f"""
select field, token, df, round(idf, {R}) as idf from idf where field in ('title', 'term')""",
    "tfidf_title": TOKENS_CTE + f"""
select id, token, tf, round(idf, {R}) as idf, round(weight, {R}) as tfidf from w where field = 'title'""",
    "tfidf_term": TOKENS_CTE + f"""
select id, token, tf, round(idf, {R}) as idf, round(weight, {R}) as tfidf from w where field = 'term'""",
    "tfidf_description": TOKENS_CTE + f"""
select id, count(*) as n_terms, cast(sum(tf) as bigint) as n_tokens, round(sum(weight), {R}) as sum_tfidf,
       round(sqrt(sum(weight * weight)), {R}) as l2_norm
from w where field = 'description' group by id""",
    "cosine_title_term": TOKENS_CTE + f""",
pt as (
  select id, token, sum(case when field = 'title' then weight else 0 end) as wl,
         sum(case when field = 'term' then weight else 0 end) as wr
  from w where field in ('title', 'term') group by id, token),
s as (select id, sum(wl * wr) as dot, sum(wl * wl) as nl, sum(wr * wr) as nr from pt group by id)
select p.id, round(coalesce(case when sqrt(s.nl) * sqrt(s.nr) > 0 then s.dot / (sqrt(s.nl) * sqrt(s.nr))
                                 else 0.0 end, 0.0), {R}) as title_term_similarity
from pre p left join s on p.id = s.id""",
}


SETS_CTE = MERGED_CTE + f""",
qs as (select list_sort(list_distinct(list_filter({_sql_tokens(_Q)}, lambda t: t <> ''))) as toks from pre),
sets as (select array_to_string(toks, ' ') as set_key, toks, count(*) as n_rows
         from qs where len(toks) > 0 group by toks),
sp as (
  select a.set_key as set_a, b.set_key as set_b, a.n_rows as n_rows_a, b.n_rows as n_rows_b,
         cast(len(list_intersect(a.toks, b.toks)) as integer) as intersection,
         1.0 - len(list_intersect(a.toks, b.toks)) / (len(a.toks) + len(b.toks) - len(list_intersect(a.toks, b.toks))) as d,
         len(a.toks) as ka
  from sets a join sets b on a.set_key < b.set_key)
"""

ORACLE_SQL["jaccard_exact_pairs"] = SETS_CTE + f"""
select set_a, set_b, n_rows_a, n_rows_b, intersection, round(d, {R}) as jaccard_distance,
       round(1.0 - d, {R}) as jaccard_similarity
from sp where d <= 0.8 + 1e-9"""

ORACLE_SQL["jaccard_raw_pairs"] = SETS_CTE + f"""
select set_a, set_b, round(d, {R}) as jaccard_distance from sp where d <= 0.5 + 1e-9
union all select set_b, set_a, round(d, {R}) from sp where d <= 0.5 + 1e-9
union all select set_key, set_key, 0.0 from sets"""

ORACLE_SQL["term_similarity_exact"] = TOKENS_CTE + f""",
e as (select id, field || ':' || token as term, cast(tf as double) as value from tf
      where field in ('title', 'term')),
dots as (select a.term as term_a, b.term as term_b, sum(a.value * b.value) as dot
         from e a join e b on a.id = b.id and a.term < b.term group by a.term, b.term),
norms as (select term, sqrt(sum(value * value)) as norm from e group by term)
select term_a, term_b, round(dot / (na.norm * nb.norm), {R}) as similarity
from dots join norms na on na.term = dots.term_a join norms nb on nb.term = dots.term_b
where dot / (na.norm * nb.norm) >= 0.1 - 1e-9"""


def _sql_bucket(key: str, salt: str = "") -> str:
    return f"cast(concat('0x', substr(md5(concat('{salt}', cast({key} as varchar))), 1, {sp.HEX_DIGITS})) as bigint)"



_FIXED_PRED = "(1.0 + cast(product_uid % 21 as double) / 10.0)"

ORACLE_SQL["hash_sample"] = cte("train") + f"""
select id, product_uid from train where {_sql_bucket('id')} < {round(0.1 * sp.BUCKETS)}"""

ORACLE_SQL["hash_split"] = cte("train") + f"""
select id, case when {_sql_bucket('id', 'split-')} < {round(0.9 * sp.BUCKETS)} then 'train' else 'test' end as split from train"""

ORACLE_SQL["mse_fixed"] = cte("train") + f"""
select round(avg(power(cast(relevance as double) - {_FIXED_PRED}, 2)), {R}) as mse
from train"""

CURVE_CTE = """
with sc as (select {score} as score, case when o_orderstatus = 'F' then 1.0 else 0.0 end as label from orders),
c as (select score, sum(case when label > 0.5 then 1 else 0 end) as pos,
             sum(case when label > 0.5 then 0 else 1 end) as neg from sc group by score),
r as (select score as threshold,
             sum(pos) over (order by score desc rows between unbounded preceding and current row) as tp,
             sum(neg) over (order by score desc rows between unbounded preceding and current row) as fp,
             (select sum(pos) from c) as positives from c),
m as (select threshold,
             case when tp + fp = 0 then 1.0 else tp / (tp + fp) end as precision,
             case when positives = 0 then 0.0 else tp / positives end as recall from r)
"""
_F1 = "case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end"
_BUCKET = "cast(floor(o_totalprice / 20000) as double)"

ORACLE_SQL["pr_curve_fixed"] = CURVE_CTE.format(score=_BUCKET) + f"""
select threshold, round(precision, {R}) as precision, round(recall, {R}) as recall from m"""

ORACLE_SQL["f1_curve_fixed"] = CURVE_CTE.format(score=_BUCKET) + f"""
select threshold, round({_F1}, {R}) as f_measure from m"""

ORACLE_SQL["pr_curve_all_scores"] = CURVE_CTE.format(score="o_totalprice") + f"""
select threshold, round(precision, {R}) as precision, round(recall, {R}) as recall,
       round({_F1}, {R}) as f_measure from m"""

_SNAP_CANDS = ", ".join(
    ["struct_pack(d := abs(2.0 - p), r := -1, v := cast(2.0 as double))"]
    + [f"struct_pack(d := abs({v} - p), r := {i}, v := cast({v} as double))"
       for i, v in enumerate(tx.SNAP_LEVELS)])
ORACLE_SQL["snap_levels"] = cte("train") + f"""
, pr as (select id, {_FIXED_PRED} + cast(id % 13 as double) / 100.0 as p from train)
select id, round(p, {R}) as raw, list_sort([{_SNAP_CANDS}])[1].v as snapped from pr"""

ORACLE_SQL["mean_threshold_label"] = cte("train") + """
select id, cast(case when cast(relevance as double) > (select avg(cast(relevance as double)) from train)
                     then 1.0 else 0.0 end as double) as label from train"""


def _sql_regex_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[\\W_]+'), lambda t: length(t) >= 1)"


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in cl.STOP_WORDS)


def _sql_clean(x: str) -> str:
    out = f"lower({x})"
    for pattern, repl in cl.CLEANING_RULES:
        pat = pattern.replace("'", "''")
        rep = repl.replace("$1", "\\1").replace("$2", "\\2")
        out = f"regexp_replace({out}, '{pat}', '{rep}', 'g')"
    return f"trim({out})"


ORACLE_SQL["regex_tokenize"] = MERGED_CTE + f"""
select id, cast(len({_sql_regex_tokens('product_title')}) as integer) as n_tokens,
       array_to_string({_sql_regex_tokens('product_title')}, '|') as tokens
from merged"""

ORACLE_SQL["stop_words_removed"] = cte("product_descriptions") + f"""
, t as (select product_uid, list_filter({_sql_regex_tokens('product_description')},
                                       lambda w: not list_contains([{_STOP}], w)) as toks
        from product_descriptions)
select product_uid, cast(len(toks) as integer) as n_tokens, array_to_string(toks, '|') as tokens from t"""

ORACLE_SQL["clean_text"] = cte("product_descriptions") + f"""
select product_uid, {_sql_clean('product_description')} as cleaned from product_descriptions"""

ORACLE_SQL["query_frequency"] = cte("train") + """
select id, search_term, count(*) over (partition by search_term) as query_frequency from train"""

ORACLE_SQL["letter_histogram"] = cte("train") + """
, l as (select id, unnest(string_split(search_term, '')) as letter from train)
select id, letter, count(*) as n from l where letter <> '' group by id, letter"""

ORACLE_SQL["title_length"] = MERGED_CTE + """
select id, cast(length(stemmed_product_title) as integer) as len_of_title from pre"""

ORACLE_SQL["cosine_term_description"] = TOKENS_CTE + f""",
pt as (
  select id, token, sum(case when field = 'term' then weight else 0 end) as wl,
         sum(case when field = 'description' then weight else 0 end) as wr
  from w where field in ('term', 'description') group by id, token),
s as (select id, sum(wl * wr) as dot, sum(wl * wl) as nl, sum(wr * wr) as nr from pt group by id)
select p.id, round(coalesce(case when sqrt(s.nl) * sqrt(s.nr) > 0 then s.dot / (sqrt(s.nl) * sqrt(s.nr))
                                 else 0.0 end, 0.0), {R}) as term_description_similarity
from pre p left join s on p.id = s.id"""

def _sql_row_jaccard(a: str, b: str, out: str) -> str:
    return MERGED_CTE + f"""
, s as (select id, list_distinct(list_filter({_sql_tokens(a)}, lambda t: t <> '')) as a,
               list_distinct(list_filter({_sql_tokens(b)}, lambda t: t <> '')) as b from pre)
select id, round(case when len(a) + len(b) - len(list_intersect(a, b)) > 0
                      then len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))
                      else 0.0 end, {R}) as {out} from s"""


ORACLE_SQL["jaccard_term_title"] = _sql_row_jaccard(_Q, _T, "jaccard_term_title")
ORACLE_SQL["jaccard_term_description"] = _sql_row_jaccard(_Q, _D, "jaccard_term_description")

ORACLE_SQL["l2_normalized_title"] = TOKENS_CTE + f"""
, t as (select id, token, weight, sqrt(sum(weight * weight) over (partition by id)) as norm
        from w where field = 'title')
select id, token, round(case when norm > 0 then weight / norm else 0.0 end, {R}) as normalized_tfidf from t"""

ORACLE_SQL["cosine_term_attributes"] = MERGED_CTE + f""",
ndocs as (select count(*) as m from pre),
tok as (
  select 'term' as field, id, unnest({_sql_tokens(_Q)}) as token from pre
  union all select 'attr', id, unnest({_sql_tokens(_A)}) from pre),
tf as (select field, id, token, count(*) as tf from tok where token <> '' group by field, id, token),
dfreq as (select field, token, count(*) as df from tf group by field, token),
w as (select tf.field, tf.id, tf.token,
             tf.tf * ln((cast((select m from ndocs) as double) + 1) / (dfreq.df + 1)) as weight
      from tf join dfreq on tf.field = dfreq.field and tf.token = dfreq.token),
pt as (
  select id, token, sum(case when field = 'term' then weight else 0 end) as wl,
         sum(case when field = 'attr' then weight else 0 end) as wr
  from w group by id, token),
s as (select id, sum(wl * wr) as dot, sum(wl * wl) as nl, sum(wr * wr) as nr from pt group by id)
select p.id, round(coalesce(case when sqrt(s.nl) * sqrt(s.nr) > 0 then s.dot / (sqrt(s.nl) * sqrt(s.nr))
                                 else 0.0 end, 0.0), {R}) as term_attributes_similarity
from pre p left join s on p.id = s.id"""

ORACLE_SQL["validity_report"] = _features_cte() + f"""
select count(*) as n_pairs, cast(sum(case when {VALID} then 1 else 0 end) as bigint) as n_valid,
       cast(count(*) - sum(case when {VALID} then 1 else 0 end) as bigint) as n_dropped from feat"""

ORACLE_SQL["jaccard_term_attributes"] = _sql_row_jaccard(_Q, _A, "jaccard_term_attributes")

ORACLE_SQL["letter_histogram_title"] = ORACLE_SQL["letter_histogram"].replace("search_term", "product_title")

_WORDS_OF_QUERY = f"(case when {_Q} is null then null when {_Q} = '' then 0 else len({_sql_java_split(_Q, '[ \\x00]')}) end)"
ORACLE_SQL["ratio_by_words"] = _features_cte() + f"""
select id, {_sql_ratio('commonWords_term_title', _WORDS_OF_QUERY)} as word_ratio_title,
       {_sql_ratio('commonWords_term_description', _WORDS_OF_QUERY)} as word_ratio_description,
       {_sql_ratio('commonWords_term_attr', _WORDS_OF_QUERY)} as word_ratio_attr
from feat"""

_COSINES = """
pt as (
  select id, token, sum(case when field = 'title' then weight else 0 end) as wl,
         sum(case when field = 'term' then weight else 0 end) as wr
  from w where field in ('title', 'term') group by id, token),
s as (select id, sum(wl * wr) as dot, sum(wl * wl) as nl, sum(wr * wr) as nr from pt group by id),
cosines as (
  select p.id, coalesce(case when sqrt(s.nl) * sqrt(s.nr) > 0 then s.dot / (sqrt(s.nl) * sqrt(s.nr)) else 0.0 end, 0.0) as c
  from pre p left join s on p.id = s.id)
"""
ORACLE_SQL["features_with_cosine"] = TOKENS_CTE + "," + _COSINES + _features_cte()[len(MERGED_CTE):] + f"""
select feat.id, product_uid, relevance, round(c, {R}) as title_term_similarity, num_of_attr, {FEATURE_LIST}
from feat join cosines on feat.id = cosines.id"""

ORACLE_SQL["cosine_repeated_ids"] = TOKENS_CTE + "," + _COSINES + f"""
select cast(floor(id / 100) as bigint) as id, round(c, {R}) as title_term_similarity from cosines"""

ORACLE_SQL["assembled_as_columns"] = _features_cte() + f"""
select cast(relevance as double) as label, {', '.join(f'round(cast({c} as double), {R}) as {c}' for c in ft.MODEL_FEATURES)}
from feat where {VALID}"""

ORACLE_SQL["cluster_curves_fixed"] = CURVE_CTE.format(score="cast(o_custkey % 8 as double)") + f"""
select threshold, round(precision, {R}) as precision, round(recall, {R}) as recall,
       round({_F1}, {R}) as f_measure from m"""

ORACLE_SQL["jaccard_title_pairs"] = SETS_CTE.replace(_sql_tokens(_Q), _sql_tokens(_T)) + f"""
select set_a, set_b, round(d, {R}) as jaccard_distance from sp where d <= 0.5 + 1e-9
union all select set_b, set_a, round(d, {R}) from sp where d <= 0.5 + 1e-9
union all select set_key, set_key, 0.0 from sets"""


def _sql_bands(tokens: str, bands: int, rows: int, seed: int = 1) -> str:
    one = f"list_min(list_transform({tokens}, lambda w: substr(md5(concat('{seed}:{{i}}:', w)), 1, {sim.MINHASH_DIGITS})))"
    return "[" + ", ".join("concat(" + ", ".join([f"'{b}:'", *[one.format(i=b * rows + r) for r in range(rows)]]) + ")" for b in range(bands)) + "]"


def _sql_minhash(column: str, bands: int, rows: int) -> str:
    return SETS_CTE.replace(_sql_tokens(_Q), _sql_tokens(column)) + f""",
signed as (select set_key, {_sql_bands('toks', bands, rows)} as s from sets),
found as (select sp.set_a, sp.set_b, d from sp join signed x on x.set_key = sp.set_a join signed y on y.set_key = sp.set_b
          where len(list_intersect(x.s, y.s)) > 0)
"""


ORACLE_SQL["minhash_pairs"] = _sql_minhash(_Q, sim.minhash_bands(0.2), 1) + f"""
select set_a, set_b, round(d, {R}) as jaccard_distance, round(1.0 - d, {R}) as jaccard_similarity from found where d <= 0.8 + 1e-9"""

ORACLE_SQL["minhash_recall"] = _sql_minhash(_T, sim.minhash_bands(0.5, 2), 2) + f"""
select a.n as n_exact, b.n as n_found, round(b.n / greatest(a.n, 1), {R}) as recall
from (select count(*) as n from sp where d <= 0.5 + 1e-9) a, (select count(*) as n from found where d <= 0.5 + 1e-9) b"""

SAMPLED_CTE = TOKENS_CTE + f""",
e as (select id, field || ':' || token as term, cast(tf as double) as value from tf where field in ('title', 'term')),
stats as (select term, max(value) as top, sqrt(sum(value * value)) / max(value) as norm from e group by term),
g as (select 10.0 * ln(greatest(count(*), 2)) / 0.1 as gamma from stats),
kept as (select id, e.term, value / top / least(sqrt(gamma), norm) as value from e join stats on e.term = stats.term, g
         where {_sql_bucket("concat(id, ':', e.term)")} < sqrt(gamma) / norm * {sp.BUCKETS}.0::double),
est as (select a.term as term_a, b.term as term_b, sum(a.value * b.value) as similarity
        from kept a join kept b on a.id = b.id and a.term < b.term group by a.term, b.term)
"""

ORACLE_SQL["term_similarity_dimsum"] = SAMPLED_CTE + f"""
select term_a, term_b, round(similarity, {R}) as similarity from est where similarity >= 0.1 - 1e-9"""

ORACLE_SQL["dimsum_error"] = SAMPLED_CTE + f""",
dots as (select a.term as term_a, b.term as term_b, sum(a.value * b.value) as dot
         from e a join e b on a.id = b.id and a.term < b.term group by a.term, b.term),
norms as (select term, sqrt(sum(value * value)) as norm from e group by term),
exact as (select term_a, term_b, dot / (na.norm * nb.norm) as s
          from dots join norms na on na.term = dots.term_a join norms nb on nb.term = dots.term_b
          where dot / (na.norm * nb.norm) >= 0.1 - 1e-9)
select count(*) as n_pairs, count(*) filter (where hit) as n_inside, round(count(*) filter (where hit) / greatest(count(*), 1), {R}) as inside
from (select abs(coalesce(similarity, 0) - s) <= 4.0 * sqrt(s / gamma) + 1e-9 as hit
      from exact left join est on est.term_a = exact.term_a and est.term_b = exact.term_b, g) x"""

_SLOT = "cast(concat('0x', substr(md5(token), 1, 8)) as bigint) %"
ORACLE_SQL["tf_hashed"] = TOKENS_CTE + f"""
select field, id, {_SLOT} {tfm.HASHED_NUM_FEATURES} as slot, cast(sum(tf) as bigint) as tf from tf where field in ('title', 'term') group by all"""
ORACLE_SQL["tf_hashed_narrow"] = TOKENS_CTE + f"""
select field, id, {_SLOT} 8 as slot, cast(sum(tf) as bigint) as tf from tf where field = 'title' group by all"""

_D2 = len(ft.MODEL_FEATURES) + 2
MOMENTS_CTE = _features_cte() + f""",
tuned as (select case when {_sql_bucket('id', 'tune-')} < {round(md.TRAIN_RATIO * sp.BUCKETS)} then 'train' else 'validation' end as split,
                 [1.0::double, {", ".join(f"cast({c} as double)" for c in ft.MODEL_FEATURES)}, cast(relevance as double)] as z
          from feat where {VALID} and {_sql_bucket('id', 'split-')} < {round(0.9 * sp.BUCKETS)}),
moments as (select split, i, j, sum(z[i + 1] * z[j + 1]) as value
            from tuned, (select unnest(range({_D2})) as i) a, (select unnest(range({_D2})) as j) b group by split, i, j)
"""
ORACLE_SQL["lr_moments"] = MOMENTS_CTE + """
select split, cast(i as integer) as i, cast(j as integer) as j, round(value, 3) as value from moments where i <= j"""

#: Gauss-Jordan elimination of the scaled normal equations, one row a candidate and step.
_F2 = len(ft.MODEL_FEATURES)
ORACLE_SQL["lr_ridge"] = MOMENTS_CTE.replace("with ", "with recursive ", 1) + f""",
n as (select value as n from moments where split = 'train' and i = 0 and j = 0),
ms as (select j, value / n as mean from moments, n where split = 'train' and i = 0),
sds as (select m.j, mean, sqrt(value / n - mean * mean) as sd from moments m join ms on ms.j = m.j, n where split = 'train' and m.i = m.j and m.j > 0),
label as (select mean, sd from sds where j = {_F2 + 1}),
candidates as (select r as reg_param, f as fit_intercept from (values {", ".join(f"({r}::double)" for r in md.LR_REG_PARAMS)}) a(r), (values (true), (false)) b(f)),
cells as (select reg_param, fit_intercept, m.i, m.j,
                 (value / n - case when fit_intercept then x.mean * y.mean else 0 end) / (x.sd * y.sd)
                 + case when m.i = m.j then reg_param / label.sd else 0 end as v
          from moments m join sds x on x.j = m.i join sds y on y.j = m.j, n, label, candidates where split = 'train' and m.i <= {_F2}),
lines as (select reg_param, fit_intercept, i, list(v order by j) as line from cells group by all),
steps(reg_param, fit_intercept, k, m) as (
  select reg_param, fit_intercept, 0, list(line order by i) from lines group by all
  union all
  select reg_param, fit_intercept, k + 1,
         list_transform(m, lambda x, i: case when i = k + 1 then list_transform(x, lambda v: v / m[k + 1][k + 1])
           else list_transform(x, lambda v, j: v - x[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) end)
  from steps where k < {_F2}),
solved as (select reg_param, fit_intercept, unnest(range(1, {_F2 + 1})) as j, unnest(list_transform(m, lambda x: x[{_F2 + 1}])) as w from steps where k = {_F2})
select reg_param, fit_intercept, [{", ".join(f"'{c}'" for c in ft.MODEL_FEATURES)}][solved.j] as feature, round(w * label.sd / sds.sd, {R}) as coefficient
from solved join sds on sds.j = solved.j, label"""

ORACLE_SQL["merge_from_buckets"] = ORACLE_SQL["merge_left"]
ORACLE_SQL["attr_group_concat_ranges"] = ORACLE_SQL["attr_group_concat"]

#: The points of the exact curve at the hundred quantiles (the sketch is exact below its accuracy).
ORACLE_SQL["pr_curve_binned"] = CURVE_CTE.format(score="o_totalprice") + f""",
ranked as (select score, row_number() over (order by score) as place, count(*) over () as n from sc),
cuts as (select distinct score from ranked, (select unnest(range(100)) as i) q where place = greatest(1, cast(ceil(i / 100.0 * n) as bigint)))
select threshold, round(precision, {R}) as precision, round(recall, {R}) as recall, round({_F1}, {R}) as f_measure
from m join cuts on cuts.score = m.threshold"""

ORACLE_SQL["csv_rejects"] = cte("train") + """
select id, case when id % 50 = 0 then null else product_uid end as product_uid, case when id % 50 = 0 then null else product_title end as product_title,
       case when id % 50 = 0 then null else search_term end as search_term, case when id % 50 = 0 then null else relevance end as relevance, id % 50 = 0 as rejected
from train"""

ORACLE_SQL["cosine_saved_idf"] = TOKENS_CTE + f""",
part_of as (select id, {_sql_bucket('id', 'split-')} < {round(0.9 * sp.BUCKETS)} as fitted from pre),
n as (select count(*) as m from part_of where fitted),
train_idf as (select field, token, ln((cast(m as double) + 1) / (count(*) + 1)) as idf from tf join part_of using (id), n where fitted group by field, token, m),
weights as (select tf.field, tf.id, tf.token, tf.tf * coalesce(i.idf, 0) as weight
            from tf join part_of using (id) left join train_idf i on i.field = tf.field and i.token = tf.token where not fitted and tf.field in ('title', 'term')),
norms as (select id, sqrt(sum(weight * weight) filter (where field = 'title')) as a, sqrt(sum(weight * weight) filter (where field = 'term')) as b from weights group by id),
dots as (select x.id, sum(x.weight * y.weight) as dot from weights x join weights y on x.id = y.id and x.token = y.token and x.field = 'title' and y.field = 'term' group by x.id)
select p.id, round(coalesce(case when a * b > 0 then dot / (a * b) end, 0.0), {R}) as title_term_similarity
from part_of p left join norms using (id) left join dots using (id) where not fitted"""


def _lloyd_cte(k: int, extra: str = "") -> str:
    """Points, and the centers of every round as c0 .. cN (one row: a list of k centers)."""
    n = len(ft.MODEL_FEATURES)
    means, sds = (f"[{', '.join(f'{f}(x[{i + 1}])' for i in range(n))}]" for f in ("avg", "stddev_pop"))
    at = [(2 * j - (k - 1)) / max(k - 1, 1) for j in range(k)]
    start = ", ".join(f"list_transform(mean, lambda v, i: v + {a}::double * sd[i])" for a in at)
    text = _features_cte() + f""",
pts as materialized (select id, {extra} [{", ".join(f"cast({c} as double)" for c in ft.MODEL_FEATURES)}] as x from feat where {VALID}),
spread as (select {means} as mean, {sds} as sd from pts),
c0 as materialized (select [{start}] as cs from spread)"""
    for t in range(LLOYD_ROUNDS + 1):
        text += f""",
a{t} as materialized (select p.*, list_transform(cs, lambda c: list_sum(list_transform(c, lambda v, i: (x[i] - v) * (x[i] - v)))) as ds from pts p, c{t}),
g{t} as (select list_position(ds, list_min(ds)) - 1 as no, {means} as c from a{t} group by 1),
c{t + 1} as materialized (select list(coalesce(g.c, cs[j + 1]) order by j) as cs
                          from (select cs, unnest(range({k})) as j from c{t}) old left join g{t} g on g.no = old.j)"""
    return text


ORACLE_SQL["kmeans_lloyd"] = _lloyd_cte(LLOYD_K) + f"""
select id, cast(list_position(ds, list_min(ds)) - 1 as integer) as prediction, round(list_min(ds), 4) as cost from a{LLOYD_ROUNDS}"""

ORACLE_SQL["kmeans_lloyd_curves"] = _lloyd_cte(2, f"case when cast(relevance as double) > {md.BINARY_THRESHOLD} then 1.0 else 0.0 end as label,") + f""",
named as (select label, cast(list_position(ds, list_min(ds)) - 1 as double) as no from a{LLOYD_ROUNDS}),
swap as (select coalesce(avg(label) filter (where no = 0), -1) > coalesce(avg(label) filter (where no = 1), -1) as yes from named),
scored as (select label, case when yes then 1 - no else no end as score from named, swap),
points as (select t.score as threshold, count(*) filter (where s.score >= t.score) as n, count(*) filter (where s.score >= t.score and label > 0.5) as hit,
                  count(*) filter (where label > 0.5) as positive
           from (select distinct score from scored) t, scored s group by t.score)
select threshold, round(precision, {R}) as precision, round(recall, {R}) as recall,
       round(case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end, {R}) as f_measure
from (select threshold, case when n > 0 then hit / n else 1 end as precision, case when positive > 0 then hit / positive else 0 end as recall from points) m"""
