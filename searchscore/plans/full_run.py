"""The full run, as functions that return tables instead of printing."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.merge import flatten_attributes, merge_sources, product_table
from ..session import cut_lineage
from ..sources.fixtures import fixtures
from . import features as ft


def _prepare(df: DataFrame, columns: dict, stemmer: str, repeated: bool = False) -> DataFrame:
    """lower-case each source column, then stem it into its stemmed_* column;
    ``repeated`` if rows share their texts. ``stemmer`` "dictionary" stems the distinct
    words only, "porter2" the texts, "none" nothing."""
    low = df.withColumns({src: F.lower(F.col(src)) for src in columns})
    if stemmer == "none":
        return low.withColumns({dst: F.col(src) for src, dst in columns.items()})
    from ..operators.stemming import stem_by_vocabulary, stem_columns, stem_distinct
    if stemmer == "dictionary":
        return stem_by_vocabulary(low, columns)
    return stem_distinct(low, columns) if repeated else stem_columns(low, columns)


def preprocess_sources(train: DataFrame, descriptions: DataFrame, attributes: DataFrame,
                       stemmer: str = "porter2", materialize_pairs: bool = False,
                       spaced: bool | None = None) -> DataFrame:
    """X1 at source level, then merge: the same rows as merge -> preprocess.

    Lower-casing and stemming are row-wise, so they commute with the joins.
    Running them before the joins stems each product's description and
    attribute text once, not once per query-product pair; titles and queries,
    which repeat over the pairs, are stemmed once per distinct text. With ``spaced``
    (True: separator-aware) the ``spaced_words`` of the product texts come along as
    ``_s_d`` (of short descriptions) and ``_s_a``, made once per product too.
    """
    s = ft.STEM_SOURCES
    tr = _prepare(train, {"product_title": s["product_title"],
                          "search_term": s["search_term"]}, stemmer, repeated=True)
    if materialize_pairs and stemmer != "none":
        # Two consumers (row features and the title-term cosine) read the
        # stemmed pairs: stem once and keep the result in the shared
        # checkpoint folder instead of running the Python step per consumer.
        tr = cut_lineage(tr)
    de = _prepare(descriptions, {"product_description": s["product_description"]}, stemmer)
    at = _prepare(flatten_attributes(attributes, drop_null_keys=True),
                  {"attributes": s["attributes"]}, stemmer)
    extra = []
    if spaced is not None:
        de = de.withColumn("_s_d", tx.spaced_words(s["product_description"], spaced, tx.LONG_TEXT))
        at = at.withColumn("_s_a", tx.spaced_words(s["attributes"], spaced))
        extra = ["_s_d", "_s_a"]
    merged = tr.join(product_table(de, at), "product_uid", "left")
    return merged.select("product_uid", "id", "product_title", "search_term", "relevance",
                         "product_description", "attributes", *s.values(), *extra)


def feature_table(train: DataFrame, descriptions: DataFrame, attributes: DataFrame,
                  stemmer: str = "porter2", with_cosine: bool = True,
                  separator_aware: bool = True) -> DataFrame:
    """Merge (A1, J1, J2) + preprocess (P1, T2) -> features."""
    pre = preprocess_sources(train, descriptions, attributes, stemmer=stemmer,
                             materialize_pairs=with_cosine, spaced=separator_aware)
    return ft.relevance_features(pre, separator_aware=separator_aware, with_cosine=with_cosine)


def feature_table_reference_order(train: DataFrame, descriptions: DataFrame,
                                  attributes: DataFrame, stemmer: str = "porter2",
                                  with_cosine: bool = True) -> DataFrame:
    """The same features, computed in the order merge -> lower -> stem."""
    pre = ft.preprocess(merge_sources(train, descriptions, attributes), stemmer=stemmer)
    return ft.relevance_features(pre, with_cosine=with_cosine)


def flagship(spark: SparkSession, sf_dir: str, stemmer: str = "porter2") -> DataFrame:
    """Features of every query-product pair of the derived test tables."""
    feats = feature_table(*fixtures(spark, sf_dir), stemmer=stemmer, with_cosine=True)
    return feats.select("id", "product_uid", "relevance", "title_term_similarity", "num_of_attr",
                        *ft.MODEL_FEATURES)


def run_relevance(spark: SparkSession, train_path: str, descriptions_path: str,
                  attributes_path: str, fmt: str = "csv", stemmer: str = "porter2",
                  seed: int = 42, sample_fraction: float | None = None,
                  parallelism: int = 4, fit_forest: bool = True,
                  csv_null_value: str | None = None, csv_multi_line: bool = False) -> dict:
    """The full run, returning tables instead of printing them.

    Reads the three sources (``csv_multi_line`` when quoted fields span lines), optionally samples pairs (hash rule on ``id``),
    builds features, splits 90/10, tunes linear regression and random forest,
    fits gradient-boosted trees, clusters the binarised table with k-means and
    bisecting k-means, and scores the clusters. Returns a dict of DataFrames:
    ``features``, ``validity``, ``model_metrics`` (model, split, mse) and
    ``cluster_curves`` (model, threshold, precision, recall, f_measure).
    """
    from ..operators import metrics as mt
    from ..operators import models as md
    from ..operators import sampling as sp
    from ..sources.readers import read_sources

    train, descriptions, attributes = read_sources(spark, train_path, descriptions_path,
                                                   attributes_path, fmt, csv_null_value, csv_multi_line)
    if sample_fraction is not None:
        train = sp.sample(train, sample_fraction, key="id")
    feats = feature_table(train, descriptions, attributes, stemmer=stemmer, with_cosine=True)
    split = sp.with_split(feats, (0.9, 0.1), ("train", "test"), key="id")
    table = cut_lineage(ft.assemble(ft.model_table(split, keep=("split",)), keep=("split",)))
    tr, te = table.where(F.col("split") == "train"), table.where(F.col("split") == "test")

    rows = []
    fitted = {"linear_regression": md.linear_regression_tuned(tr, seed, parallelism),
              "gbt": md.gradient_boosted_trees(tr, seed)}
    if fit_forest:
        fitted["random_forest"] = md.random_forest_tuned(tr, seed, parallelism)
    for name, model in fitted.items():
        mse = mt.mean_squared_error(model.transform(te)).first()["mse"]
        rows.append((name, "test", float(mse)))
        if hasattr(model, "validationMetrics"):
            rows.append((name, "validation (best)", float(min(model.validationMetrics))))
    model_metrics = spark.createDataFrame(rows, "model string, split string, mse double")

    binary = md.binarize_labels(table.select("label", "features"))
    curves = None
    for name, fn in (("kmeans", md.kmeans_clusters), ("bisecting_kmeans", md.bisecting_kmeans_clusters)):
        c = md.score_clusters(fn(binary)).withColumn("model", F.lit(name))
        curves = c if curves is None else curves.unionByName(c)
    return {"features": feats, "validity": ft.validity_report(feats), "model_metrics": model_metrics,
            "cluster_curves": curves}
