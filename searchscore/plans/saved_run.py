"""X3 as two steps: fit once and save, then score new pairs, in batches or as a stream.

A saved run is a folder of Parquet tables for each version: the IDF of every field
as fitted on the training pairs, the coefficients of the regression, and one row
that describes both. Nothing in it grows with the rows that are scored.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as md
from ..operators import tfidf as tfm

FIELDS = {"title": "stemmed_product_title", "term": "stemmed_search_term"}


@dataclass
class SavedRun:
    """idf (field, token, df, idf), and per candidate the regression's coefficients."""

    version: str
    idf: DataFrame
    linear: DataFrame

    def cosine(self, pairs: DataFrame, id_col: str = "id", out: str = "title_term_similarity") -> DataFrame:
        """(id, cosine) of title and query under the saved IDF. ``pairs`` has one row an id.

        Words that the training pairs lack weigh nothing; a pair without a known word has 0."""
        tf = tfm.term_frequency(tfm.token_table(pairs, FIELDS, id_col))
        cos = tfm.cosine_by_id(tfm.transform_idf(tf, self.idf), "term", "title", out)
        return pairs.select(F.col(id_col).alias("id")).join(cos, "id", "left").select("id", F.coalesce(out, F.lit(0.0)).alias(out))

    def predict(self, features: DataFrame, out: str = "prediction") -> DataFrame:
        """``features`` with the regression's prediction, from the best saved candidate."""
        best = self.linear.orderBy("mse", "candidate").first()
        total = F.lit(best["intercept"])
        for name, c in zip(best["features"], best["coefficients"]):
            total = total + F.col(name).cast("double") * F.lit(c)
        return features.withColumn(out, total)


def fit_run(pairs: DataFrame, features: DataFrame, feature_cols, path: str, version: str, label: str = "label",
            split: str = "split") -> SavedRun:
    """Fit IDF on ``pairs`` (id and the stemmed texts) and the regression on ``features`` (label, the
    feature columns, ``split``), save both below ``path``/``version`` and load them again."""
    spark = pairs.sparkSession
    to = f"{path.rstrip('/')}/{version}"
    tf = tfm.term_frequency(tfm.token_table(pairs, FIELDS))
    n_docs = pairs.count()
    tfm.fit_idf(tf, n_docs).write.parquet(f"{to}/idf")
    grid = md.linear_regression_grid(features, feature_cols, label, split)
    grid.withColumn("features", F.array(*[F.lit(c) for c in feature_cols])).write.parquet(f"{to}/linear")
    spark.createDataFrame([(version, n_docs)], "version string, n_docs long").write.parquet(f"{to}/run")
    return load_run(spark, path, version)


def load_run(spark: SparkSession, path: str, version: str) -> SavedRun:
    """The saved run of a version; its files are read when it is used."""
    at = f"{path.rstrip('/')}/{version}"
    found = spark.read.parquet(f"{at}/run").first()["version"]
    if found != version:
        raise ValueError(f"{at} holds version {found}")
    return SavedRun(version, spark.read.parquet(f"{at}/idf"), spark.read.parquet(f"{at}/linear"))


def score_stream(pairs: DataFrame, run: SavedRun, path: str, checkpoint_location: str):
    """Score a stream of pairs (id and the stemmed texts): every batch goes through ``SavedRun.cosine``
    and is written as Parquet under its number, so a batch that is run again replaces itself."""
    def batch(rows: DataFrame, number: int) -> None:
        run.cosine(rows).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return (pairs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
