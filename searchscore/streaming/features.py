"""Streaming form of the row-wise features (stateless, append mode)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import features as ft
from ..plans.full_run import _prepare
from ..operators.merge import flatten_attributes, product_table


def feature_stream(pairs: DataFrame, descriptions: DataFrame, attributes: DataFrame,
                   stemmer: str = "porter2", separator_aware: bool = True) -> DataFrame:
    """Streaming pairs ⟕ static descriptions ⟕ static attributes -> features.

    ``pairs`` is a streaming DataFrame with the train schema; the product
    tables are static. Each micro-batch is joined and scored independently.
    """
    s = ft.STEM_SOURCES
    tr = _prepare(pairs, {"product_title": s["product_title"], "search_term": s["search_term"]},
                  stemmer)
    de = _prepare(descriptions, {"product_description": s["product_description"]}, stemmer)
    at = _prepare(flatten_attributes(attributes, drop_null_keys=True),
                  {"attributes": s["attributes"]}, stemmer)
    merged = tr.join(product_table(de, at), "product_uid", "left")
    pre = merged.select("product_uid", "id", "product_title", "search_term", "relevance",
                        "product_description", "attributes", *s.values())
    return ft.relevance_features(pre, separator_aware=separator_aware, with_cosine=False)


def write_feature_stream(features: DataFrame, path: str, checkpoint_location: str,
                         trigger_available_now: bool = True):
    """Append the scored pairs to Parquet; the checkpoint makes restarts exactly-once."""
    cols = ["id", "product_uid", F.col("relevance")] + list(ft.MODEL_FEATURES) + ["num_of_attr"]
    writer = (features.select(*cols).writeStream.format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint_location)
              .outputMode("append"))
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
