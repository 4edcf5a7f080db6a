"""Bucketed storage: tables laid out by the product key, so that merging them moves nothing.

A table is written once into as many buckets as the others, each one file and
sorted by the key. Joins and aggregates on the key then read bucket by bucket,
without an exchange; only a hot product's bucket is larger than the others.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import flatten_attributes, product_table
from ..session import checkpoint_dir


def write_bucketed(df: DataFrame, table: str, key: str = "product_uid", buckets: int = 64, path: str | None = None) -> DataFrame:
    """Save ``df`` as the table ``table``, bucketed and sorted by ``key``, and read it back.

    The rows are dealt by the key first, in the way buckets are, so every bucket is
    one file. ``path`` puts the files outside the warehouse. An existing table is an error."""
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_sources(train: DataFrame, descriptions: DataFrame, attributes: DataFrame, prefix: str,
                   key: str = "product_uid", buckets: int = 64, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs, products) as bucketed tables ``prefix``_pairs and ``prefix``_products."""
    at = lambda name: f"{folder.rstrip('/')}/{prefix}_{name}" if folder else None
    products = product_table(descriptions, flatten_attributes(attributes, key=key, drop_null_keys=True), key)
    return (write_bucketed(train, f"{prefix}_pairs", key, buckets, at("pairs")),
            write_bucketed(products, f"{prefix}_products", key, buckets, at("products")))


def merge_bucketed(pairs: DataFrame, products: DataFrame, key: str = "product_uid") -> DataFrame:
    """J1 + J2 from bucketed tables: rows and columns of ``merge_sources``."""
    merged = pairs.hint("merge").join(products, key, "left")
    return merged.select(key, "id", "product_title", "search_term", "relevance", "product_description", "attributes")


def scratch_name(spark: SparkSession) -> tuple[str, str]:
    """A table prefix of its own and the shared folder, for runs that leave no lasting tables."""
    return f"searchscore_{uuid.uuid4().hex}", checkpoint_dir(spark)
