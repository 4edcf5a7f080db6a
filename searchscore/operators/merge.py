"""Merge the three sources into one row per query-product pair.

A1 ``flatten_attributes``: one attribute text per product.
J1/J2 ``merge_sources``: pairs left-joined with descriptions and attributes.
P1 ``lower_text``, P2 ``drop_raw_text``, P3 ``rename_stemmed``,
P4 ``relevance_to_double``.

Plan shape: the two product-level inputs (descriptions, flattened attributes)
are joined with each other first (full outer on the product key), and the
pairs meet that product table in a single left join. The result equals the
two chained left joins (each pair gets every description row of its product
times its attribute row, NULL where missing), but the big pair-side join now
reads shuffle stages directly, so AQE can split a product that holds a large
share of the pairs (skew join); with two chained joins on one key AQE cannot
split without adding a shuffle and leaves the hot partition whole. A small
product table is broadcast by Spark's own size check instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_value

# Fixed value: separator between the attributes of one product.
ATTRIBUTE_SEPARATOR = "\x00"

TEXT_COLUMNS = ("product_title", "search_term", "product_description", "attributes")
STEMMED_RENAMES = {
    "stemmed_product_title": "title",
    "stemmed_product_description": "description",
    "stemmed_attributes": "attributes",
    "stemmed_search_term": "search_term",
}


def flatten_attributes(attributes: DataFrame, key: str = "product_uid", name: str = "name",
                       value: str = "value", out: str = "attributes",
                       drop_null_keys: bool = False) -> DataFrame:
    """A1: ``name value`` texts of a product, sorted, joined by NUL.

    Sorting makes the text (and every distance computed on it) independent of
    the order rows arrive in. Rows with a NULL key form one group; it cannot
    match any pair, so ``merge_sources`` drops it before the shuffle.
    """
    src = attributes
    if drop_null_keys:
        src = src.where(F.col(key).isNotNull())
    return (src.select(key, name_value(name, value).alias("_nv"))
            .groupBy(key)
            .agg(F.array_join(F.sort_array(F.collect_list("_nv")), ATTRIBUTE_SEPARATOR).alias(out)))


def flatten_attributes_by_ranges(attributes: DataFrame, key: str = "product_uid", name: str = "name",
                                 value: str = "value", out: str = "attributes", ranges: int | None = None) -> DataFrame:
    """A1 for a product that holds a large share of all attributes: the same rows as ``flatten_attributes``.

    The texts are dealt by ranges of (product, text), so a hot product is sorted in
    many tasks; each range gives one sorted run a product, and the runs are put one
    after another in the order of the ranges. Equal texts are counted before, so
    many copies are one row. What meets in one task is one run a range."""
    n = ranges or int(attributes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = attributes.select(key, name_value(name, value).alias("_nv")).groupBy(key, "_nv").agg(F.count("*").cast("int").alias("_n"))
    dealt = texts.repartitionByRange(n, key, "_nv").withColumn("_part", F.spark_partition_id())
    some = F.transform(F.sort_array(F.collect_list(F.struct("_nv", "_n"))), lambda x: F.array_repeat(x["_nv"], x["_n"]))
    runs = dealt.groupBy(key, "_part").agg(F.array_join(F.flatten(some), ATTRIBUTE_SEPARATOR).alias("_run"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_part", "_run"))), lambda x: x["_run"])
    return runs.groupBy(key).agg(F.array_join(ordered, ATTRIBUTE_SEPARATOR).alias(out))


def product_table(descriptions: DataFrame, flat_attributes: DataFrame,
                  key: str = "product_uid") -> DataFrame:
    """Descriptions ⟗ flattened attributes on the product key (NULL keys dropped:
    they cannot match a pair)."""
    d = descriptions.where(F.col(key).isNotNull())
    a = flat_attributes.where(F.col(key).isNotNull())
    return d.join(a, key, "full")


def merge_sources(train: DataFrame, descriptions: DataFrame, attributes: DataFrame,
                  key: str = "product_uid") -> DataFrame:
    """J1 + J2: pairs ⟕ descriptions ⟕ flattened attributes, on the product key.

    Several description rows for one product multiply the pair, as a left
    join does. Output columns: product_uid, id, product_title, search_term,
    relevance, product_description, attributes.
    """
    flat = flatten_attributes(attributes, key=key, drop_null_keys=True)
    merged = train.join(product_table(descriptions, flat, key), key, "left")
    return merged.select(key, "id", "product_title", "search_term", "relevance",
                         "product_description", "attributes")


def lower_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    """Lower-case the text columns, keep the others in place."""
    cols = [F.lower(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    return df.select(*cols)


def drop_raw_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    """Drop the unstemmed text columns."""
    return df.drop(*columns)


def rename_stemmed(df: DataFrame, renames: dict | None = None) -> DataFrame:
    """stemmed_* columns get the plain names."""
    return df.withColumnsRenamed(renames or STEMMED_RENAMES)


def relevance_to_double(df: DataFrame, col: str = "relevance", lenient: bool = False) -> DataFrame:
    """Relevance text to double. Malformed text raises (ANSI cast);
    ``lenient=True`` turns it into NULL instead."""
    c = F.col(col)
    return df.withColumn(col, c.try_cast("double") if lenient else c.cast("double"))
