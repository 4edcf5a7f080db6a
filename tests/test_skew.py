"""A product holding a third of all pairs: AQE splits it in the merge join,
and every operator still returns whole, exact results."""
import contextlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from searchscore.operators import merge as mg
from searchscore.operators import similarity as sim
from searchscore.sources import fixtures

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_train(spark):
    train, desc, attrs = fixtures(spark, SF_SMALL)
    hot = desc.select("product_uid").orderBy("product_uid").first()["product_uid"]
    n = train.count()
    # as many extra pairs as there are pairs -> the hot product holds > 1/2
    extra = (spark.range(n)
             .select((F.col("id") + 10_000_000).alias("id"), F.lit(hot).alias("product_uid"),
                     # distinct titles: identical rows would compress to nothing in
                     # the shuffle and never look large in bytes
                     F.concat(F.lit("brand#1 promo hot gear gear "), F.sha2(F.col("id").cast("string"), 256))
                     .alias("product_title"),
                     F.lit("hot gear").alias("search_term"), F.lit("2.5").alias("relevance")))
    return train.unionByName(extra), desc, attrs, hot, 2 * n


def test_hot_product_is_split_and_rows_are_whole(spark):
    train, desc, attrs, hot, total = skewed_train(spark)
    with conf(spark, SKEW_CONF):
        merged = mg.merge_sources(train, desc, attrs)
        rows = merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == total
    assert sum(1 for r in rows if r.product_uid == hot) >= total // 3
    assert "skew=true" in plan, plan


def test_hot_query_is_one_set(spark):
    train, _, _, _, total = skewed_train(spark)
    sets = {r.set_key: r.n_rows for r in sim.token_sets(train, "search_term").collect()}
    assert sets["gear hot"] >= total // 3
    pairs = sim.jaccard_pairs(train, "search_term", 0.8)
    # pairs are between distinct sets: never one row per copy of the hot query
    assert pairs.count() <= len(sets) * (len(sets) - 1) // 2
