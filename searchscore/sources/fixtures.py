"""Derived inputs built from the generated test tables.

The three source tables of the pipeline (train pairs, product descriptions,
name-value attributes) do not exist in the test data; they are derived from
``orders``, ``part`` and ``documents`` with portable SQL that runs unchanged in
Spark SQL and DuckDB. The texts below are shared by ``queries()`` and
``oracle_sql()`` so both engines start from the same rows.

Table names appear as ``{name}`` placeholders: Spark receives DataFrames for
them (``spark.sql(text, orders=df, ...)``), DuckDB the plain view names.

The CASE branches only shape values: an empty query every 97th order, a doubled
query every 89th; promotional parts share one attribute sheet under product 0,
which no pair has, so their pairs meet no attributes. Every order, part and
document is used, and descriptions keep the whole document text.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import SNAP_LEVELS

# Portable SQL picks a level with split_part, so the list goes in as one text.
RELEVANCE_LEVELS_TEXT = " ".join(str(v) for v in SNAP_LEVELS)

TRAIN_SQL = f"""
select o.o_orderkey as id, o.o_custkey as product_uid,
  concat_ws(' ', p.p_brand, p.p_type, p.p_name, split_part(p.p_name, ' ', 2)) as product_title,
  case when o.o_orderkey % 97 = 0 then ''
       when o.o_orderkey % 89 = 0 then concat(q.p_name, '  ', q.p_name)
       else q.p_name end as search_term,
  split_part('{RELEVANCE_LEVELS_TEXT}', ' ',
    cast(least(10, 4 * ((case when split_part(q.p_name, ' ', 1) = split_part(p.p_name, ' ', 1) then 1 else 0 end)
                      + (case when split_part(q.p_name, ' ', 2) = split_part(p.p_name, ' ', 2) then 1 else 0 end))
                 + o.o_orderkey % 4) + 1 as int)) as relevance
from (select o_orderkey, o_custkey,
             (o_orderkey * 31 + 7) % (select count(*) from {{part}}) as query_partkey
      from {{orders}}) o
join {{part}} q on q.p_partkey = o.query_partkey
join {{part}} p on p.p_partkey = o.o_custkey
"""

DESCRIPTIONS_SQL = """
select p_partkey as product_uid,
       concat_ws(' ', p_type, p_name, text) as product_description
from {part} join {documents} on doc_id = p_partkey
"""

ATTRIBUTES_SQL = """
select product_uid, 'Brand' as name, p_brand as value from {sheet}
union all select product_uid, 'Type', p_type from {sheet}
union all select product_uid, 'Color Family', split_part(p_name, ' ', 1) from {sheet} where p_size > 25
union all select product_uid, 'Size', case when p_size > 5 then cast(p_size as string) end from {sheet}
union all select cast(null as bigint), cast(null as string), cast(null as string) from {region}
""".replace("{sheet}", "(select case when p_type = 'PROMO' then 0 else p_partkey end as product_uid, * from {part}) s")

FIXTURE_SQL = {
    "train": TRAIN_SQL,
    "product_descriptions": DESCRIPTIONS_SQL,
    "attributes": ATTRIBUTES_SQL,
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def duckdb_sql(text: str) -> str:
    """Resolve ``{table}`` placeholders to the plain view names DuckDB has."""
    return text.format(**{t: t for t in BASE_TABLES})


def cte(*names: str) -> str:
    """``with train as (...), ...`` prefix for oracle SQL."""
    parts = [f"{n} as ({duckdb_sql(FIXTURE_SQL[n]).strip()})" for n in names]
    return "with " + ",\n".join(parts) + "\n"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy Spark DataFrame."""
    text = FIXTURE_SQL[name]
    used = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def fixtures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, product_descriptions, attributes) for one scale-factor folder."""
    return (fixture(spark, sf_dir, "train"), fixture(spark, sf_dir, "product_descriptions"),
            fixture(spark, sf_dir, "attributes"))
