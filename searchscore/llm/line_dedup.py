"""Site-relative line dedup: a line is boilerplate on a host when the share of
the host's (distinct) pages that contain it exceeds a ratio.

Pages per (host, line) and per host come from one map-side combined count; only
a 128-bit key of the line is shuffled, never the line. The boilerplate lines of a
host number at most (lines per page) / ratio, whatever the host's size, and are
gathered per host as keys. Texts then drop them in place: they are neither
split into rows nor put together again.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

from .columns import fresh_prefix

#: Share of a host's pages above which a line is boilerplate.
MAX_RATIO = 0.05
#: Pages of the host that must contain the line, whatever the ratio: two copies of
#: a page on a small host make no boilerplate.
MIN_PAGES = 3
#: Boilerplate keys (all hosts together) up to which they are broadcast, 16 bytes
#: each and the host names; beyond it the join shuffles and Spark splits hot hosts.
BROADCAST_KEYS = 500_000


KEY = "struct<a:bigint,b:bigint>"


def _trimmed(line: Column) -> Column:
    """The line without ASCII white space at its ends; what lines are compared by."""
    return F.btrim(line, F.lit(" \t\x0b\f\r"))


def _key(line: Column) -> Column:
    """128 bits: two 64-bit hashes, the second of the line with its length before it."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.length(line), F.lit("line"), line).alias("b"))


def line_counts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """(host, key, pages): distinct pages of the host with the line, each page once.

    Exact copies of a page count as one page: a text held by many rows is left to
    near-duplicate removal and does not turn all its lines into boilerplate. Blank
    lines have no row; the row of a null key holds the host's page total."""
    lines = F.filter(F.array_distinct(F.transform(F.split(F.col(f"`{text}`"), "\n"), _trimmed)), lambda x: x != "")
    keys = F.concat(F.array(F.lit(None).cast(KEY)), F.transform(F.coalesce(lines, F.array().cast("array<string>")), _key))
    one = docs.select(F.col(f"`{host}`").alias("host"), F.xxhash64(F.col(f"`{text}`")).alias("page"), F.explode(keys).alias("key"))
    return one.distinct().groupBy("host", "key").agg(F.count("*").alias("pages"))


def boilerplate(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                host: str = "source", text: str = "text") -> DataFrame:
    """(host, keys): per host the keys of its boilerplate lines. Null is a host of its own."""
    often = cut_lineage(line_counts(docs, host, text).where(F.col("key").isNull() | (F.col("pages") >= min_pages)))
    totals = often.where(F.col("key").isNull()).select(F.col("host").alias("h"), F.col("pages").alias("total"))
    often = often.where(F.col("key").isNotNull()).join(totals, F.col("host").eqNullSafe(F.col("h")))
    return often.where(F.col("pages") > F.lit(max_ratio) * F.col("total")).groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                     host: str = "source", text: str = "text", dropped: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``; all rows and columns stay.

    Lines are compared without white space at their ends, and kept as they are.
    Blank lines stay; a null text stays null and counts as a page without lines;
    an empty text stays empty; a text of boilerplate alone becomes empty. Rows of
    a null host form one host. Repeated rows are pages like any other. ``dropped``
    names a column for the number of lines cut. A column n_chars (long) is kept
    in step with the text."""
    p = fresh_prefix(docs)
    keys = cut_lineage(boilerplate(docs, max_ratio, min_pages, host, text))
    n = keys.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    keys = keys.select(F.col("host").alias(p + "host"), F.col("keys").alias(p + "keys"), F.transform("keys", lambda k: k["a"]).alias(p + "firsts"))
    rows = docs.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, F.col(f"`{host}`").eqNullSafe(F.col(p + "host")), "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    # half of the key tells nearly all lines apart, in an array of plain longs; only a hit is looked up whole
    is_cut = lambda x: F.array_contains(p + "firsts", F.xxhash64(_trimmed(x))) & F.array_contains(p + "keys", _key(_trimmed(x)))
    left = F.when(F.col(p + "keys").isNull(), lines).otherwise(F.filter(lines, lambda x: ~is_cut(x)))
    rows = rows.withColumn(p + "left", left)
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.when(F.size(p + "left") == F.size(lines), F.col(f"`{c}`")).otherwise(F.array_join(p + "left", "\n")).alias(c))
        elif c == "n_chars" and dict(docs.dtypes)[c] == "bigint":
            out.append(F.when(F.size(p + "left") == F.size(lines), F.col(f"`{c}`"))
                       .otherwise(F.length(F.array_join(p + "left", "\n")).cast("long")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    if dropped:
        out.append(F.coalesce(F.size(lines) - F.size(p + "left"), F.lit(0)).cast("long").alias(dropped))
    return rows.select(*out)
