"""English stemming of text columns.

Stemming has no SQL equivalent, so it is the one Python step of the feature
plan. It runs as a scalar pandas UDF over Arrow batches: each word (a maximal
run of letters and apostrophes) is replaced by its Porter2 stem, everything
else (spaces, NUL separators, digits, punctuation) is kept in place, so the
text keeps its shape and the later word splits still line up. Stems are
memoised per Python worker, and the Zipf-shaped vocabulary keeps the hit rate
high, so the Python cost is close to one dictionary lookup per word.

Several columns stemmed in one ``withColumns`` share one Arrow round trip.
No shuffle is involved; Spark partitions the work like any projection.

``stem_distinct`` stems each distinct text once, for pair tables whose titles and
queries repeat. ``stem_vocabulary`` is the vocabulary form: the distinct words of the given
columns with their stems (a distinct aggregate, then the same helper over the
words only).
"""
from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.porter2 import stem
from ..session import cut_lineage

# Fixed value: what counts as a word to stem (after lower-casing).
WORD = re.compile(r"[a-z']+")
WORD_SQL = "[a-z']+"
NON_WORD_SQL = "[^a-z']+"


def stem_text(text: str | None) -> str | None:
    """Stem every word of a lower-case text; NULL stays NULL."""
    if text is None:
        return None
    return WORD.sub(lambda m: stem(m.group(0)), text)


@F.pandas_udf(T.StringType())
def stem_text_udf(texts: pd.Series) -> pd.Series:
    return texts.map(stem_text, na_action="ignore")


@F.pandas_udf(T.StringType())
def stem_word_udf(words: pd.Series) -> pd.Series:
    return words.map(stem, na_action="ignore")


def stem_columns(df: DataFrame, columns: dict) -> DataFrame:
    """Add ``dst`` = stemmed ``src`` for each item of ``columns`` {src: dst}."""
    return df.withColumns({dst: stem_text_udf(F.col(src)) for src, dst in columns.items()})


def stem_distinct(df: DataFrame, columns: dict) -> DataFrame:
    """``stem_columns`` for texts that repeat: every distinct text is stemmed once.

    The distinct texts of all ``columns`` (keyed by MD5) go through the Python
    helper, and the stems are joined back by key; NULL stays NULL. The Python rows
    are the distinct texts, whatever the number of rows that hold them.
    """
    key = lambda c: F.unhex(F.md5(F.col(c)))
    texts = (df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("text")).where(F.col("text").isNotNull())
             .groupBy(F.unhex(F.md5("text")).alias("_key")).agg(F.first("text").alias("text")))
    stems = texts.select("_key", stem_text_udf(F.col("text")).alias("_stem"))
    out = df
    for src, dst in columns.items():
        one = stems.select(F.col("_key").alias("_k"), F.col("_stem").alias(dst))
        out = out.withColumn("_src", key(src)).join(one, F.col("_src") == F.col("_k"), "left").drop("_src", "_k")
    return out


def stem_by_vocabulary(df: DataFrame, columns: dict) -> DataFrame:
    """``stem_columns`` with a dictionary: only distinct words go through the Python helper.

    The distinct texts of all ``columns`` (keyed by MD5, dealt by key once) are cut
    into words and what stands between them. The words meet the (word, stem)
    dictionary in a join, which Spark broadcasts if the vocabulary is small, and each
    text is put together again in its order, every separator in its place. Rows of
    Python: one a distinct word, whatever the length and number of the texts."""
    key = lambda c: F.unhex(F.md5(F.col(c)))
    texts = (df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("text")).where(F.col("text").isNotNull())
             .select(F.unhex(F.md5("text")).alias("_key"), "text").repartition("_key")
             .groupBy("_key").agg(F.first("text").alias("text")))
    # read for the vocabulary, the words and the separators
    texts = cut_lineage(texts)
    words = texts.select("_key", F.posexplode(F.regexp_extract_all("text", F.lit(WORD_SQL), F.lit(0))).alias("i", "word"))
    vocabulary = cut_lineage(words.select("word").distinct().withColumn("stem", stem_word_udf(F.col("word"))))
    dealt = texts.repartition("_key")
    words = dealt.select("_key", F.posexplode(F.regexp_extract_all("text", F.lit(WORD_SQL), F.lit(0))).alias("i", "word"))
    stems = (words.join(vocabulary, "word").groupBy("_key")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "stem"))), lambda x: x["stem"]).alias("stems")))
    gaps = dealt.select("_key", F.split("text", WORD_SQL, -1).alias("gaps"))
    whole = F.zip_with("gaps", F.coalesce("stems", F.array().cast("array<string>")), lambda g, w: F.concat(g, F.coalesce(w, F.lit(""))))
    done = cut_lineage(gaps.join(stems, "_key", "left").select("_key", F.array_join(whole, "").alias("_stem")))
    out = df
    for src, dst in columns.items():
        one = done.select(F.col("_key").alias("_k"), F.col("_stem").alias(dst))
        out = out.withColumn("_src", key(src)).join(one, F.col("_src") == F.col("_k"), "left").drop("_src", "_k")
    return out


def stem_vocabulary(df: DataFrame, columns) -> DataFrame:
    """(word, stem) for every distinct word of the given text columns.

    Texts are collapsed to distinct texts first (a product's description
    repeats for every pair), then split into words, deduplicated, and only the
    vocabulary goes through the Python helper.
    """
    texts = (df.select(F.explode(F.array(*[F.lower(F.col(c)) for c in columns])).alias("text"))
             .where(F.col("text").isNotNull())
             .groupBy(F.unhex(F.md5("text")).alias("_key"))
             .agg(F.first("text").alias("text")))
    vocab = (texts.select(F.explode(F.split("text", NON_WORD_SQL)).alias("word"))
             .where(F.col("word") != "")
             .distinct())
    return vocab.withColumn("stem", stem_word_udf(F.col("word")))
