"""Term frequency, IDF, TF-IDF and row-wise cosine.

Vectors are kept in long form, one row per (field, id, token), instead of
sparse vectors with hashed slots: exact (no hash collisions), prunable, and
every step is a built-in aggregate or join that Spark partitions by key.

Identical texts are processed once. A pair table repeats each product's
title and description for every query that retrieved it (and one product may
hold a third of all pairs), so the texts are first collapsed to distinct
texts with their row counts, keyed by the 128-bit MD5 of the text:

  rows -> groupBy(field, key) first(text), count      (partial agg: duplicates
                                                        collapse map-side)
  distinct texts -> tokens -> groupBy(field, key, token) count = tf
                                                       (no new shuffle: the
                                                        input is already
                                                        hash-partitioned by key)
  -> groupBy(field, token) sum(row count) = document frequency, in rows
  -> join idf on (field, token)                        (vocabulary: broadcast by
                                                        Spark's size check, else
                                                        sort-merge + AQE skew split)

Per-row results join the per-text table back on (field, key). Aggregates per
row (norms, sums) are computed per text first and joined back as one row.
The number of documents is the sum of the row counts of one field's distinct
texts (NULL texts kept as their own group), one row per field, so no extra
pass over the rows is needed; ``fit_idf`` takes it as a scalar-subquery
Column (``document_count``) instead. Nothing is collected to the driver.

A hashed variant with the built-in ``HashingTF`` (20 000 slots) and ``IDF``
is kept for parity with vector-based callers: ``hashed_tfidf``.
"""
from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..functions.text import occurrences, spaced_tokens, tokenize_ws
from ..session import cut_lineage

# Fixed value: number of hash slots of the hashed term-frequency vectors.
HASHED_NUM_FEATURES = 20000
# At most so many of the most frequent tokens are broadcast with their IDF.
BROADCAST_TOKENS = 200_000


def token_table(df: DataFrame, fields: dict, id_col: str = "id", tokenizer=tokenize_ws,
                keep_empty: bool = False) -> DataFrame:
    """(field, id, token) rows for each text column in ``fields`` {name: column}.

    Empty tokens (from doubled spaces or an empty text) are dropped unless
    ``keep_empty``. NULL texts give no rows.
    """
    def tag(name):
        return lambda t: F.struct(F.lit(name).alias("field"), t.alias("token"))

    per_field = [F.transform(tokenizer(F.col(c) if isinstance(c, str) else c), tag(name))
                 for name, c in fields.items()]
    allf = per_field[0] if len(per_field) == 1 else F.concat(*per_field)
    out = (df.select(F.col(id_col).alias("id"), F.explode(allf).alias("_ft"))
           .select(F.col("_ft.field").alias("field"), "id", F.col("_ft.token").alias("token")))
    if not keep_empty:
        out = out.where(F.col("token") != "")
    return out


def term_frequency(tokens: DataFrame) -> DataFrame:
    """T3 (exact): (field, id, token, tf)."""
    return tokens.groupBy("field", "id", "token").agg(F.count("*").cast("long").alias("tf"))


def document_count(df: DataFrame) -> Column:
    """Number of documents (rows) as a scalar-subquery Column."""
    return df.select(F.count("*")).scalar()


def fit_idf(tf: DataFrame, n_docs, min_doc_freq: int = 0) -> DataFrame:
    """A3: (field, token, df, idf) with idf = ln((m + 1) / (df + 1)).

    Tokens seen in fewer than ``min_doc_freq`` documents get idf 0.
    ``n_docs`` is a number or a Column (e.g. ``document_count(df)``).
    """
    m = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    dfreq = tf.groupBy("field", "token").agg(F.count("*").cast("long").alias("df"))
    idf = F.log((m.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0))
    return dfreq.withColumn(
        "idf", F.when(F.col("df") >= F.lit(min_doc_freq), idf).otherwise(F.lit(0.0)))


def transform_idf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """T4: (field, id, token, tf, idf, weight = tf * idf); unseen tokens weigh 0."""
    return (tf.join(idf.select("field", "token", "idf"), ["field", "token"], "left")
            .withColumn("idf", F.coalesce(F.col("idf"), F.lit(0.0)))
            .withColumn("weight", F.col("tf") * F.col("idf"))
            .select("field", "id", "token", "tf", "idf", "weight"))


def text_rows(df: DataFrame, fields: dict, id_col: str = "id", keep_null: bool = False) -> DataFrame:
    """(field, id, key, text): one row per field of each row.

    ``key`` is the MD5 of the text (16 bytes): equal texts share a key; for
    distinct texts a clash has odds of about n^2 / 2^129. Rows whose text is
    NULL are left out unless ``keep_null`` (then key and text are NULL).
    """
    structs = [F.struct(F.lit(name).alias("field"),
                        (F.col(c) if isinstance(c, str) else c).alias("text"))
               for name, c in fields.items()]
    rows = (df.select(F.col(id_col).alias("id"), F.explode(F.array(*structs)).alias("_s"))
            .select(F.col("_s.field").alias("field"), "id", F.col("_s.text").alias("text")))
    if not keep_null:
        rows = rows.where(F.col("text").isNotNull())
    return rows.withColumn("key", F.unhex(F.md5(F.col("text"))))


def text_tfidf(df: DataFrame, fields: dict, id_col: str = "id", min_doc_freq: int = 0,
               keep_empty: bool = False, tokenizer=tokenize_ws):
    """TF-IDF per distinct text.

    Returns (rows, weights): rows = (field, id, key); weights = (field, key,
    token, tf, idf, weight). Document frequency counts rows, as if every row
    had been tokenised, and ``m`` is the number of rows of ``df``: the sum of
    the row counts of all distinct texts of a field, NULL texts included, so
    no separate pass over ``df`` is needed to count it.
    """
    all_rows = text_rows(df, fields, id_col, keep_null=True)
    groups = all_rows.groupBy("field", "key").agg(F.first("text").alias("text"),
                                                  F.count("*").cast("long").alias("n_rows"))
    # one row per field: bounded by the number of fields, safe to broadcast
    n_docs = groups.groupBy("field").agg(F.sum("n_rows").alias("m"))
    texts = groups.where(F.col("key").isNotNull())
    toks = texts.select("field", "key", "n_rows", F.explode(tokenizer(F.col("text"))).alias("token"))
    if not keep_empty:
        toks = toks.where(F.col("token") != "")
    tf = toks.groupBy("field", "key", "token").agg(F.count("*").cast("long").alias("tf"),
                                                  F.first("n_rows").alias("n_rows"))
    dfreq = (tf.groupBy("field", "token").agg(F.sum("n_rows").cast("long").alias("df"))
             .join(F.broadcast(n_docs), "field"))
    idf_v = F.log((F.col("m").cast("double") + 1.0) / (F.col("df").cast("double") + 1.0))
    idf = dfreq.select("field", "token", "df",
                       F.when(F.col("df") >= F.lit(min_doc_freq), idf_v).otherwise(F.lit(0.0)).alias("idf"))
    weights = (tf.join(idf, ["field", "token"])
               .select("field", "key", "token", "tf", "idf", (F.col("tf") * F.col("idf")).alias("weight")))
    rows = text_rows(df, fields, id_col)
    return rows.select("field", "id", "key"), weights


def tfidf_long(df: DataFrame, fields: dict, id_col: str = "id", min_doc_freq: int = 0,
               keep_empty: bool = False, tokenizer=tokenize_ws) -> DataFrame:
    """TF-IDF of several text columns, each with its own IDF fitted on ``df``.

    One row per (field, id, token): (field, id, token, tf, idf, weight).
    """
    rows, weights = text_tfidf(df, fields, id_col, min_doc_freq, keep_empty, tokenizer)
    return (rows.join(weights, ["field", "key"])
            .select("field", "id", "token", "tf", "idf", "weight"))


def tfidf_summary(df: DataFrame, fields: dict, id_col: str = "id", min_doc_freq: int = 0,
                  keep_empty: bool = False, tokenizer=tokenize_ws) -> DataFrame:
    """Per (field, id): n_terms, n_tokens, sum of weights and L2 norm.

    Computed once per distinct text, then joined to the rows; ids whose text
    has no token are absent.
    """
    rows, weights = text_tfidf(df, fields, id_col, min_doc_freq, keep_empty, tokenizer)
    per_text = weights.groupBy("field", "key").agg(
        F.count("*").cast("long").alias("n_terms"), F.sum("tf").cast("long").alias("n_tokens"),
        F.sum("weight").alias("sum_tfidf"), F.sqrt(F.sum(F.col("weight") ** 2)).alias("l2_norm"))
    return rows.join(per_text, ["field", "key"]).drop("key")


def tfidf_summary_by_product(pairs: DataFrame, products: DataFrame, text: str, key: str = "product_uid",
                             id_col: str = "id", min_doc_freq: int = 0, tokenizer=tokenize_ws) -> DataFrame:
    """``tfidf_summary`` of a product text over the pairs, without taking the text to the pairs.

    Same rows as joining ``pairs`` with ``products`` (left, on ``key``) and
    summarising ``text`` per row: a product's text counts once for each of its
    pairs. Pairs are counted per product, products' texts are weighted by that
    count, and only the four numbers of a text go back to the pairs. A text is
    shuffled once, by its product.
    """
    n_pairs = pairs.groupBy(key).agg(F.count("*").alias("n_pairs"))
    rows = products.where(F.col(key).isNotNull()).select(key, F.col(text).alias("text"), F.unhex(F.md5(F.col(text))).alias("tkey"))
    # several rows of a product multiply its pairs; equal ones are one text with copies
    per_product = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    m = (n_pairs.join(per_product, key, "left")
         .select(F.sum(F.col("n_pairs") * F.coalesce("n_rows", F.lit(1)))).scalar())
    # on the product alone, so that the join and all counts of a product's tokens share one shuffle
    texts = (rows.where("tkey is not null").join(n_pairs, key).groupBy(key, "tkey")
             .agg(F.first("text").alias("text"), F.first("n_pairs").alias("n_pairs"), F.count("*").alias("copies")))
    tf = _text_tokens(texts.withColumn("n_rows", F.col("n_pairs") * F.col("copies")), (key, "tkey"), tokenizer, "copies")
    per_text = _weight_sums(tf, (key, "tkey"), _token_idf(tf, m, min_doc_freq), "copies")
    out = pairs.select(F.col(id_col).alias("id"), key).join(per_text, key)
    return out.select("id", "n_terms", "n_tokens", "sum_tfidf", "l2_norm", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_c")).drop("_c")


TOKEN_COUNTS = ArrayType(StructType([StructField("token", StringType()), StructField("tf", LongType())]))


@F.arrow_udf(TOKEN_COUNTS)
def _token_counts(texts: pa.Array) -> pa.Array:
    """Per lower-case text its distinct tokens with their counts (``bytes.split`` cuts at the
    white space of ``tokenize_ws`` and leaves no empty token)."""
    ends, tokens, counts = [0], [], []
    for text in texts.cast(pa.binary()).to_pylist():
        found = Counter((text or b"").split())
        tokens.extend(found)
        counts.extend(found.values())
        ends.append(len(tokens))
    rows = pa.StructArray.from_arrays([pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["token", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def _text_tokens(texts: DataFrame, keys, tokenizer, *keep) -> DataFrame:
    """(*keys, token, tf, n_rows, *keep) of texts (*keys, text, n_rows, *keep), one row a key; empty tokens dropped."""
    rest = [*keys, "n_rows", *keep]
    if tokenizer is tokenize_ws:  # counted within the text: no row per token and no aggregate
        return texts.select(*rest, F.explode(_token_counts(F.lower("text"))).alias("_c")).select(*rest, "_c.token", "_c.tf")
    toks = texts.select(*rest, F.explode(tokenizer(F.col("text"))).alias("token")).where("token <> ''")
    return toks.groupBy(*keys, "token").agg(F.count("*").cast("long").alias("tf"), *[F.first(c).alias(c) for c in ("n_rows", *keep)])


def _token_idf(tf: DataFrame, m: Column, min_doc_freq: int = 0) -> DataFrame:
    """(token, n_texts, idf): document frequency counts rows, ``n_texts`` the texts. Kept in the
    checkpoint folder: it has several readers, and what it is made of are all tokens."""
    dfreq = tf.groupBy("token").agg(F.sum("n_rows").alias("df"), F.count("*").alias("n_texts"))
    idf = F.log((m.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0))
    return cut_lineage(dfreq.select("token", "n_texts", F.when(F.col("df") >= min_doc_freq, idf).otherwise(0.0).alias("idf")))


def _weight_sums(tf: DataFrame, keys, idf: DataFrame, *keep) -> DataFrame:
    """(*keys, n_terms, n_tokens, sum_tfidf, l2_norm, *keep) of each text, without shuffling its frequent tokens.

    Tokens that stand in at least a ``BROADCAST_TOKENS``-th of all (text, token) rows
    are that many at most; their IDF goes to the texts. A text then is one row with the sums
    of these and one for each of its rarer tokens, which meet their IDF in a join."""
    total = idf.select(F.sum("n_texts")).scalar()
    often = F.col("n_texts") * BROADCAST_TOKENS >= total
    near = tf.join(F.broadcast(idf.where(often).select("token", F.col("idf").alias("_idf"))), "token", "left")
    w = F.col("tf") * F.col("_idf")
    part = near.groupBy(*keys, F.when(F.col("_idf").isNull(), F.col("token")).alias("_rare")).agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens"), F.sum(w).alias("_w"), F.sum(w * w).alias("_w2"), *[F.first(c).alias(c) for c in keep])
    # no token has a space, so the rows of sums find no partner, and are dealt evenly
    at = F.coalesce("_rare", F.concat(F.lit(" "), F.xxhash64(*keys).cast("string")))
    far = part.withColumn("token", at).join(idf.where(~often).select("token", "idf"), "token", "left")
    rare = F.col("n_tokens") * F.col("idf")
    return (far.groupBy(*keys).agg(
        F.sum("n_terms").cast("long").alias("n_terms"), F.sum("n_tokens").cast("long").alias("n_tokens"),
        F.sum(F.coalesce(rare, "_w")).alias("sum_tfidf"), F.sqrt(F.sum(F.coalesce(rare * rare, "_w2"))).alias("l2_norm"),
        *[F.first(c).alias(c) for c in keep]))


def l2_normalize(weights: DataFrame, value: str = "weight") -> DataFrame:
    """M2: weight / ||weights of the same (field, id)||; a zero vector stays zero.

    A window over (field, id): one pass, and a window group is the tokens of
    one text of one row.
    """
    norm = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy("field", "id")))
    return weights.withColumn(value, F.when(norm > 0, F.col(value) / norm).otherwise(F.lit(0.0)))


def cosine_by_id(weights: DataFrame, left: str, right: str, out: str = "cosine") -> DataFrame:
    """M4: cosine of the ``left`` and ``right`` field vectors of each id.

    One aggregation by (id, token) lines the two sides up, one by id sums the
    dot product and both squared norms. Ids where either vector is zero get 0.
    Ids without any token on either side are absent; callers left-join.
    """
    # Hash on id once: the (id, token) and the id aggregates then need no
    # further exchange (hash on id clusters (id, token) as well).
    w = weights.where(F.col("field").isin(left, right)).repartition("id")
    per_token = (w.groupBy("id", "token")
                 .agg(F.sum(F.when(F.col("field") == left, F.col("weight")).otherwise(0.0)).alias("wl"),
                      F.sum(F.when(F.col("field") == right, F.col("weight")).otherwise(0.0)).alias("wr")))
    sums = per_token.groupBy("id").agg(F.sum(F.col("wl") * F.col("wr")).alias("dot"),
                                       F.sum(F.col("wl") ** 2).alias("nl"),
                                       F.sum(F.col("wr") ** 2).alias("nr"))
    denom = F.sqrt(F.col("nl")) * F.sqrt(F.col("nr"))
    return sums.select("id", F.when(denom > 0, F.col("dot") / denom).otherwise(F.lit(0.0)).alias(out))


def with_field_cosine(df: DataFrame, left: str, right: str, out: str = "cosine") -> DataFrame:
    """``df`` with the cosine of TF-IDF(left text) and TF-IDF(right text).

    The value depends on the two texts only, so it is computed once per distinct
    pair of texts and joined back on their keys: every row of ``df`` comes out
    once, whatever its id. Of a pair only the ``left`` vector is expanded (pass
    the shorter text, e.g. the query): the dot product needs the ``right`` weights
    of the left tokens only, looked up by (text key, token). Norms are computed
    once per text. Rows where either text is NULL or its vector zero get 0.
    """
    key = lambda c: F.unhex(F.md5(F.col(c)))  # same key as text_rows
    _, weights = text_tfidf(df.select(F.lit(0).alias("id"), left, right), {"l": left, "r": right}, "id")
    wl = weights.where(F.col("field") == "l").select(F.col("key").alias("key_l"), "token",
                                                     F.col("weight").alias("wl"))
    wr = weights.where(F.col("field") == "r").select(F.col("key").alias("key_r"), "token",
                                                     F.col("weight").alias("wr"))
    norms = weights.groupBy("field", "key").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    nl = norms.where(F.col("field") == "l").select(F.col("key").alias("key_l"), F.col("norm").alias("nl"))
    nr = norms.where(F.col("field") == "r").select(F.col("key").alias("key_r"), F.col("norm").alias("nr"))
    pairs = (df.select(key(left).alias("key_l"), key(right).alias("key_r"))
             .where("key_l is not null and key_r is not null").distinct())
    dots = (pairs.join(wl, "key_l").join(wr, ["key_r", "token"])
            .groupBy("key_l", "key_r").agg(F.sum(F.col("wl") * F.col("wr")).alias("dot")))
    denom = F.col("nl") * F.col("nr")
    cosines = (dots.join(nl, "key_l").join(nr, "key_r").where(denom > 0)
               .select(F.col("key_l").alias("_kl"), F.col("key_r").alias("_kr"), (F.col("dot") / denom).alias("_cos")))
    rows = df.withColumns({"_key_l": key(left), "_key_r": key(right)})
    joined = rows.join(cosines, (F.col("_key_l") == F.col("_kl")) & (F.col("_key_r") == F.col("_kr")), "left")
    return joined.select(*[F.col(c) for c in df.columns if c != out], F.coalesce("_cos", F.lit(0.0)).alias(out))


def product_cosine(pairs: DataFrame, products: DataFrame, query: str, text: str, key: str = "product_uid",
                   id_col: str = "id", out: str = "cosine") -> DataFrame:
    """``field_cosine`` of a pair's query and its product's text, without taking the text through the merge.

    Same rows as joining ``pairs`` with ``products`` (left, on ``key``) and scoring
    every row. A product's text is hashed and cut into tokens once, whatever its
    number of pairs; pairs carry the 16 bytes of its key. A query's tokens bring
    their own IDF in both fields, and how often the text holds them is counted in the
    text itself, so no (pair, token) row exists, and of a text's weights only the norm is kept."""
    md5 = lambda c: F.unhex(F.md5(F.col(c)))  # noqa: E731  same key as text_rows
    keyed = products.where(F.col(key).isNotNull()).select(key, md5(text).alias("_kr"), F.col(text).alias("text"))
    rows = (pairs.select(F.col(id_col).alias("id"), key, md5(query).alias("_kl"), F.col(query).alias("text"))
            .join(keyed.select(key, "_kr"), key, "left"))
    m = rows.select(F.count("*")).scalar()
    queries = rows.where("_kl is not null").groupBy("_kl").agg(F.first("text").alias("text"), F.count("*").alias("n_rows"))
    n_rows = rows.where("_kr is not null").groupBy("_kr").agg(F.count("*").alias("n_rows"))
    texts = keyed.groupBy("_kr").agg(F.first("text").alias("text")).join(n_rows, "_kr")
    tf_l, tf_r = _text_tokens(queries, ("_kl",), tokenize_ws), _text_tokens(texts, ("_kr",), tokenize_ws)
    idf_r = _token_idf(tf_r, m)
    weighed = (tf_l.join(_token_idf(tf_l, m).select("token", "idf"), "token")
               .join(idf_r.select("token", F.col("idf").alias("idf_r")), "token", "left"))
    wl = F.col("tf") * F.col("idf")
    left = weighed.groupBy("_kl").agg(
        F.collect_list(F.when(F.col("idf_r").isNotNull(), F.struct("token", (wl * F.col("idf_r")).alias("w")))).alias("_tokens"), F.sqrt(F.sum(wl * wl)).alias("_nl"))
    right = texts.select("_kr", spaced_tokens("text").alias("_spaced")).join(_weight_sums(tf_r, ("_kr",), idf_r).select("_kr", F.col("l2_norm").alias("_nr")), "_kr")
    scored = rows.select("id", "_kl", "_kr").join(left, "_kl", "left").join(right, "_kr", "left")
    dot = F.aggregate("_tokens", F.lit(0.0), lambda acc, t: acc + t["w"] * occurrences("_spaced", t["token"]))
    norms = F.col("_nl") * F.col("_nr")
    return scored.select("id", F.when(norms > 0, dot / norms).otherwise(F.lit(0.0)).alias(out))


def field_cosine(df: DataFrame, left: str, right: str, id_col: str = "id",
                 out: str = "cosine") -> DataFrame:
    """(id, cosine) for every row of ``df``; see ``with_field_cosine``."""
    return with_field_cosine(df.select(F.col(id_col).alias("id"), left, right), left, right, out).select("id", out)


def title_term_cosine(df: DataFrame, title: str = "stemmed_product_title",
                      term: str = "stemmed_search_term", id_col: str = "id",
                      out: str = "title_term_similarity") -> DataFrame:
    """M4 end to end: (id, cosine of TF-IDF(title), TF-IDF(term)) for every row of df."""
    return field_cosine(df, term, title, id_col, out)


def hashed_tfidf(df: DataFrame, text_col: str, out_prefix: str,
                 num_features: int = HASHED_NUM_FEATURES, min_doc_freq: int = 0) -> DataFrame:
    """T3/A3 hashed form: Tokenizer-equivalent tokens -> ``HashingTF`` -> ``IDF``.

    Adds ``{out_prefix}_words``, ``{out_prefix}_tf`` and ``{out_prefix}_idf``
    vector columns, as the ML transformers produce. NULL texts give empty
    token lists instead of failing.
    """
    from pyspark.ml.feature import IDF, HashingTF

    words = f"{out_prefix}_words"
    tfc, idfc = f"{out_prefix}_tf", f"{out_prefix}_idf"
    tok = df.withColumn(words, tokenize_ws(text_col))
    tfd = HashingTF(inputCol=words, outputCol=tfc, numFeatures=num_features).transform(tok)
    model = IDF(inputCol=tfc, outputCol=idfc, minDocFreq=min_doc_freq).fit(tfd)
    return model.transform(tfd)


def hash_slot(token, num_features: int = HASHED_NUM_FEATURES):
    """The slot of a token: the first eight hexadecimal digits of its MD5, modulo ``num_features``."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % num_features


def hashed_term_frequency(tf: DataFrame, num_features: int = HASHED_NUM_FEATURES) -> DataFrame:
    """T3 hashed form in sparse rows: (field, id, slot, tf) from ``term_frequency``.

    Tokens that fall into one slot are added up; ``num_features`` bounds the width of
    the vocabulary, and the slots are the same in any engine."""
    return (tf.groupBy("field", "id", hash_slot(F.col("token"), num_features).alias("slot"))
            .agg(F.sum("tf").cast("long").alias("tf")))
