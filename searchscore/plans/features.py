"""X1 preprocess, X2 relevance features, P5 + P7 model table, E7-E10 extras.

All row-wise features are Column expressions added in one projection over the
merged table, in the same stage as the join: no shuffle. The word splits, lengths and
short edit distances are codegen'd; the distance to a long description and the words
shared with it are Arrow batch functions over the same two columns, one trip
(``text.levenshtein_to_text``, ``text.common_words_with_text``); the multiset overlap of the rest is a
higher-order function (a short lambda over the query's distinct words), which
Spark evaluates interpreted, with the byte search of the long side inside a built-in. Only the title-term cosine (TF-IDF) and the query
frequency aggregate across rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.merge import lower_text
from ..operators.tfidf import with_field_cosine

STEM_SOURCES = {
    "product_title": "stemmed_product_title",
    "product_description": "stemmed_product_description",
    "attributes": "stemmed_attributes",
    "search_term": "stemmed_search_term",
}

# The eleven model features, in model order.
MODEL_FEATURES = (
    "len_of_query", "levenshtein_dist_description", "levenshtein_dist_title",
    "levenshtein_dist_attr", "len_of_attr", "commonWords_term_title",
    "commonWords_term_description", "commonWords_term_attr", "ratio_title",
    "ratio_description", "ratio_attr",
)


def preprocess(merged: DataFrame, stemmer: str = "porter2") -> DataFrame:
    """Lower-case (P1), then stem the four text columns into stemmed_* (T2a-d).

    ``stemmer="none"`` copies the lower-cased texts instead (the form whose
    values are checked against SQL).
    """
    low = lower_text(merged)
    if stemmer == "none":
        return low.withColumns({dst: F.col(src) for src, dst in STEM_SOURCES.items()})
    from ..operators.stemming import stem_columns
    return stem_columns(low, STEM_SOURCES)


def relevance_features(pre: DataFrame, separator_aware: bool = True,
                       with_cosine: bool = False, num_of_attr: bool = True) -> DataFrame:
    """Similarity features of each query-product pair.

    Input: the preprocessed table (stemmed_* columns). Adds the Levenshtein
    distances of the query to description, title and attributes, query and
    attribute lengths, attribute count, common words and their ratios, and,
    with ``with_cosine``, the TF-IDF cosine of title and query.
    """
    q = F.col("stemmed_search_term")
    title, desc, attr = (F.col("stemmed_product_title"), F.col("stemmed_product_description"),
                         F.col("stemmed_attributes"))
    # The query's words and the texts' spaced forms first; a table merged of prepared
    # sources brings those of the product texts (``with_spaced_words``).
    wcols = {"_w_q": tx.words(q, separator_aware), "_s_t": tx.spaced_words(title, separator_aware)}
    for name, c in (("_s_d", desc), ("_s_a", attr)):
        if name not in pre.columns:
            wcols[name] = tx.spaced_words(c, separator_aware, tx.LONG_TEXT if c is desc else None)
    staged = pre.withColumns(wcols)
    first = {
        "levenshtein_dist_description": tx.levenshtein_to_text(desc, q),
        "levenshtein_dist_title": tx.levenshtein_distance(title, q),
        "levenshtein_dist_attr": tx.levenshtein_distance(attr, q),
        "len_of_query": tx.len_of_query(q),
        "len_of_attr": tx.len_of_attributes(attr),
        "commonWords_term_title": tx.common_words(q, title, separator_aware, "_w_q", "_s_t"),
        "commonWords_term_description": tx.common_words_with_text(q, desc, separator_aware, "_w_q", "_s_d"),
        "commonWords_term_attr": tx.common_words(q, attr, separator_aware, "_w_q", "_s_a"),
    }
    if num_of_attr:
        first["num_of_attr"] = tx.num_of_attributes(attr)
    out = staged.withColumns(first).drop(*wcols, "_s_d", "_s_a")
    out = out.withColumns({
        "ratio_title": tx.ratio_of_common_words("commonWords_term_title", "len_of_query"),
        "ratio_description": tx.ratio_of_common_words("commonWords_term_description", "len_of_query"),
        "ratio_attr": tx.ratio_of_common_words("commonWords_term_attr", "len_of_query"),
    })
    if with_cosine:
        out = with_field_cosine(out, "stemmed_search_term", "stemmed_product_title", "title_term_similarity")
    return out


def _input_validity() -> dict:
    """When each model feature is neither NULL nor NaN, stated on its inputs.

    Levenshtein is NULL when either text is NULL; the query length is NULL
    for a NULL query; the ratios are NULL for a NULL query and NaN (0/0) for an
    empty one; lengths of attributes and common-word counts are never NULL.
    """
    q, t, d, a = (F.col("stemmed_search_term"), F.col("stemmed_product_title"),
                  F.col("stemmed_product_description"), F.col("stemmed_attributes"))
    ratio_ok = q.isNotNull() & (F.length(q) > 0)
    return {
        "len_of_query": q.isNotNull(),
        "levenshtein_dist_description": q.isNotNull() & d.isNotNull(),
        "levenshtein_dist_title": q.isNotNull() & t.isNotNull(),
        "levenshtein_dist_attr": q.isNotNull() & a.isNotNull(),
        "len_of_attr": F.lit(True),
        "commonWords_term_title": F.lit(True),
        "commonWords_term_description": F.lit(True),
        "commonWords_term_attr": F.lit(True),
        "ratio_title": ratio_ok,
        "ratio_description": ratio_ok,
        "ratio_attr": ratio_ok,
    }


def valid_rows(features: DataFrame, feature_cols=MODEL_FEATURES) -> DataFrame:
    """Drop rows with a NULL or NaN feature (the assembler's ``skip``).

    For the known features the rule is applied to their input columns: a
    filter on the computed columns would be pushed below the projection with
    every feature expression inlined, computing each feature twice. Unknown
    columns fall back to ``dropna``.
    """
    rules = _input_validity()
    known = [c for c in feature_cols if c in rules]
    other = [c for c in feature_cols if c not in rules]
    cond = F.lit(True)
    for c in known:
        cond = cond & rules[c]
    out = features.where(cond)
    return out.dropna(subset=other) if other else out


def model_table(features: DataFrame, label: str = "relevance", lenient: bool = False,
                feature_cols=MODEL_FEATURES, keep=(), fill_missing: dict | None = None) -> DataFrame:
    """P4 + P5 + P7: label (double) and the eleven features, rows with a NULL
    or NaN feature dropped (what the assembler's ``skip`` mode does).

    Pairs without description or attributes have NULL distances and are
    dropped, as in the reference (D8). ``fill_missing`` ({feature: value})
    fills NULL/NaN of those features instead, keeping the rows.
    """
    lab = F.col(label)
    lab = lab.try_cast("double") if lenient else lab.cast("double")
    cols = [lab.alias("label")] + [F.col(c) for c in feature_cols] + [F.col(c) for c in keep]
    if fill_missing:
        filled = {c: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(v))
                  .otherwise(F.col(c)).cast(features.schema[c].dataType)
                  for c, v in fill_missing.items()}
        rest = [c for c in feature_cols if c not in fill_missing]
        return valid_rows(features.withColumns(filled), rest).select(*cols)
    return valid_rows(features, feature_cols).select(*cols)


def validity_report(features: DataFrame, feature_cols=MODEL_FEATURES) -> DataFrame:
    """One row with the number of pairs, of valid pairs and of dropped pairs."""
    rules = _input_validity()
    cond = F.lit(True)
    for c in feature_cols:
        cond = cond & (rules[c] if c in rules else
                       (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))))
    return (features.agg(F.count("*").cast("long").alias("n_pairs"),
                         F.sum(cond.cast("long")).alias("n_valid"))
            .withColumn("n_dropped", F.col("n_pairs") - F.col("n_valid")))


def assemble(table: DataFrame, feature_cols=MODEL_FEATURES, out: str = "features",
             keep=(), already_valid: bool = True) -> DataFrame:
    """M1: the feature columns as one ML vector.

    Rows of ``model_table`` are already valid, so the assembler keeps them as
    they are; with ``already_valid=False`` it skips rows with NULL/NaN itself.
    """
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out,
                         handleInvalid="keep" if already_valid else "skip")
    return va.transform(table).select("label", out, *keep)


def query_frequency(df: DataFrame, query: str = "search_term", out: str = "query_frequency") -> DataFrame:
    """How often each query occurs in the data set, on every row.

    A grouped count joined back on the query (partial aggregation absorbs a
    hot query; the join is broadcast or skew-split by AQE).
    """
    counts = df.groupBy(query).agg(F.count("*").cast("long").alias(out))
    return df.join(counts, df[query].eqNullSafe(counts[query]), "left").drop(counts[query])


def letter_histogram(df: DataFrame, text_col: str, id_col: str = "id") -> DataFrame:
    """(id, letter, n) counts of each character of each row's text.

    Counted inside the row, so nothing is shuffled."""
    chars = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), ""), lambda c: c != "")
    counts = F.transform(F.array_distinct("_chars"), lambda c: F.struct(
        c.alias("letter"), F.size(F.filter("_chars", lambda x: x == c)).cast("long").alias("n")))
    return (df.select(F.col(id_col).alias("id"), chars.alias("_chars"))
            .select("id", F.explode(counts).alias("_h")).select("id", "_h.letter", "_h.n"))


def with_title_length(df: DataFrame, title: str = "stemmed_product_title",
                      out: str = "len_of_title") -> DataFrame:
    """Character length of the product title."""
    return df.withColumn(out, tx.text_length(title))

