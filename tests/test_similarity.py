"""Jaccard pairs, MinHash subset property, term similarity, cosine."""
import itertools

import pytest
from pyspark.sql import functions as F

from searchscore.operators import similarity as sim
from searchscore.operators import tfidf as tfm

TEXTS = ["red bolt", "red bolt", "red gear", "blue gear", "blue gear large", "small ring",
         "hot small ring", "a b c d e", "a b c d f", "a", "", None, "x y"]


def brute_force(texts, max_distance):
    sets = {}
    for t in texts:
        toks = sorted(set(w for w in (t or "").lower().split() if w))
        if toks:
            sets[" ".join(toks)] = set(toks)
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        d = 1 - i / len(sets[a] | sets[b])
        if d <= max_distance + 1e-9:
            out[(a, b)] = round(d, 9)
    return out


@pytest.mark.parametrize("max_distance", [0.0, 0.3, 0.5, 0.8, 0.95])
def test_jaccard_exact_equals_brute_force(spark, max_distance):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    got = {(r.set_a, r.set_b): round(r.jaccard_distance, 9)
           for r in sim.jaccard_pairs(df, "t", max_distance).collect()}
    assert got == brute_force(TEXTS, max_distance)


def test_jaccard_counts_rows_per_set(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    rows = {(r.set_a, r.set_b): (r.n_rows_a, r.n_rows_b) for r in sim.jaccard_pairs(df, "t", 0.8).collect()}
    assert rows[("bolt red", "gear red")] == (2, 1)


def test_jaccard_rejects_full_threshold(spark):
    df = spark.createDataFrame([(1, "a")], "id long, t string")
    with pytest.raises(ValueError):
        sim.jaccard_pairs(df, "t", 1.5)


def test_golden_jaccard(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a c")], "id long, t string")
    r = sim.jaccard_pairs(df, "t", 0.9).first()
    assert r.jaccard_distance == pytest.approx(2 / 3)


def test_minhash_pairs_subset_of_exact(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, t string")
    exact = {(r.set_a, r.set_b): r.jaccard_distance for r in sim.jaccard_pairs(df, "t", 0.8).collect()}
    approx = sim.minhash_pairs(df, "t", 0.8, seed=7).collect()
    for r in approx:
        assert (r.set_a, r.set_b) in exact
        assert r.jaccard_distance == pytest.approx(exact[(r.set_a, r.set_b)])


def test_term_similarity_brute_force(spark):
    rows = [(1, "t", 1.0), (1, "u", 2.0), (2, "t", 3.0), (2, "v", 1.0), (3, "u", 1.0), (3, "v", 1.0)]
    e = spark.createDataFrame(rows, "id long, term string, value double")
    got = {(r.term_a, r.term_b): r.similarity for r in sim.term_similarity(e).collect()}
    cols = {"t": {1: 1.0, 2: 3.0}, "u": {1: 2.0, 3: 1.0}, "v": {2: 1.0, 3: 1.0}}
    norm = {c: sum(x * x for x in v.values()) ** 0.5 for c, v in cols.items()}
    for a, b in [("t", "u"), ("t", "v"), ("u", "v")]:
        dot = sum(cols[a][i] * cols[b].get(i, 0.0) for i in cols[a])
        assert got[(a, b)] == pytest.approx(dot / (norm[a] * norm[b]))


def test_idf_golden(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "c")], "id long, t string")
    tf = tfm.term_frequency(tfm.token_table(df, {"f": "t"}))
    idf = {r.token: r.idf for r in tfm.fit_idf(tf, tfm.document_count(df)).collect()}
    assert idf["a"] == pytest.approx(0.28768207245178085)   # ln(4/3)


def test_long_tfidf_equals_ml_vectors(spark):
    """Exact long-form TF-IDF and cosine against HashingTF + IDF + Normalizer."""
    from pyspark.ml.feature import Normalizer
    df = spark.createDataFrame([(1, "red bolt bolt", "red bolt"), (2, "blue gear", "red gear"),
                                (3, "small ring", "hot plate"), (4, "blue bolt", "blue")],
                               "id long, title string, term string")
    cos = {r.id: r.title_term_similarity for r in tfm.title_term_cosine(df, "title", "term").collect()}
    v = tfm.hashed_tfidf(df, "title", "t")
    v = tfm.hashed_tfidf(v, "term", "q")
    v = Normalizer(inputCol="t_idf", outputCol="nt").transform(v)
    v = Normalizer(inputCol="q_idf", outputCol="nq").transform(v)
    for r in v.collect():
        assert cos[r.id] == pytest.approx(float(r.nt.dot(r.nq)), abs=1e-9)


def test_cosine_bounds(spark):
    from searchscore.plans import registry as rg
    from conftest import SF_SMALL
    cos = rg.q_cosine_title_term(spark, SF_SMALL)
    lo, hi = cos.agg(F.min("title_term_similarity"), F.max("title_term_similarity")).first()
    assert 0.0 <= lo and hi <= 1.0 + 1e-9


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_exact_random_sets(spark, seed):
    import random
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(14)]
    weights = [1.0 / (i + 1) for i in range(14)]          # skewed word frequencies
    texts = [" ".join(rnd.choices(vocab, weights, k=rnd.randint(1, 7))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    for max_distance in (0.1, 0.34, 0.5, 0.67, 0.8, 0.9):
        got = {(r.set_a, r.set_b): round(r.jaccard_distance, 9)
               for r in sim.jaccard_pairs(df, "t", max_distance).collect()}
        assert got == brute_force(texts, max_distance), max_distance


def test_lookup_cosine_equals_expanded_cosine(spark):
    from searchscore.plans import registry as rg
    from conftest import SF_SMALL
    pre = rg._pre(spark, SF_SMALL)
    look = {r.id: r.c for r in tfm.field_cosine(pre, "stemmed_search_term",
                                                "stemmed_product_description", out="c").collect()}
    w = tfm.tfidf_long(pre, {"q": "stemmed_search_term", "d": "stemmed_product_description"})
    exp = {r.id: r.c for r in tfm.cosine_by_id(w, "q", "d", out="c").collect()}
    assert set(exp) <= set(look)
    for i, v in look.items():
        assert v == pytest.approx(exp.get(i, 0.0), abs=1e-9)


def test_summary_equals_long_form(spark):
    from searchscore.plans import registry as rg
    from conftest import SF_SMALL
    pre = rg._pre(spark, SF_SMALL)
    fields = {"t": "stemmed_product_title"}
    summ = {r.id: (r.n_terms, r.n_tokens, r.sum_tfidf) for r in tfm.tfidf_summary(pre, fields).collect()}
    agg = (tfm.tfidf_long(pre, fields).groupBy("id")
           .agg(F.count("*").alias("n"), F.sum("tf").alias("k"), F.sum("weight").alias("s")).collect())
    assert len(agg) == len(summ)
    for r in agg:
        n, k, s = summ[r.id]
        assert (n, k) == (r.n, r.k) and s == pytest.approx(r.s, abs=1e-9)


def test_l2_normalize_unit_norm_and_zero(spark):
    w = spark.createDataFrame([("f", 1, "a", 3.0), ("f", 1, "b", 4.0), ("f", 2, "a", 0.0)],
                              "field string, id long, token string, weight double")
    out = {(r.id, r.token): r.weight for r in tfm.l2_normalize(w).collect()}
    assert out[(1, "a")] == pytest.approx(0.6) and out[(1, "b")] == pytest.approx(0.8)
    assert out[(2, "a")] == 0.0
