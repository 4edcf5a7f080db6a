"""Hot tokens, portable MinHash and DIMSUM, dictionary stemming, least squares from moments."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from searchscore.operators import models as md
from searchscore.operators import similarity as sim
from searchscore.operators import stemming as st
from searchscore.operators import tfidf as tfm
from searchscore.plans import features as ft
from searchscore.plans import registry as rg
from searchscore.plans.full_run import flagship


def random_texts(seed=5, n=400, hot=0.5):
    r = random.Random(seed)
    return [" ".join((["hot"] if r.random() < hot else []) + [f"w{int(r.paretovariate(0.9)) % 40}" for _ in range(r.randint(1, 5))]) for _ in range(n)]


def all_pairs(texts, max_distance):
    sets = {" ".join(sorted(set(t.split()))): set(t.split()) for t in texts}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) <= max_distance + 1e-9}


@pytest.mark.parametrize("max_distance", [0.5, 0.8])
def test_hot_token_in_blocks_gives_the_same_pairs(spark, max_distance):
    texts = random_texts()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r.set_a, r.set_b) for r in sim.jaccard_pairs(df, "t", max_distance, block_rows=8).collect()]
    assert len(got) == len(set(got))
    assert set(got) == all_pairs(texts, max_distance)


def test_hot_token_is_no_single_join_key(spark):
    df = spark.createDataFrame([(f"hot u{i} v{i % 50}",) for i in range(900)], "t string")
    entries = sim._prefixes(sim.token_sets(df, "t"), 0.2)
    x, y = sim._dealt(entries, "tid", 32)
    for side in (x, y):
        sizes = sorted(r["count"] for r in side.groupBy("tid", "_bi", "_bj").count().where("count > 1").collect())
        assert sizes[-1] <= 3 * 32
    assert entries.groupBy("tid").count().agg(F.max("count")).first()[0] >= 300


def test_candidates_come_up_once(spark):
    df = spark.createDataFrame([(t,) for t in random_texts(7)], "t string")
    cands = sim.candidate_pairs(sim.token_sets(df, "t").checkpoint(), 0.3)
    assert cands.count() == cands.distinct().count()


def test_minhash_is_exact_in_what_it_finds(spark):
    texts = random_texts(9)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = all_pairs(texts, 0.6)
    for kwargs in ({}, {"rows": 2}, {"block_rows": 8}):
        got = [(r.set_a, r.set_b) for r in sim.minhash_pairs(df, "t", 0.6, **kwargs).collect()]
        assert len(got) == len(set(got)) and set(got) <= want
        assert len(got) >= 0.9 * len(want)
    none = spark.createDataFrame([], "t string")
    assert sim.minhash_pairs(none, "t").count() == 0


def test_minhash_bands():
    for t, rows in ((0.2, 1), (0.5, 2), (0.9, 4)):
        bands = sim.minhash_bands(t, rows)
        assert 1 - (1 - t ** rows) ** bands >= 0.97 > 1 - (1 - t ** rows) ** (bands - 1)
    assert sim.minhash_bands(1.0) == 1


def test_minhash_recall_of_titles(spark):
    r = rg.q_minhash_recall(spark, SF_SMALL).first()
    assert r.n_exact > 0 and r.recall >= 0.9


def entries(seed=3, rows=3_000):
    r = random.Random(seed)
    out = []
    for i in range(rows):
        for t in {"hot", *(f"t{int(r.paretovariate(0.7)) % 25}" for _ in range(3))}:
            out.append((i, t, float(r.randint(1, 3))))
    return out


def test_sampled_cosine_inside_its_bound(spark):
    df = spark.createDataFrame(entries(), "id long, term string, value double")
    exact = sim.term_similarity(df, 0.0)
    sampled = sim.term_similarity_sampled(df, threshold=0.5)
    gamma = sim.sampling_gamma(df.select("term").distinct().count(), 0.5)
    r = sim.sampling_error(exact, sampled, gamma).first()
    assert r.n_pairs > 100 and r.inside >= 0.95
    # a mean of zero: on the whole the estimates are neither high nor low
    diff = exact.join(sampled.withColumnRenamed("similarity", "est"), ["term_a", "term_b"], "left").select((F.coalesce("est", F.lit(0.0)) - F.col("similarity")).alias("d"))
    mean = diff.agg(F.avg("d")).first()[0]
    assert abs(mean) < 3 / math.sqrt(gamma * r.n_pairs) + 0.02


def test_sampling_is_exact_for_short_columns(spark):
    rows = [(1, "t", 1.0), (1, "u", 2.0), (2, "t", 3.0), (2, "v", -1.0), (3, "u", 1.0), (3, "v", 1.0), (4, "z", 0.0)]
    df = spark.createDataFrame(rows, "id long, term string, value double")
    a = {(r.term_a, r.term_b): r.similarity for r in sim.term_similarity(df, -1.0).where("term_b <> 'z' and term_a <> 'z'").collect()}
    b = {(r.term_a, r.term_b): r.similarity for r in sim.term_similarity_sampled(df).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_sampling_thins_a_hot_column(spark):
    rows = [(i, t, 1.0) for i in range(20_000) for t in ("hot", f"rare{i % 400}")]
    df = spark.createDataFrame(rows, "id long, term string, value double")
    out = sim.term_similarity_sampled(df, threshold=0.5)
    exact = 50 / (math.sqrt(50) * math.sqrt(20_000))
    got = [r.similarity for r in out.collect()]
    assert sum(got) / 400 == pytest.approx(exact, rel=0.2)
    assert len(got) <= 400


def test_hashed_slots_add_up(spark):
    df = spark.createDataFrame([(1, "a b c a"), (2, "d e f g h i"), (3, "")], "id long, t string")
    tf = tfm.term_frequency(tfm.token_table(df, {"f": "t"}))
    for width in (2, 20_000):
        out = tfm.hashed_term_frequency(tf, width)
        assert out.agg(F.max("slot")).first()[0] < width
        assert {r.id: r.n for r in out.groupBy("id").agg(F.sum("tf").alias("n")).collect()} == {r.id: r.n for r in tf.groupBy("id").agg(F.sum("tf").alias("n")).collect()}
    assert tfm.hashed_term_frequency(tf, 2).count() < tf.count()


def test_dictionary_stemming_equals_stemming_of_texts(spark):
    texts = ["running dogs' --  ran\0quickly,", "  'tis the  season; boxes ", "", None, "123 ...", "naïve cafés running", "a" * 70_000 + " flies", "running dogs' --  ran\0quickly,"]
    df = spark.createDataFrame([(i, t, texts[-i - 1]) for i, t in enumerate(texts)], "id long, t string, u string")
    columns = {"t": "st", "u": "su"}
    one = {r.id: tuple(r) for r in st.stem_columns(df, columns).collect()}
    two = {r.id: tuple(r) for r in st.stem_by_vocabulary(df, columns).collect()}
    assert one == two


def test_dictionary_python_rows_are_words(spark):
    df = spark.createDataFrame([("runs running " * 500,)] * 300 + [("boxes",)], "t string")
    assert st.stem_vocabulary(df, ["t"]).count() == 3
    assert st.stem_by_vocabulary(df, {"t": "s"}).select("s").distinct().count() == 2


def test_flagship_by_dictionary(spark):
    rounded = lambda d: d.withColumn("title_term_similarity", F.round("title_term_similarity", 9))
    a, b = (rounded(flagship(spark, SF_SMALL, stemmer=s)) for s in ("porter2", "dictionary"))
    assert a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def grid_rows(spark):
    return rg._grid_rows(spark, SF_SMALL).checkpoint()


def test_grid_equals_spark_ml(spark, grid_rows):
    from pyspark.ml.regression import LinearRegression
    grid = md.linear_regression_grid(grid_rows, ft.MODEL_FEATURES).collect()
    assert len(grid) == 12
    v = ft.assemble(grid_rows, keep=("split",))
    train, other = v.where("split = 'train'"), v.where("split = 'validation'")
    for r in grid:
        lr = LinearRegression(regParam=r.reg_param, fitIntercept=r.fit_intercept, elasticNetParam=r.elastic_net, maxIter=1000, tol=1e-12)
        m = lr.fit(train)
        assert r.intercept == pytest.approx(m.intercept, abs=1e-6)
        if r.elastic_net < 1:  # two features are equal here, and a pure L1 part does not say which of them to use
            assert list(r.coefficients) == pytest.approx(list(m.coefficients), abs=1e-6)
        mse = m.transform(other).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
        assert r.mse == pytest.approx(mse, abs=1e-6)


def test_solver_edge_cases(spark):
    # a constant feature, a copy of another, and a label without spread
    r = np.random.default_rng(4)
    x = r.normal(size=(200, 3))
    x[:, 1] = 5.0
    rows = [(float(a), float(b), float(a), float(2 * a + 1)) for a, b, _ in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    m = np.zeros((5, 5))
    for c in md.moment_matrix(df, ["a", "b", "c"]).collect():
        m[c["i"], c["j"]] = m[c["j"], c["i"]] = c["value"]
    w, b = md.solve_linear(m, 0.0, 0.0, True)
    assert w[1] == 0 and w[0] + w[2] == pytest.approx(2, abs=1e-6) and b == pytest.approx(1, abs=1e-6)
    assert md.mse_of_moments(m, w, b) == pytest.approx(0, abs=1e-9)
    flat = np.array([[4.0, 6.0, 8.0], [6.0, 14.0, 12.0], [8.0, 12.0, 16.0]])
    assert md.solve_linear(flat, 0.1, 0.5, True)[1] == 2.0
    with pytest.raises(ValueError):
        md.linear_regression_grid(spark.createDataFrame([], "a double, label double, split string"), ["a"])
