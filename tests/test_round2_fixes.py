"""Running sums with spare columns, cosine with repeated and null ids, fine samples, splittable CSV, whole fixtures."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from searchscore.operators import metrics as mt
from searchscore.operators import sampling as sp
from searchscore.operators import similarity as sim
from searchscore.operators import stemming as st
from searchscore.operators import tfidf as tfm
from searchscore.plans import features as ft
from searchscore.sources.fixtures import fixture

from conftest import SF_SMALL


def test_running_sums_of_many_scores_beside_a_spare_column(spark):
    df = spark.range(2_000_000, numPartitions=8).select((F.xxhash64("id") % 10**12).cast("double").alias("score"), F.lit(1).alias("pos"), F.col("id").alias("neg")) \
        .dropDuplicates(["score"])
    n = df.count()
    for descending in (True, False):
        out = mt.running_sums(df, "score", ["pos"], descending=descending, num_ranges=16)
        r = out.agg(F.max("cum_pos"), F.min("cum_pos"), F.count_distinct("cum_pos")).first()
        assert tuple(r) == (n, 1, n)


def test_running_sums_are_exact_with_null_nan_and_ties_of_bounds(spark):
    rng = np.random.default_rng(3)
    v = np.unique(rng.integers(0, 50, 40).astype(float))
    rows = [(float(x), int(i)) for i, x in enumerate(v)] + [(None, 7), (float("nan"), 11), (float("inf"), 13), (float("-inf"), 17)]
    df = spark.createDataFrame(rows, "score double, v long")
    order = lambda x: (0,) if x is None else (3,) if x != x else (1, x)
    for descending in (True, False):
        got = [(r["score"], r["cum_v"], r["total_v"]) for r in mt.running_sums(df, "score", ["v"], descending, 5, totals=True).collect()]
        ranked = sorted(rows, key=lambda r: order(r[0]), reverse=descending)
        want = dict(zip([str(r[0]) for r in ranked], np.cumsum([r[1] for r in ranked])))
        assert {str(s): c for s, c, _ in got} == want and {t for _, _, t in got} == {sum(r[1] for r in rows)}


def test_cosine_with_repeated_and_null_ids(spark):
    pre = spark.createDataFrame([(1, "red oak chair", "oak chair"), (1, "red oak chair", "oak chair"), (2, "blue tin cup", "tin"), (None, "blue tin cup", "cup tin"), (3, None, "x"), (4, "", "")],
                                "id long, t string, q string")
    got = tfm.with_field_cosine(pre, "q", "t", "c").collect()
    assert len(got) == 6 and all(0 <= r["c"] <= 1 + 1e-12 for r in got)
    assert {r["c"] for r in got if r["id"] == 1} == {got[[r["id"] for r in got].index(1)]["c"]}
    assert [r["c"] for r in got if r["id"] is None][0] > 0 and [r["c"] for r in got if r["id"] == 3] == [0.0]


def test_features_keep_the_rows_of_products_with_two_descriptions(spark):
    cols = "id long, product_uid long, stemmed_product_title string, stemmed_search_term string, stemmed_product_description string, stemmed_attributes string"
    pre = spark.createDataFrame([(1, 1, "red oak", "oak", "first", "a b"), (1, 1, "red oak", "oak", "second", "a b"), (2, 2, "tin cup", "cup", "d", None)], cols)
    out = ft.relevance_features(pre, with_cosine=True).collect()
    assert len(out) == 3 and all(r["title_term_similarity"] <= 1 + 1e-12 for r in out)


def test_small_fractions_select(spark):
    df = spark.range(400_000)
    assert 60 <= sp.sample(df, 0.0004, key="id").count() <= 270
    parts = sp.split(df, (0.9995, 0.0005), key="id")
    assert sum(p.count() for p in parts) == 400_000 and 100 <= parts[1].count() <= 330


def test_every_document_and_part_is_used(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    matching = docs.join(parts, docs["doc_id"] == parts["p_partkey"]).count()
    assert fixture(spark, SF_SMALL, "product_descriptions").count() == matching
    brands = fixture(spark, SF_SMALL, "attributes").where("name = 'Brand'")
    assert brands.count() == parts.count()


def test_term_similarity_of_a_long_row(spark):
    entries = spark.createDataFrame(pd.DataFrame({"id": 1, "term": [f"t{i:04}" for i in range(1500)], "value": 1.0}))
    assert sim.term_similarity(entries).count() == 1500 * 1499 // 2


def test_dimsum_runs_without_a_python_rdd(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.sparse(3, [0, 1], [1.0, 1.0]), Vectors.dense([1.0, 0.0])), (Vectors.sparse(3, [0], [1.0]), Vectors.dense([1.0, 2.0]))], ["a", "b"])
    got = {(r["i"], r["j"]): round(r["similarity"], 6) for r in sim.term_similarity_dimsum(df, ["a", "b"], 0.0).collect()}
    assert got[(0, 3)] == 1.0 and got[(0, 1)] == round(1 / 2 ** 0.5, 6) and got[(3, 4)] == round(1 / 2 ** 0.5, 6)


def test_stem_distinct_equals_stem_columns(spark):
    df = spark.createDataFrame([(1, "running dogs", "run"), (2, "running dogs", None), (3, None, "dogs"), (4, "", "run")], "id long, a string, b string")
    cols = {"a": "sa", "b": "sb"}
    assert sorted(map(str, st.stem_distinct(df, cols).collect())) == sorted(map(str, st.stem_columns(df, cols).collect()))


def test_letter_histogram_shuffles_nothing(spark):
    df = spark.createDataFrame([(1, "abca"), (2, None), (3, "")], "id long, t string")
    out = ft.letter_histogram(df, "t")
    assert sorted(map(tuple, out.collect())) == [(1, "a", 2), (1, "b", 1), (1, "c", 1)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_product_level_tfidf_equals_the_pair_level_form(spark):
    pairs = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12), (5, None), (6, 13)], "id long, product_uid long")
    products = spark.createDataFrame([(10, "red oak red"), (11, "tin cup"), (11, "tin cup"), (11, "big tin"), (12, ""), (14, "never seen"), (None, "lost")], "product_uid long, text string")
    joined = pairs.join(products, "product_uid", "left")
    row = lambda df: sorted((r["id"], r["n_terms"], r["n_tokens"], round(r["sum_tfidf"], 9), round(r["l2_norm"], 9)) for r in df.collect())
    want = [r for r in joined.where("text is not null").collect() if r["text"]]
    got = row(tfm.tfidf_summary_by_product(pairs, products, "text"))
    assert len(got) == len(want)
    m, idf = 8, {}  # rows of the left join
    for w in {w for r in want for w in r["text"].split()}:
        idf[w] = np.log((m + 1) / (sum(w in r["text"].split() for r in want) + 1))
    slow = sorted((r["id"], len(set(r["text"].split())), len(r["text"].split()), round(sum(idf[w] for w in r["text"].split()), 9),
                   round(float(np.sqrt(sum((r["text"].split().count(w) * idf[w]) ** 2 for w in set(r["text"].split())))), 9)) for r in want)
    assert got == slow
