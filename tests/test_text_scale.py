"""Long product texts: their work is per product or per text, and the values stay those of the plain forms."""
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from searchscore.functions import cleaning as cl
from searchscore.functions import text as tx
from searchscore.operators import tfidf as tfm
from searchscore.plans import registry as rg


def test_distance_to_longer_equals_the_table():
    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(7)
    for _ in range(3000):
        letters = r.choice(["ab", "abcé", "abcdefgh "])
        text = "".join(r.choices(letters, k=r.randint(0, 30)))
        word = "".join(r.choices(letters + "z", k=r.randint(0, len(text))))
        assert tx.distance_to_longer(text, word) == table(text, word), (text, word)


def test_long_texts_never_reach_the_cell_table(spark):
    """The built-in distance stands behind a test of length, so a long text costs one search per query character."""
    r = random.Random(3)
    rows = [("".join(r.choices("abc defé", k=n)), q) for n in (5, 200, 256, 3000) for q in ("ab", "fed cab", "zz", "", "é", "x" * 40, None)]
    df = spark.createDataFrame([*rows, (None, "ab")], "t string, q string")
    got = df.select(tx.levenshtein_to_text("t", "q").alias("a"), F.levenshtein("t", "q").alias("b"), "*").collect()
    assert all(x.a == x.b for x in got)
    plan = df.select(tx.levenshtein_to_text("t", "q"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    assert "ArrowEvalPython" in rg.q_levenshtein_all(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_no_array_of_a_product_texts_words(spark):
    """Words of product texts were split and copied once per pair and query word."""
    plan = rg.q_common_words_all(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    spaced = [line for line in plan.splitlines() if "_s_d" in line and "Project" in line]
    assert spaced and "split(stemmed_product_description" not in spaced[-1]


@pytest.mark.parametrize("aware", [True, False])
def test_occurrences(spark, aware):
    text = " a  a b\x00a aa\x00 "
    one = spark.createDataFrame([(text,)], "t string")
    spaced = tx.spaced_words("t", aware)
    words = (text.replace("\x00", " ") if aware else text).split(" ")
    for w in ("a", "aa", "b", "c", "b\x00a"):
        assert one.select(tx.occurrences(spaced, F.lit(w))).first()[0] == (0 if aware and "\x00" in w else words.count(w)), w


@pytest.mark.parametrize("broadcast", [1, 3, 200_000])
def test_weights_of_rare_tokens_meet_their_idf_in_a_join(spark, monkeypatch, broadcast):
    """However many tokens are broadcast, the sums are those of the plain form."""
    monkeypatch.setattr(tfm, "BROADCAST_TOKENS", broadcast)
    pairs = spark.createDataFrame([(i, i % 4, q) for i, q in enumerate(["a b", "c", "", None, "b b x", "a c", "zz", "a"] * 2)], "id long, product_uid long, q string")
    products = spark.createDataFrame([(0, "a b b c\td"), (1, "a"), (1, "a"), (1, "c A e f"), (2, None), (5, "a"), (None, "a")], "product_uid long, t string")
    merged = pairs.join(products, "product_uid", "left")
    key = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    got = tfm.tfidf_summary_by_product(pairs, products, "t").select("id", "n_terms", "n_tokens", "sum_tfidf", "l2_norm")
    want = tfm.tfidf_summary(merged, {"t": "t"}).select("id", "n_terms", "n_tokens", "sum_tfidf", "l2_norm")
    assert key(got.collect()) == key(want.collect())
    assert key(tfm.product_cosine(pairs, products, "q", "t").collect()) == key(tfm.field_cosine(merged, "q", "t").collect())


def test_cosine_takes_no_text_through_the_merge(spark):
    plan = rg.q_cosine_term_description(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "token" in plan and "Generate explode(array(struct" not in plan and "collect_list(_nv" not in plan


def test_guarded_cleaning_equals_the_rules_one_by_one(spark):
    r = random.Random(5)
    parts = ["5", "12", " ", "  ", "in", "inch", "ft", "sq", "cu", "feet", "x", "by", "*", "°", "one", "someone", "nine", "mm", "lb", "oz", ".", "-", "É", "gal", "cm", "\n", "zero"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(2000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = cl.clean_text("t", rules=list(cl.CLEANING_RULES))
    assert df.where(~cl.clean_text("t").eqNullSafe(plain)).collect() == []
    guard = df.select(cl.clean_text("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert cl.UNIT_START in guard and "Contains" in guard or "contains" in guard


def _odd_texts():
    r = random.Random(11)
    parts = ["a", "b", " ", "\x00", "é", "ab", "\n", "\t", "\x0b"]
    rows = [("".join(r.choices(parts, weights=[3, 3, 4, 1, 1, 2, 1, 1, 1], k=n)) + end, "".join(r.choices(parts, k=r.choice([0, 1, 2, 5, 40]))))
            for n in (0, 3, 255, 256, 300, 3000) for end in ("", " ", "  ", "\x00", " \n", "\x00 ") for _ in range(8)]
    rows += [(t, q) for t, _ in rows[::4] for q in ("a  b", " ", "", "  ", None)]
    return [*rows, (None, "a"), (None, None), (" " * 400, "a  b"), (" " * 400 + "a", " a  b"), ("ab " * 200, "ab ab  ab")]


@pytest.mark.parametrize("aware", [True, False])
def test_words_shared_with_long_texts_equal_the_byte_search(spark, aware):
    df = spark.createDataFrame(_odd_texts(), "t string, q string").repartition(3)
    got = tx.common_words_with_text("q", "t", aware, tx.words("q", aware), tx.spaced_words("t", aware, tx.LONG_TEXT))
    assert df.where(~got.eqNullSafe(tx.common_words("q", "t", aware))).collect() == []


def test_distance_and_words_of_long_texts_share_one_trip(spark):
    """Long descriptions were searched per pair and query word in the JVM, on a second copy of the text."""
    plan = rg.q_features_valid(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    trips = [line for line in plan.splitlines() if "ArrowEvalPython" in line and "common_words" in line]
    assert trips and all("_distance_to_longer" in line for line in trips)
    df = spark.createDataFrame([("x" * (tx.LONG_TEXT - 1),), ("x" * tx.LONG_TEXT,)], "t string")
    assert [r[0] is None for r in df.select(tx.spaced_words("t", True, tx.LONG_TEXT)).collect()] == [False, True]


def test_jaccard_with_a_text_equals_the_arrays(spark):
    df = spark.createDataFrame(_odd_texts(), "t string, q string").repartition(3)
    assert df.where(~tx.row_jaccard_to_text("q", "t").eqNullSafe(tx.row_jaccard("q", "t"))).collect() == []


def test_jaccard_cuts_no_description_per_pair(spark):
    plan = rg.q_jaccard_term_description(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "split(" not in plan.replace("split_part(", "") and "_tokens_in_common" in plan


def test_a_text_is_cut_once_for_all_queries_it_meets():
    """Each pair took the text out of Arrow and searched it once per query word."""
    runs = [("x" * 300, ["a", None, "b"]), (None, ["a"]), ("short", ["a"]), ("y" * 300, [None]), ("y" * 299 + "z", ["c", "d"])]
    texts, queries = pa.array([t for t, qs in runs for _ in qs]), pa.array([q for _, qs in runs for q in qs])
    met = []

    def measure(text, some):
        met.append((text.decode(), [q.decode() for q in some]))
        return [len(text) + ord(q) for q in some]

    got = tx._pairs_of_texts(texts, queries, measure, tx.LONG_TEXT)
    assert met == [("x" * 300, ["a", "b"]), ("y" * 299 + "z", ["c", "d"])]
    assert got == [397, None, 398, None, None, None, 399, 400]
    long = pa.array(["a b " * 100] * (2 * tx.PAIRS_AT_ONCE + 3))  # longer than what is held at once
    assert tx._pairs_of_texts(long, pa.array(["b b c"] * len(long)), tx._shared_words) == [2] * len(long)


@pytest.mark.parametrize("at_once", [1, 3, 1 << 20])
def test_words_of_a_text_cut_in_pieces(monkeypatch, at_once):
    monkeypatch.setattr(tx, "BYTES_AT_ONCE", at_once)
    for text in (b"", b" ", b"a", b" a  b a ", b"ab a  ba   ", b"  a"):
        words = text.rstrip(b" ").split(b" ") if text.strip(b" ") else []
        for w in (b"a", b"b", b"ab", b"", b"c"):
            assert tx._count_words(text, {w})[w] == words.count(w), (text, w)


def test_distance_passes_over_the_word_once_an_extra():
    """Every extra searched the text anew for all smaller ones."""
    class Searched(str):
        n = 0

        def find(self, *args):
            self.n += 1
            return super().find(*args)

    text, word = Searched("abcdefgh" * 50), "zabzcdzefzghz"
    assert tx.distance_to_longer(text, word) == len(text) - len(word) + 5
    assert text.n <= 6 * len(word)
