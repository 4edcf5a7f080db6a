"""Hand-written golden rows for the Column text functions."""
import math

import pytest
from pyspark.sql import functions as F

from searchscore.functions import text as tx


def one(spark, expr, *values, schema="a string, b string"):
    cols = schema.split(", ")
    row = tuple(values) + (None,) * (len(cols) - len(values))
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("a,b,expected", [
    ("a a b", "a a b b", 3),        # multiset: 'a' twice on both sides
    ("a  b", "c  d", 1),            # inner empty word is a word
    ("a ", "b ", 0),                # trailing separators give no word
    (" ", "a", 0),                  # blank text has no words
    (None, "a", 0),
    ("", "a", 0),
    ("a", None, 0),
    ("x\x00y", "y", 1),             # separator-aware: NUL splits words
])
def test_common_words(spark, a, b, expected):
    assert one(spark, tx.common_words("a", "b"), a, b) == expected


def test_common_words_raw_keeps_nul_words_together(spark):
    assert one(spark, tx.common_words("a", "b", separator_aware=False), "x\x00y", "y") == 0


@pytest.mark.parametrize("text,expected", [("x\x00y\x00", 2), (None, 0), ("", 0), ("\x00\x00", 0),
                                           ("a\x00\x00b", 3), ("one", 1)])
def test_num_of_attributes(spark, text, expected):
    assert one(spark, tx.num_of_attributes("a"), text) == expected


def test_ratio_empty_query_is_nan(spark):
    v = one(spark, tx.ratio_of_common_words(F.lit(0), F.lit(0)), None)
    assert math.isnan(v)
    assert one(spark, tx.ratio_of_common_words(F.lit(1), F.lit(4)), None) == pytest.approx(0.25)
    assert one(spark, tx.ratio_of_common_words(F.lit(None).cast("int"), F.lit(4)), None) is None


def test_levenshtein(spark):
    assert one(spark, tx.levenshtein_distance("a", "b"), "é", "e") == 1   # characters, not bytes
    assert one(spark, tx.levenshtein_distance("a", "b"), None, "a") is None


def test_binary_label_is_strict(spark):
    assert one(spark, tx.binary_label(F.lit(2.0)), None) == 0.0
    assert one(spark, tx.binary_label(F.lit(2.01)), None) == 1.0


@pytest.mark.parametrize("text,expected", [("a  B ", ["a", "", "b"]), ("", [""]), (None, []),
                                           (" a", ["", "a"]), ("   ", []), ("a\tb\nc", ["a", "b", "c"])])
def test_tokenizer(spark, text, expected):
    assert one(spark, tx.tokenize_ws("a"), text) == expected


def test_tokenizer_matches_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer
    texts = ["a  B ", "", " a", "Hello World", "x\ty  z", "trailing   "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ml = Tokenizer(inputCol="t", outputCol="w").transform(df).select("t", "w")
    ours = df.select("t", tx.tokenize_ws("t").alias("w"))
    assert sorted(map(tuple, ml.collect())) == sorted(map(tuple, ours.collect()))


def test_name_value(spark):
    assert one(spark, tx.name_value("a", "b"), None, None) == ""
    assert one(spark, tx.name_value("a", "b"), "Color", None) == "Color"
    assert one(spark, tx.name_value("a", "b"), "Color", "red") == "Color red"


def test_lengths(spark):
    assert one(spark, tx.len_of_attributes("a"), None) == 0
    assert one(spark, tx.len_of_attributes("a"), "") == 0
    assert one(spark, tx.len_of_query("a"), "abc") == 3


@pytest.mark.parametrize("pred,expected", [(1.875, 2.0), (1.0, 1.0), (2.9, 3.0), (1.70, 1.67),
                                           (2.31, 2.33), (0.0, 1.0), (5.0, 3.0)])
def test_snap_to_levels(spark, pred, expected):
    assert one(spark, tx.snap_to_levels("a"), pred, schema="a double") == expected


def test_regex_tokenizer(spark):
    assert one(spark, tx.regex_tokenize("a"), "Hello, World_x  2") == ["hello", "world", "x", "2"]


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    from searchscore.functions.cleaning import STOP_WORDS
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_remove_stop_words_keeps_order_and_repeats(spark):
    from searchscore.functions.cleaning import remove_stop_words
    expr = remove_stop_words(F.split(F.col("a"), " "))
    assert one(spark, expr, "the bolt and the bolt of steel") == ["bolt", "bolt", "steel"]


@pytest.mark.parametrize("text,expected", [
    ("2 x 4 Board, 8 feet", "2 xbi 4 board 8 ft."),
    ("Three 5 gallon buckets", "3 5 gal. buckets"),
    ("12 sq ft tile 90°", "12 sq.ft. tile 90 degrees"),
    ("someone alone", "someone alone"),   # number words only as whole words
])
def test_clean_text(spark, text, expected):
    from searchscore.functions.cleaning import clean_text
    assert one(spark, clean_text("a"), text) == expected
