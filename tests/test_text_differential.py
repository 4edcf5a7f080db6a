"""Text functions against a direct Python model of the reference semantics
(Java String.split drops trailing empty strings; Scala's intersect on arrays
is a multiset intersection), on random strings with spaces, tabs and NULs."""
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from searchscore.functions import text as tx

ALPHABET = ["a", "b", "c", " ", " ", "\x00", "\t", "B"]


def java_split(s, pattern):
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def common_words_model(a, b, sep):
    if a is None or b is None or a == "" or b == "":
        return 0
    ca, cb = Counter(java_split(a, sep)), Counter(java_split(b, sep))
    return sum(min(n, cb[w]) for w, n in ca.items())


def num_attributes_model(s):
    if s is None or s == "":
        return 0
    return len(java_split(s, "\x00"))


def tokenizer_model(s):
    if s is None:
        return []
    return java_split(s.lower(), r"[ \t\n\x0b\f\r]")


def random_texts(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randint(0, 9)
        out.append(None if rnd.random() < 0.05 else "".join(rnd.choice(ALPHABET) for _ in range(k)))
    return out


def test_functions_match_reference_model(spark):
    a_texts, b_texts = random_texts(11, 600), random_texts(12, 600)
    df = spark.createDataFrame(list(zip(range(600), a_texts, b_texts)), "id long, a string, b string")
    got = df.select("id", tx.common_words("a", "b").alias("cw"),
                    tx.common_words("a", "b", separator_aware=False).alias("cw_raw"),
                    tx.num_of_attributes("a").alias("na"),
                    tx.tokenize_ws("a").alias("tok")).collect()
    for r in got:
        a, b = a_texts[r.id], b_texts[r.id]
        assert r.cw == common_words_model(a, b, "[ \x00]"), (a, b)
        assert r.cw_raw == common_words_model(a, b, " "), (a, b)
        assert r.na == num_attributes_model(a), a
        assert r.tok == tokenizer_model(a), a
