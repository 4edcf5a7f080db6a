"""Language identification: counts against a plain version, and held-out accuracy."""
import random

import numpy as np
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.llm import language_id as L

LETTERS = L.letter_table()


def slow_subwords(text):
    """Number of subwords, from words with marks."""
    n = 0
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        marked = f"^{word}^"
        n += sum(max(0, len(marked) - k + 1) for k in L.SUBWORDS)
    return n


def test_counts(monkeypatch):
    r = random.Random(2)
    for _ in range(20):
        text = "".join(r.choice("abcé ßİ.\n Ж字1") for _ in range(r.randint(1, 900)))
        whole = L.subword_counts(text, LETTERS)
        assert whole.sum() == slow_subwords(text)
        for chunk in (5, 37):
            monkeypatch.setattr(L, "CHUNK", chunk)
            assert (L.subword_counts(text, LETTERS) == whole).all()
        monkeypatch.setattr(L, "CHUNK", 1 << 18)
    assert L.subword_counts("12 .?", LETTERS).sum() == 0 and L.subword_counts("", LETTERS).sum() == 0


def test_calibration():
    r = np.random.default_rng(1)
    labels = r.integers(0, 3, 4_000)
    logits = r.normal(0, 1, (4_000, 3))
    logits[np.arange(4_000), labels] += 1.5  # the true temperature of 4 times these is 4 / 1.5
    temperature, accept = L.calibrate(logits * 4, labels, 0.05)
    p = L.softmax(logits * 4 / temperature)
    right = p.argmax(axis=1) == labels
    assert 2.4 < temperature < 3 and abs(p.max(axis=1).mean() - right.mean()) < 0.03
    taken = p.max(axis=1) >= accept
    assert taken.any() and (~taken).any() and 1 - right[taken].mean() <= 0.05
    assert L.calibrate(np.zeros((0, 3)), np.zeros(0, int)) == (1.0, 0.0)


def accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = L.identify(docs, ~L.held_out(F.col("doc_id")))
    apart = out.join(docs.select("doc_id", "lang"), "doc_id").where(L.held_out(F.col("doc_id")))
    return apart.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("accepted").cast("int")), F.avg("score")).first()


def test_held_out_accuracy(spark):
    right, accepted, score = accuracy(spark, SF_MID)
    assert right >= 0.99 and accepted >= 0.95 and score <= 1
    assert accuracy(spark, SF_SMALL)[0] >= 0.95


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    away = L.held_out(F.col("doc_id"))
    lied = docs.withColumn("lang", F.when(away, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    one, two = ({r["doc_id"]: tuple(r) for r in L.identify(d, ~away).collect()} for d in (docs, lied))
    assert one == two


def test_edge_cases(spark):
    rows = [(i, w * 5, lang, 1) for i, (w, lang) in enumerate([("the cat and the hat ", "en"), ("der hund und das haus ", "de")] * 12)]
    rows += [(100, None, "en", 1), (101, "", "en", 1), (102, "12 345 !", "en", 1), (103, "the hat " * 60_000, None, 1), (None, "das haus und", "de", 1), (104, "der hund", None, 1)]
    rows += [(0, "the cat and the hat " * 5, "en", 1)] * 50 + [(105, "the hund", "en", 1), (105, "the hund", "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id long")
    out = L.identify(docs, F.lit(True))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and not got[i]["accepted"] for i in (100, 101, 102))
    assert got[103]["lang_pred"] == "en" and got[104]["lang_pred"] == "de" and got[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = L.identify(docs, F.lit(False))
    assert none.count() == len(rows) and none.where("lang_pred <> 'und'").count() == 0
    empty = spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string, lang string"))
    assert L.identify(empty, F.lit(True)).count() == 0


def test_sample_is_bounded_and_even(spark):
    rows = [(i, "en" if i % 50 else "de") for i in range(5_000)]
    got = L.sample(spark.createDataFrame(rows, "id long, lang string"), 150).groupBy("lang").count().collect()
    n = {r["lang"]: r["count"] for r in got}
    assert sum(n.values()) == 150 and 55 <= n["de"] <= 95
