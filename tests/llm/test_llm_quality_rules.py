"""Quality ledger: measurements against plain definitions, policies and ablations."""
import random
import re

from pyspark.sql import types as T

from searchscore.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def texts():
    r = random.Random(6)
    alphabet = ["a", "b", "é", "x y", "#", "a\u00a0b", "\n", "\n\n", "\t", "<p>", "B", "word"]
    return [None, "", " \n ", "a", "a b c a b c", "a a a a", "x\nx\n x\nx", "\u2003\nq\u2003\n\u2003\n\u2003"] + \
        [r.choice([" ", ""]).join(r.choice(alphabet) for _ in range(r.randint(1, 80))) for _ in range(150)]


def test_measurements():
    for t in texts():
        assert Q.measure(t)[:5] == slow(t), repr(t)


def test_verdict_and_edge_cases(spark):
    good = " ".join(f"word{i}x" for i in range(80))
    rows = [(1, good, 0), (1, good, 0), (2, None, 0), (3, "", 0), (4, "one two three " * 40, 0), (5, " ".join(f"w{i}###" for i in range(80)), 0),
            (None, good.upper(), 0), (6, (good + "\n") * 1, 0), (7, " ".join(str(i) for i in range(1000, 1100)), 0), (8, good + " ok " * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = {(r["doc_id"], r["base_failed"], r["kept"]) for r in Q.judge(docs).collect()}
    assert got == {(1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, False, False), (None, False, False), (6, False, True), (7, False, False), (8, True, False)}
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 6]
    empty = spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string"))
    assert Q.judge(empty).count() == 0 and Q.keep_good(empty).count() == 0


def test_policies_and_ablation_agree_with_rows(spark):
    docs = spark.createDataFrame(list(enumerate(texts() + [" ".join(f"w{i}x" for i in range(60 + k)) for k in range(20)])), "doc_id long, text string")
    rows = Q.ledger(docs).cache()
    masks = [r["failure_mask"] for r in rows.collect()]
    for policy in Q.POLICIES:
        full = Q.policy_mask(policy)
        assert rows.where(Q.passes(policy)).count() == sum(m & full == 0 for m in masks)
        for r in Q.ablation(rows, policy).collect():
            bit = r["bit"]
            assert r["n_failed"] == sum(bool(m & bit) for m in masks)
            assert r["n_only_this_rule"] == sum(m & full == bit for m in masks)
            assert r["n_kept"] == sum(m & full == 0 for m in masks)
            assert r["n_kept_without"] == sum(m & full & ~bit == 0 for m in masks)
    assert Q.policy_mask("v1") == 0b1111  # old masks keep their meaning
