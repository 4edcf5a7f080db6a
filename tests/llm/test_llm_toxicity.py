"""Toxicity: grammar, learning and held-out accuracy."""
import random
import zlib

from pyspark.sql import types as T

from searchscore.llm import toxicity as X

from conftest import SF_MID


LEXICON = {"idiot": (X.INSULT, 2.0), "clown": (X.INSULT, 2.0), "kill": (X.THREAT, 2.0)}


def test_transducers():
    g = X.Grammar(LEXICON)
    aimed = g.mass("you idiot.")
    assert aimed == g.mass("idiot, you") == 2.0 * X.AIMED
    assert aimed > g.mass("you are no idiot.") > X.RESIDUE >= g.mass("you are not an idiot.")
    assert aimed > g.mass("she said: you idiot") and aimed > g.mass('"idiot, you", he said')
    assert g.mass('he wrote: "well. you are an idiot"') == 2.0 * X.AIMED * X.REPORTED == g.mass('"you idiot", said an old friend')
    assert g.mass("i will kill you") == 2.0 * X.AIMED > X.RESIDUE >= g.mass("kill the light")
    assert g.mass("you. idiot") == g.mass("you\nidiot") == g.mass("an idiot") <= X.RESIDUE
    assert g.mass("idiot. what a clown") == 4.0 and g.mass("no idiot. a clown") == 2.0 * X.NEGATED + 2.0
    assert g.mass(None) == g.mass("") == g.mass("\n..!") == g.mass("nice day") == 0.0


def test_lone_words_stay_below_at_any_length():
    g = X.Grammar({w: (X.INSULT, X.MOST) for w in ("idiot", "clown")})
    gap = "calm word " * (X.RUN_REACH // 2 + 1)
    for n in (1, 2, 500):
        text = (("an idiot. " + gap) * n)
        assert 0 < g.mass(text) <= X.RESIDUE
        assert X.Model({}, 2.0, X.RESIDUE).probability(g.mass(text)) <= 0.5
    assert g.mass("you idiot. " + gap) == g.mass(("you idiot. " + gap) * 500)  # repeating adds nothing


def slow_mass(words, lexicon):
    """The rules word by word, by looking around each hit."""
    closed, best, last = X.symbols(), 0.0, None
    for i, w in enumerate(words):
        if w not in lexicon:
            continue
        symbol, weight = lexicon[w]
        ends = [k for k, x in enumerate(words) if closed.get(x) in (X.CLAUSE, X.LINE)]
        lo, hi = max([k for k in ends if k < i], default=-1) + 1, min([k for k in ends if k > i], default=len(words))
        near = lambda a, b, what: any(closed.get(x) == what for x in words[max(lo, a):min(hi, b)])
        if near(i - X.NEGATION_REACH, i, X.NEGATION):
            weight *= X.NEGATED
        if near(i - X.REPORT_REACH, i, X.REPORT) or near(i + 1, i + 1 + X.REPORT_REACH, X.REPORT):
            weight *= X.REPORTED
        if near(i - X.AIM_REACH, i + 1 + X.AIM_REACH, X.TARGET):
            best = max(best, weight * X.AIMED)
        best = max(best, X.RESIDUE * weight / X.MOST)
        if symbol == X.INSULT:
            place = sum(closed.get(x, 0) < X.QUOTE for x in words[:i])
            if last and place - last[0] <= X.RUN_REACH:
                best = max(best, last[1] + weight)
            last = place, weight
    return best


def test_machines_against_looking_around():
    r, g = random.Random(4), X.Grammar(LEXICON)
    choice = ["calm"] * 14 + ["idiot", "clown", "kill", "you", "not", "said", ".", "\n"]
    for n in range(600):
        words = [r.choice(choice) for _ in range(r.randint(0, 40))] + ["calm"] * r.choice([0, 45, 70]) + [r.choice(choice) for _ in range(10)]
        assert abs(g.mass(" ".join(words)) - slow_mass(words, LEXICON)) < 1e-9, words


def test_held_out_follows_the_checksum(spark):
    ids = list(range(300)) + [None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", X.held_out(df["doc_id"])).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids}


def test_copies_of_a_text_teach_no_words(spark):
    r = random.Random(1)
    words = [f"w{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"]
    text = lambda extra=(): " ".join(w for x in range(30) for w in [r.choice(words), *([r.choice(extra)] if extra and x % 10 == 0 else [])])
    rows = [(text(["zork"]), 1) for _ in range(40)] + [(text(), 0) for _ in range(200)] + [("copied zebra story told", 1)] * 40
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert "zork" in lexicon and "zebra" not in lexicon


def test_curve():
    slope, middle = X.fit_curve([(0.0, 0, 50), (4.0, 1, 5)])
    assert X.RESIDUE <= middle < 4 and slope > 0
    assert X.fit_curve([(0.0, 0, 50), (0.1, 1, 5)])[1] == X.RESIDUE
    assert X.fit_curve([]) and X.fit_curve([(1.0, 1, 1)]) and X.fit_curve([(0.0, 0, 1)])


def test_sizes_of_the_model_are_parameters(spark):
    rows = [(f"zork blarg {k} w{k % 7}", 1) for k in range(40)] + [(f"w{k % 7} v{k % 5}", 0) for k in range(200)]
    df = spark.createDataFrame(rows, "text string, label int")
    general = set(X.INSULTS + X.THREATS)
    assert len(X.learn_lexicon(df, lexicon_words=1).keys() - general) <= 1
    assert not X.learn_lexicon(df, candidates=0).keys() - general


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = X.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] for r in out if not r["toxic"]) == 0
    toxic = [r["predicted"] for r in out if r["toxic"]]
    assert sum(toxic) >= 0.7 * len(toxic)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "you idiot, pathetic moron", 0), (1, "you idiot, pathetic moron", 0), (2, None, 0), (3, "", 0), (None, "fine", 0), (4, "calm words " * 50_000, 0)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = sorted((str(r["doc_id"]), r["predicted"]) for r in X.score_toxicity(docs, labels).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("3", 0), ("4", 0), ("None", 0)]
    assert X.score_toxicity(docs.limit(0), labels).count() == 0
    assert X.score_toxicity(docs, spark.createDataFrame([], T.StructType.fromDDL("doc_id long, toxic int"))).count() == 6
