"""Decontamination against brute force over every window."""
import random
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from searchscore.llm import decontamination as D

WORDS = [f"w{i}" for i in range(400)]


def slow_best(text, item, width=5):
    """Greatest weighted Jaccard of the item and any window of its size (0 if none)."""
    a = D.shingles_of((text or "").lower().encode().split(), width)
    b = D.shingles_of((item or "").lower().encode().split(), width)
    if set(a).isdisjoint(b):
        return 0.0
    n, want, best = min(len(a), len(b)), Counter(b), 0.0
    for i in range(len(a) - n + 1):
        have = Counter(a[i:i + n])
        low = sum((have & want).values())
        best = max(best, low / (n + len(b) - low))
    return best


def corpus(seed=3, n=60):
    r = random.Random(seed)
    items = [(k, " ".join(r.choice(WORDS) for _ in range(r.randint(9, 70)))) for k in range(25)]
    docs = []
    for d in range(n):
        words = [r.choice(WORDS) for _ in range(r.randint(0, 300))]
        for _ in range(r.randint(0, 3)):
            part = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 2, 4])):  # changed, dropped and doubled words
                k = r.randrange(len(part))
                part[k:k + 1] = r.choice([[], [r.choice(WORDS)], [part[k]] * 2])
            at = r.randint(0, len(words))
            words[at:at] = part if r.random() < 0.7 else [w.upper() for w in part]
        docs.append((d, r.choice([" ", "\n", "  "]).join(words)))
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    got = D.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(d, k): s for d, t in docs for k, i in items if (s := slow_best(t, i)) >= 0.8}
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == {k: round(s, 9) for k, s in want.items()}
    assert len(want) > 20 and any(s < 1 for s in want.values())
    clean = D.drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_blocks_return_every_fingerprint_within_the_radius():
    r = np.random.default_rng(5)
    index = D.Index([(k, " ".join(r.choice(WORDS, 30))) for k in range(40)], 5, 23)
    (size, at), = index.sizes.items()
    base = at.prints[r.integers(0, 40, 500)]
    flips = np.array([sum(1 << int(b) for b in r.choice(64, r.integers(0, 30), replace=False)) for _ in range(500)], dtype=np.uint64)
    prints = base ^ flips
    got = {(w, i) for w, i, _ in index.candidates(prints, size)}
    near = np.bitwise_count(prints[:, None] ^ at.prints[None, :]) <= 23
    assert got == {(int(w), at.items[k]) for w, k in zip(*near.nonzero())}


def test_windows_left_out_hold_no_item():
    """The least number of known shingles loses no window; posting lists give what all pairs give."""
    r = random.Random(12)
    few = [f"u{i}" for i in range(9)]
    items = [(k, " ".join(r.choice(few) for _ in range(r.randint(5, 30)))) for k in range(60)]
    index, seen = D.Index(items, 5, 64), 0
    for _ in range(120):
        words = [r.choice(few) for _ in range(r.randint(0, 40))]
        part = r.choice(items)[1].split()
        part[r.randrange(len(part))] = r.choice(few)
        text = " ".join(words[:20] + part + words[20:])
        for threshold in (0.3, 0.8):
            want = {k: s for k, i in items if (s := slow_best(text, i)) >= threshold}
            assert {i: x[-1] for i, *x in D.contaminations(text, index, threshold)} == want
            seen += len(want)
    assert seen > 100


def test_share_of_pairs_looked_at():
    """Of all pairs of a window and an item of its size, few are probed."""
    docs, items = corpus(seed=21, n=40)
    index = D.Index(items, 5, 23)
    pairs = kept = 0
    for _, text in docs:
        words = text.lower().encode().split()
        held = np.zeros(max(0, len(words) - 4) + 1, dtype=int)
        held[index.held(words) + 1] = 1
        held = held.cumsum()
        for size, at in index.sizes.items():
            if size < len(held):
                pairs += (len(held) - size) * len(at.items)
                kept += int((held[size:] - held[:-size] >= 16 / 18 * size).sum()) * len(at.items)
    assert kept < pairs / 10  # 6 % measured, in texts full of items


def test_one_scan_for_all_items(spark, tmpdir_path):
    spark.createDataFrame([(i, f"some words of text number {i} here") for i in range(20)], "doc_id long, text string").write.parquet(f"{tmpdir_path}/d")
    items = spark.createDataFrame([(i, f"some words of text number {i} here") for i in range(15_001)], "item_id long, text string")
    out = D.find_contamination(spark.read.parquet(f"{tmpdir_path}/d"), items)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted((r["doc_id"], r["item_id"]) for r in out.where("similarity = 1").collect()) == [(i, i) for i in range(20)]


def test_window_fingerprints_match_single_windows():
    h = np.random.default_rng(2).integers(0, 2**63, 50).astype(np.uint64)
    for size in (1, 7, 50):
        every = D.window_fingerprints(h, size)
        assert len(every) == 51 - size
        assert all(D.window_fingerprints(h[i:i + size], size)[0] == p for i, p in enumerate(every))


def test_edge_cases(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, "  "), (4, "short item"), (None, "one two three four five six seven")], "item_id long, text string")
    text = "x " * 40_000 + "One Two three four five six seven " + "y " * 40_000
    docs = spark.createDataFrame([(1, text, 0), (1, text, 0), (2, None, 0), (3, "", 0), (None, "short\titem", 0), (5, "one two three four", 0)], "doc_id long, text string, item_id int")
    got = sorted((r["doc_id"] or -1, r["item_id"] or -1, r["start_word"], r["n_words"], r["similarity"]) for r in D.find_contamination(docs, bench).collect())
    assert got == sorted([(1, 1, 40000, 7, 1.0)] * 2 + [(1, -1, 40000, 7, 1.0)] * 2 + [(-1, 4, 0, 2, 1.0)])
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([], T.StructType.fromDDL("item_id long, text string"))
    assert D.find_contamination(docs, bench).count() == 0
    assert D.drop_contaminated(docs, bench).count() == 1
    assert D.find_contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_slices_do_not_change_the_result(spark, monkeypatch):
    docs, items = corpus(seed=9, n=25)
    args = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.find_contamination(*args).collect()))
    monkeypatch.setattr(D, "SLICE_ITEMS", 7)
    assert sorted(map(tuple, D.find_contamination(*args).collect())) == whole


def test_short_items_inside_texts(spark):
    r = random.Random(6)
    few = [f"v{i}" for i in range(6)]
    docs = [(d, " ".join(r.choice(few) for _ in range(r.randint(0, 12)))) for d in range(80)] + [(80, None), (81, "Quick  FOX\njumps over it all at once today")]
    items = [(k, " ".join(r.choice(few) for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 4, 5])] + [(9, "quick fox jumps"), (10, "nowhere"), (11, " "), (12, None)]
    got = D.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    short = {(r["doc_id"], r["item_id"]): (r["start_word"], r["n_words"]) for r in got if r["item_id"] != 5}
    want = {}
    for d, t in docs:
        words = (t or "").lower().split()
        for k, i in items:
            item = (i or "").lower().split()
            at = next((a for a in range(len(words) - len(item) + 1) if words[a:a + len(item)] == item), None)
            if 0 < len(item) < 5 and at is not None:
                want[d, k] = (at, len(item))
    assert short == want and (81, 9) in want and all(r["similarity"] == 1.0 for r in got if r["item_id"] != 5)
    clean = D.drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[3:5], "item_id long, text string"))
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, k in want if k in (3, 4)}
