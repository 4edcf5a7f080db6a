"""Pfair mixing: windows, deviation, wholeness."""
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from searchscore.llm import mixing as M


def table(spark, counts, schema="doc_id long, source string"):
    rows, n = [], 0
    for s, k in counts.items():
        rows += [(n + i, s) for i in range(k)]
        n += k
    return spark.createDataFrame(rows, schema)


def slow_schedule(ks, period):
    """Earliest deadline first, slot by slot."""
    had, out = Counter(), []
    for t in range(period):
        due = [(-(-(had[s] + 1) * period // k), i, s) for i, (s, k) in enumerate(ks) if had[s] * period // k <= t and had[s] < k]
        s = min(due)[2]
        out.append((s, had[s], t))
        had[s] += 1
    return out


def test_schedule_matches_simulation_and_stays_within_one_block(spark):
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.5), ("d", 0.25), ("e", 0.0)], "source string, weight double")
    ks = [(r["source"], r["k"]) for r in M.shares(weights, 97).orderBy("no").collect()]
    assert sum(k for _, k in ks) == 97 and [s for s, _ in ks] == ["a", "b", "c", "d"]
    got = sorted(((r["source"], r["j"], r["slot"]) for r in M.period_schedule(weights, 97).collect()), key=lambda x: x[2])
    assert got == slow_schedule(ks, 97)
    had = Counter()
    for t, (s, _, _) in enumerate(got, 1):
        had[s] += 1
        assert all(abs(had[x] - k * t / 97) < 1 for x, k in ks)


def test_rows_stay_whole_and_windows_hold(spark):
    docs = table(spark, {"hot": 900, "b": 250, "c": 40, "d": 1, None: 7})
    rows = M.mix(docs, period=50, block_rows=8).collect()
    assert len(rows) == docs.count() == len({r["doc_id"] for r in rows})
    places = defaultdict(list)
    for r in rows:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]
        places[r["source"]].append(r["mix_block"] * 8 + r["mix_row"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    slots = defaultdict(set)
    for r in rows:
        slots[r["mix_slot"]].add((r["source"], r["mix_block"]))
    assert all(len(v) == 1 for v in slots.values())
    # less than one block off the target while every source still has blocks
    ks = {r["source"]: r["k"] for r in M.shares(M.smoothed_weights(docs), 50).collect()}
    ends = min(max(r["mix_slot"] for r in rows if r["source"] == s) for s in ks)
    had = Counter()
    for t in range(ends + 1):
        (s, _), = slots[t]
        had[s] += 1
        assert all(abs(had[x] - k * (t + 1) / 50) < 1 for x, k in ks.items())


def test_same_result_under_any_partitioning(spark):
    docs = table(spark, {"a": 120, "b": 60})
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(M.mix(docs.repartition(7))) == key(M.mix(docs.coalesce(1)))


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a", 5, "x"), (1, "a", 5, "x"), (None, "a", 5, None), (2, None, 5, "y"), (3, "gone", 5, "z")], "doc_id long, source string, mix_slot int, k string")
    rows = M.mix(docs, spark.createDataFrame([("a", 1.0), (None, 1.0), ("gone", 0.0), ("unused", 2.0)], "source string, weight double"), period=8).collect()
    assert len(rows) == 5 and rows[0].__fields__.count("mix_slot") == 1
    assert [r["mix_slot"] for r in rows if r["source"] == "gone"] == [None]
    assert all(r["mix_slot"] is not None for r in rows if r["source"] != "gone")


def test_empty_table_and_too_many_sources(spark):
    assert M.mix(spark.createDataFrame([], T.StructType.fromDDL("doc_id long, source string"))).count() == 0
    with pytest.raises(Exception, match="more sources than"):
        M.mix(table(spark, {str(i): 1 for i in range(9)}), period=8).collect()


def check_true(rows, weights, block_rows):
    """Windows hold, each block has a slot of its own, and no source that still has blocks is a block off its weight."""
    total = sum(weights.values())
    slots = {r["mix_slot"]: (r["source"], r["mix_block"]) for r in rows}
    assert len(slots) == len({(r["source"], r["mix_block"]) for r in rows})
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in rows)
    ends = min(max(t for t, (x, _) in slots.items() if x == s) for s in weights)
    had = Counter()
    for t in range(ends + 1):
        had[slots[t][0]] += 1
        assert all(abs(had[s] - w / total * (t + 1)) < 1 + 1e-4 for s, w in weights.items()), t
    return ends


def test_true_weights_hold_over_many_stretches(spark):
    weights = {f"s{i:02d}": (9.5 if i == 0 else 1.0 + i % 3 / 7) for i in range(20)}
    total = sum(weights.values())
    docs = table(spark, {s: int(5_000 * w / total) + 2 for s, w in weights.items()})
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    assert check_true(M.mix(docs, given, block_rows=1).collect(), weights, 1) > 4 * M.PERIOD


def test_short_stretches_and_many_weights(spark):
    for seed in range(4):
        r = random.Random(seed)
        weights = {f"s{i:02d}": r.choice([0.45, 0.2, 0.05, 0.011, r.random()]) for i in range(r.randint(2, 12))}
        total = sum(weights.values())
        blocks = spark.createDataFrame([(s, int(1_500 * w / total) + 2) for s, w in weights.items()], "source string, blocks long")
        given = spark.createDataFrame(list(weights.items()), "source string, weight double")
        assert check_true(M.true_schedule(given, blocks, 1).collect(), weights, 1) > 1_000


def test_more_sources_than_a_period_has_slots(spark):
    weights = spark.createDataFrame([(f"s{i:04d}", 1.0 if i else 1_050.0) for i in range(M.PERIOD + 51)], "source string, weight double")
    rows = M.mix(table(spark, {"s0000": 320, "s0001": 3}).where("source = 's0000'"), weights).collect()  # half of all slots
    assert len(rows) == 320 and all(abs(r["mix_slot"] - 2 * r["mix_block"]) <= 2 for r in rows)


def test_columns_of_working_names_stay(spark):
    rows = [(i, f"s{i % 3}", f"k{i}", "r", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, __key string, __r string, ___start int")
    for period in (None, 30):
        out = M.mix(docs, period=period)
        got = {r["doc_id"]: (r["__key"], r["__r"], r["___start"]) for r in out.collect()}
        assert out.columns[:5] == docs.columns and got == {i: (k, r, n) for i, _, k, r, n in rows}


def test_sql_of_the_true_weights_agrees_on_unequal_sources(spark, tmpdir_path):
    import duckdb

    from searchscore.llm.oracle import MIX
    sizes = {"a": 2_000, "b": 700, "c": 90, "d": 65, "e": 1, None: 333}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    docs.coalesce(1).write.parquet(f"{tmpdir_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmpdir_path}/documents.parquet/*.parquet')")
    cur = con.execute(MIX)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in ("doc_id", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row")) for r in cur.fetchall())
    out = M.mix(docs).select("doc_id", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row")
    assert sorted(map(tuple, out.collect())) == want and len(want) == len(rows)
    assert len({r[4] for r in want}) > 50
