"""Conversation trie against a dictionary of all prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from searchscore.llm import conversation_trie as C

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            h = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).hexdigest()
            by[c].append((t is not None, t or 0, h[:30], (r or "", x or "")))
    return {c: [z[3] for z in sorted(v)] for c, v in by.items()}


def lent(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def slow(convs):
    members, kids = defaultdict(list), defaultdict(set)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(turns, convs):
    return sorted(map(tuple, C.prefix_trie(turns, convs).collect()), key=lambda r: r[:2])


def rows_for(seed, n=40):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        shared = r.choice([0, 0, 3, 6, 11])
        for i in range(r.randint(0, 14)):
            rows.append((c, None if r.random() < 0.05 else i, r.choice(["user", None]) if i > shared else "user", "same" if i < shared else r.choice(["a", "b", "é", None])))
    rows += [(60 + c, i, "user", f"copy {i}") for c in range(30) for i in range(5)]
    rows += [(None, 1, "user", "nobody's"), (90, 1, "user", "twice"), (90, 1, "user", "twice")]
    return rows


@pytest.mark.parametrize("segment,id_range,seed", [(1, 7, 1), (2, 4096, 2), (1024, 4096, 3)])
def test_against_all_prefixes(spark, monkeypatch, segment, id_range, seed):
    monkeypatch.setattr(C, "SEGMENT", segment)
    monkeypatch.setattr(C, "ID_RANGE", id_range)
    rows = rows_for(seed)
    turns = C.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert got(*C.with_lent_turns(turns)) == slow(lent(ordered(rows)))
    assert got(*C.plain(turns)) == slow(ordered(rows))


def test_a_long_conversation_and_many_copies(spark):
    rows = [(4, i, "user", f"t{i % 7}") for i in range(9_000)] + [(6, i, "user", f"t{i % 7}") for i in range(4_500)] + [(6, 4_500, "user", "other")]
    rows += [(10_000 + i, t, "user", "copy") for i in range(900) for t in range(2)]
    turns, convs = C.plain(C.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    out = {r[:2]: r for r in got(turns, convs)}
    assert len(out) == 1 + 9_000 + 1 + 2
    assert out[4, 0][3:6] == (902, 2, 3)
    assert out[4, 4_500][3:6] == (2, 2, 2) and out[4, 4_501][3:6] == (1, 1, 1) and out[6, 4_501][2] == 4
    assert out[4, 1][6] == 4_500 * 2
    assert out[10_000, 2][7] == hashlib.sha256(",".join(str(10_000 + i) for i in range(900)).encode()).hexdigest()


def test_edge_cases(spark):
    long = "word " * 100_000
    rows = [(5, 1, "user", long, 1, "x"), (5, 0, None, None, 2, "y"), (6, None, "user", "", 3, "z")]
    df = spark.createDataFrame(rows, SCHEMA + ", depth long, conv string")
    plain = [r[:4] for r in rows]
    turns = C.ordered_turns(df)
    assert got(*C.plain(turns)) == slow(ordered(plain))
    assert got(*C.with_lent_turns(turns)) == slow(lent(ordered(plain)))
    empty = spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
    out = C.prefix_trie(*C.with_lent_turns(C.ordered_turns(empty)))
    assert out.count() == 0 and out.columns[0] == "conv_id"


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in (1, 2, 3, 6, 7)]  # most own turns are left out, and nothing is lent
    want = lent(ordered(rows))
    assert any(not v for v in want.values())
    assert got(*C.with_lent_turns(C.ordered_turns(spark.createDataFrame(rows, SCHEMA)))) == slow(want)
