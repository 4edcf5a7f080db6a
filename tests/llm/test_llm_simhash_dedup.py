"""SimHash near-dedup against brute force, and its edge cases."""
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.llm import simhash_dedup as S
from searchscore.llm.components import component_roots

from conftest import SF_SMALL


def slow_fingerprint(text, width=4):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, max_bits=4):
    """{fingerprint: least fingerprint reachable} over unsigned ints."""
    left, root = set(prints), {}
    for p in sorted(prints):
        if p in root:
            continue
        todo = [p]
        root[p] = p
        while todo:
            a = todo.pop()
            for b in left:
                if b not in root and (a ^ b).bit_count() <= max_bits:
                    root[b] = p
                    todo.append(b)
    return root


def test_fingerprint_matches_definition():
    r = random.Random(1)
    texts = [None, "", " \t\n", "One", "a b c", "A b\tC d", "é È É a b c d e", "x " * 500] + \
        [" ".join(r.choice(["tea", "oak", "Sun", "é", " x"]) for _ in range(r.randint(1, 60))) for _ in range(40)]
    for t in texts:
        assert S.text_fingerprint(t) & (2**64 - 1) == slow_fingerprint(t)


def test_long_text_in_chunks(monkeypatch):
    t = " ".join(str(i * i % 977) for i in range(5000))
    whole = S.text_fingerprint(t)
    monkeypatch.setattr(S, "HASH_CHUNK", 37)
    assert S.text_fingerprint(t) == whole


@pytest.mark.parametrize("bucket_rows", [256, 3])
def test_links_hold_components_together(spark, bucket_rows):
    r = random.Random(bucket_rows)
    prints = {r.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:25]:  # dense neighbourhoods around some of them
        for _ in range(12):
            q = p
            for b in r.sample(range(64), r.randint(1, 6)):
                q ^= 1 << b
            prints.add(q)
    signed = [struct.unpack("q", struct.pack("Q", p))[0] for p in prints]
    got = component_roots(S.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, bucket_rows)).collect()
    roots = {row["node"] & (2**64 - 1): row["root"] & (2**64 - 1) for row in got}
    want = slow_components(prints)
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(p)
    mine = {}
    for p in prints:
        mine.setdefault(roots.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_allot_is_the_cheapest():
    costs = [[0, 5, 9, 40], [0, 1, 30, 90], [0, 7, 8, 9]]
    cost, t = S.allot(costs, 3)
    assert cost == min(costs[0][a] + costs[1][b] + costs[2][3 - a - b] for a in range(4) for b in range(4 - a))
    assert sum(x + 1 for x in t) == 3


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "u long, v long")
    got = {r["node"]: r["root"] for r in component_roots(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_no_links(spark):
    assert component_roots(spark.createDataFrame([], "u long, v long")).count() == 0


DOCS = "doc_id long, text string, fp string, row int, component_id int"


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None, "a", 1, 1), (3, "", "a", 1, 1), (4, "  ", "a", 1, 1), (None, None, "a", 1, 1), (9, long, "b", 1, 1), (8, long + " x", "b", 1, 1),
            (7, "two words", "c", 1, 1), (7, "two words", "c", 1, 1), (None, "only this one", "d", 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    comp = [(r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in got]
    assert comp.count((7, 7)) == 2 and (5, 3) in comp and (4, 3) in comp and (9, 8) in comp and (-1, 3) in comp and (-1, None) in comp
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 7, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], T.StructType.fromDDL(DOCS))
    assert S.near_duplicates(docs).count() == 0
    assert S.keep_one(docs).count() == 0


def test_query_against_brute_force(spark):
    from searchscore.llm.queries import SPARK_QUERIES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in docs}
    roots = slow_components(set(prints.values()))
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    want = sorted((d, f"{p:016x}", least[roots[p]]) for d, p in prints.items())
    got = SPARK_QUERIES["op7_simhash_dedup"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == want
