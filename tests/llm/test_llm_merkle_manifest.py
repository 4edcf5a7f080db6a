"""Merkle manifest against a tree built in one piece."""
import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from searchscore.llm import merkle_manifest as M
from searchscore.llm import numbering as N

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def sides(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 3
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 3])))
        i //= 3
    return out


def slow(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    order = {k: sorted(by[k], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))) for k in names}
    trees = {k: tree([leaf(r, r["text"]) for r in order[k]]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for s, k in enumerate(names):
        for i, r in enumerate(order[k]):
            path, text = sides(trees[k], i) + sides(top, s), r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for a, b in path:
                node = H(a + node + b)
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], top[-1][0], H("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(docs):
    return sorted(map(tuple, M.manifest(docs, M.without_newlines_in_half(docs)).collect()), key=str)


def rows_for(n, hot, others):
    rows = [(i * 3 % n, f"a\nb {i}" if i % 4 else f"a {i}", "en", "hot" if i < hot else f"s{i % others}", i) for i in range(n)]
    return rows + [(None, "x\ny", None, None, None), (None, None, "é", None, 2), (7, "", "en", "alone é", 0), (7, "same\n", "en", "hot", 5), (7, "same\n", "en", "hot", 5)]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_a_tree_in_one_piece(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "SUPERBLOCK_LEVELS", levels)
    monkeypatch.setattr(M, "SUPERBLOCK", 3 ** levels)
    docs = spark.createDataFrame(rows_for(160, 81 if levels < 7 else 60, 11), SCHEMA)
    want = slow(docs.collect())
    out = got(docs)
    assert out == want
    assert {r[-1] for r in out} == {True, False}


def test_full_superblocks_and_single_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "SUPERBLOCK_LEVELS", 2)
    monkeypatch.setattr(M, "SUPERBLOCK", 9)
    for sizes in ([9], [10], [81], [82], [1], [1, 1], [9, 1, 27]):
        rows = [(100 * s + i, f"t\n{i}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
        docs = spark.createDataFrame(rows, SCHEMA)
        assert got(docs) == slow(docs.collect()), sizes


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a\n" * 60_000, "en", "s", 1, "t", 5), (2, None, "en", "s", None, "u", 6)], SCHEMA + ", tree string, pos long")
    assert got(docs) == slow(docs.collect())
    assert M.manifest(docs).where("not verified").count() == 0
    empty = spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
    out = M.manifest(empty)
    assert out.count() == 0
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_numbering_splits_a_hot_group_and_equal_rows(spark):
    rows = spark.createDataFrame([("hot", i // 50) for i in range(900)] + [("hot", 3)] * 500 + [("b", 1), ("a", None), ("a", 0)], "g string, v long")
    from pyspark.sql import functions as F
    out = [tuple(r) for r in N.numbered(rows, "g", [F.col("v").asc_nulls_first()], "pos").collect()]
    for g in ("hot", "a", "b"):
        mine = sorted((p, v) for x, v, p in out if x == g)
        assert [p for p, _ in mine] == list(range(len(mine)))
        vs = [(v is not None, v or 0) for _, v in mine]
        assert vs == sorted(vs)
