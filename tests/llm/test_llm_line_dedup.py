"""Line dedup against brute force and SQL."""
import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

from searchscore.llm import line_dedup as L


def slow(rows, max_ratio, min_pages):
    """rows: (host, text) -> text without boilerplate, in order."""
    pages, lines = defaultdict(set), defaultdict(Counter)
    for host, text in rows:
        if text not in pages[host]:
            pages[host].add(text)
            lines[host].update({x.strip(" \t\r\x0b\f") for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in rows:
        cut = {x for x, n in lines[host].items() if n >= min_pages and n > max_ratio * len(pages[host])}
        out.append(None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" \t\r\x0b\f") not in cut))
    return out


def rows_for(seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(400):
        host = r.choice(["hot"] * 5 + ["b", "c", None])
        text = [r.choice(["menu", " menu", "home\t", "", "  "]) if r.random() < 0.3 else f"line {r.randint(0, 150)}" for _ in range(r.randint(0, 9))]
        rows.append((i, host, None if r.random() < 0.05 else "\n".join(text)))
    return rows + rows[:40]


def test_against_brute_force(spark):
    rows = rows_for()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for ratio, least in ((0.05, 10), (0.02, 2), (0.3, 1)):
        got = sorted(((r["doc_id"], r["text"]) for r in L.drop_boilerplate(docs, ratio, least).collect()), key=str)
        want = sorted(zip([r[0] for r in rows], slow([r[1:] for r in rows], ratio, least)), key=str)
        assert got == want
    assert any(a != b[2] for a, b in zip(slow([r[1:] for r in rows], 0.05, 10), rows))


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(rows_for(), "doc_id long, source string, text string")
    want = sorted(map(str, L.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(L, "BROADCAST_KEYS", -1)
    assert sorted(map(str, L.drop_boilerplate(docs).collect())) == want


def test_copies_of_a_page_are_one_page(spark):
    docs = spark.createDataFrame([(i, "h", "same\nwords") for i in range(50)] + [(100 + i, "h", f"own {i}") for i in range(50)], "doc_id long, source string, text string")
    assert L.drop_boilerplate(docs, dropped="n").where("n > 0").count() == 0


def test_edge_cases(spark):
    long = "a line\n" * 30_000 + "last"
    rows = [(i, "h", f"foot\nown {i}", 7, "x", "k") for i in range(20)] + [(30, "h", "foot", 4, None, "k"), (31, "h", None, None, "x", None), (32, "h", "", 0, "x", "k"), (33, None, long, len(long), "x", "k"), (33, None, long, len(long), "x", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars long, host string, keys string")
    out = L.drop_boilerplate(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == 25 and got[3]["text"] == "own 3" and got[3]["n_chars"] == 5
    assert got[30]["text"] == "" and got[30]["n_chars"] == 0
    assert got[31]["text"] is None and got[31]["n_chars"] is None and got[32]["text"] == "" and got[33]["text"] == long
    empty = spark.createDataFrame([], T.StructType.fromDDL("doc_id long, source string, text string"))
    assert L.drop_boilerplate(empty).count() == 0


def test_columns_of_working_names_stay(spark):
    docs = spark.createDataFrame([(i, "h", f"foot\nown {i}", "a", "b") for i in range(9)], "doc_id long, source string, text string, __host string, __keys string")
    out = L.drop_boilerplate(docs).collect()
    assert {(r["__host"], r["__keys"]) for r in out} == {("a", "b")} and all(r["text"] == f"own {r['doc_id']}" for r in out)


def test_the_ratio_decides_on_small_hosts(spark):
    """A host of 20 pages loses a line of 3 pages, and keeps one of 2 and one of a twentieth."""
    lines = lambda i: "\n".join([f"own {i}", *(["three"] if i < 3 else []), *(["two"] if i < 2 else [])])
    docs = spark.createDataFrame([(i, "h", lines(i)) for i in range(20)] + [(100 + i, "big", f"own {i}" + ("\nfive" if i < 5 else "")) for i in range(100)], "doc_id long, source string, text string")
    got = {r["doc_id"]: r["text"] for r in L.drop_boilerplate(docs).collect()}
    assert got[0] == "own 0\ntwo" and got[2] == "own 2" and got[100] == "own 0\nfive"
