"""Main text of pages: planted articles, broken markup, templates of hosts."""
import random
from html import escape

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.llm import html_extraction as H

from conftest import SF_SMALL

CASES = [
    (None, ""), ("", ""), ("plain one<p>two &amp; three", "plain one\ntwo & three"), ("no tags &lt; here\n\n x", "no tags < here x"),
    ("<html><head><title>t</title><body><nav>m</nav><article><h1>A</h1><p>x<br>y</p></article><footer>f</footer>", "A\nx y"),
    ("<article><header><h1>T</h1></header><p>x</p><aside>z</aside><form><p>f</p></form><footer>fo</footer><section class='reader-comments'>c</section><p hidden>h</p><p>tail</article>", "T\nx\ntail"),
    ("<div class='sidebar'>side</div><div id=content><p>a <span class='ad'>AD</span> b</p><div class=comments><p>c</p></div><ul><li>one<li>two</ul></div><div>foot</div>", "a b\none\ntwo"),
    ("<article><p>un<b>cl", "uncl"), ("<article><p>x</p><script>if(a<b)'</article>'</script><p>y", "x\ny"), ("<!-- open", ""),
    ("<article><div class='cookie-notice'>n</div><p>ok &nbsp; &#233;&eacute;</p><pre>a\n  b</pre></article>", "ok éé\na b"),
    ("<article><p>one<style>p{}</style> two</p><table><tr><td>1<td>2<tr><td>3</table></article>", "one two\n1\n2\n3"),
    ("<body><button>b<article><p>kept</p></article>", "kept"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article>" + "<p>w</p>" * 20_000 + "</article>", "\n".join(["w"] * 20_000)), ("<article><p>a<!-- <p>b --> c</p></article>", "a c"),
]


@pytest.mark.parametrize("page,want", CASES, ids=range(len(CASES)))
def test_single_pages(page, want):
    assert H._Reader().text(page, None) == want


def test_whole_table_keeps_the_article_and_nothing_else(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract_main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for p in rows:
        r = got[p["page_id"]]
        inner = p["html"].partition("<article>")[2].partition("</article>")[0]
        import html as entities
        import re
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"]) and r["url"] == p["url"]


def site(r, host, n, wrap):
    """Pages of one host with a template of its own around random paragraphs."""
    out = []
    for i in range(n):
        body = [" ".join(r.choice(["oak", "elm", "ash & yew", "fir"]) for _ in range(r.randint(15, 40))) for _ in range(r.randint(2, 5))]
        out.append((f"https://{host}/{i}", wrap("".join(f"<p>{escape(b)}</p>" for b in body), i), "\n".join(body)))
    return out


def test_templates_without_an_article_element(spark):
    r = random.Random(8)
    rows = site(r, "a.org", 12, lambda b, i: f"<body><div class=top><a href=/>Home</a> <a href=/x>Shop {i}</a></div><div class=x1><div class=q>{b}</div></div><div class=z9><a href=/>more of {i}</a></div></body>")
    rows += site(r, "b.org", 12, lambda b, i: f"<table><tr><td><a href=1>one</a></td><td class=w>{b}</td></tr></table><div class='site-footer footer'>end {i}</div>")
    df = spark.createDataFrame([(i, u, h, w) for i, (u, h, w) in enumerate(rows)], "page_id long, url string, html string, text string")
    got = {x["page_id"]: x["text"] for x in H.extract_main_text(df).collect()}
    assert all(got[i] == " ".join(w.split(" ")) for i, (_, _, w) in enumerate(rows))


def test_names():
    for name in ("cookie-notice", "reader-comments", "ad", "ad-box", "adSlot", "social-share", "shareButtons", "newsletter_signup", "page-footer", "comment-list", "navbar-2"):
        assert H._says_cut(name), name
    for name in ("login-guide", "social-policy", "article", "notice-period", "formula", "loading", "admin", "menu-of-the-day", "", "7"):
        assert not H._says_cut(name), name


def extracted(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    return {x["page_id"]: x["text"] for x in H.extract_main_text(df).collect()}


def slow_template(pages):
    """Blocks on at least TEXT_SUPPORT of the distinct pages (lists of blocks of one container)."""
    distinct = {tuple(p) for p in pages}
    each = {b for p in distinct for b in p}
    n = {b: sum(b in p for p in distinct) for b in each}
    known = {b for b in each if n[b] >= H.TEXT_PAGES and n[b] >= H.TEXT_SUPPORT * len(distinct)}
    out = []
    for p in pages:
        mostly = sum(len(b) for b in p if b in known) > H.TEMPLATE_SHARE * sum(map(len, p))
        out.append("\n".join(b for b in p if mostly or b not in known))
    return out


def test_template_text_goes_wherever_it_stands(spark):
    r = random.Random(5)
    rows, want = [], []
    for i in range(30):
        own = [" ".join(r.choice(["oak", "elm", "fir", "yew"]) for _ in range(30)) + f" {i}" for _ in range(3)]
        inside = f"<p>{own[0]}</p><div class='k9z'>Our cookies notice</div><div class='login-guide'>{own[1]}</div><div class='social-policy'><p>{own[2]}</p></div>"
        rows.append((f"https://h.org/{i}", f"<body><article><p>Subscribe for updates every week</p>{inside}</article><div class=q>bye</div></body>"))
        want.append("\n".join(own))
    # another host says the same on a few pages only: nothing tells it from an article
    rows += [(f"https://few.org/{i}", f"<article><p>Subscribe for updates every week</p><p>{i} own</p></article>") for i in range(H.TEXT_PAGES - 1)]
    got = extracted(spark, rows)
    assert [got[i] for i in range(30)] == want
    assert got[30] == "Subscribe for updates every week\n0 own"


def test_copies_are_no_template(spark):
    copy = "<article><p>one long paragraph of the copied article</p><p>and another one</p></article>"
    rows = [(f"https://h.org/{i}", copy) for i in range(40)] + [(f"https://h.org/x{i}", f"<article><p>own {i}</p></article>") for i in range(6)]
    got = extracted(spark, rows)
    assert got[0] == "one long paragraph of the copied article\nand another one" and got[45] == "own 5"
    # near copies: most of the page would be template
    rows = [(f"https://h.org/{i}", f"<article><p>one long paragraph of the copied article</p><p>and another one</p><p>{i}</p></article>") for i in range(40)]
    assert extracted(spark, rows)[7] == "one long paragraph of the copied article\nand another one\n7"


@pytest.mark.parametrize("seed", [1, 2])
def test_template_text_against_brute_force(spark, seed):
    r = random.Random(seed)
    rows, want = [], []
    for host in range(4):
        often = [(f"notice {host} {k}", r.choice([0.3, 0.75, 0.85, 0.95, 1.0])) for k in range(4)]
        pages = []
        for i in range(r.choice([3, 12, 40])):
            p = [b for b, share in often if r.random() < share] + [f"own words {r.randint(0, 60)} {host}" for _ in range(r.randint(3, 8))]
            r.shuffle(p)
            pages.append(p)
        pages += pages[:2]
        rows += [(f"http://h{host}.net/{i}", "<html><article>" + "".join(f"<p>{b}</p>" for b in p) + "</article>") for i, p in enumerate(pages)]
        want += slow_template(pages)
    got = extracted(spark, rows)
    assert [got[i] for i in range(len(rows))] == want


def test_edge_cases(spark):
    rows = [(1, None, "<article>a</article>", 0), (1, None, "<article>a</article>", 0), (None, "x", None, 0), (2, "http://h/", "", 0), (3, "http://h/", "<div>only", 0)]
    got = H.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, main int")).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("3", "only", 4), ("None", "", 0)]
    empty = spark.createDataFrame([], T.StructType.fromDDL("page_id long, url string, html string"))
    assert H.extract_main_text(empty).count() == 0


def test_vectors_fold_to_equal_keys_only_for_equal_vectors(spark):
    df = spark.createDataFrame([("t", 1, 1), ("t", 2, 3), ("u", 2, 3), ("u", 1, 1), ("v", 1, 3), ("v", 2, 1)], "t string, page long, n int")
    keys = {r["t"]: r["k"] for r in df.groupBy("t").agg(F.bit_xor(F.xxhash64(F.lit(1), "page", "n")).alias("k")).collect()}
    assert keys["t"] == keys["u"] != keys["v"]


def test_results_are_held_for_a_slice_of_a_batch_only(spark):
    """A worker kept the blocks of a whole Arrow batch as Python objects."""
    import pandas as pd
    from searchscore.llm import html_extraction as he

    n = 2 * he.SLICE_PAGES + 7
    pieces = [p for (p,) in he.in_slices(pd.Series(range(n)))]
    assert max(map(len, pieces)) == he.SLICE_PAGES and [v for p in pieces for v in p] == list(range(n))
    rows = [(i, f"http://h{i % 3}.org/{i}", f"<html><body><div><p>same line</p></div><article><p>text {i}</p></article></body></html>") for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in he.extract_main_text(pages).collect()}
    assert got == {i: f"text {i}" for i in range(n)}
