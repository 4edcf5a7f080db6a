"""URL filter: parts, rules and the trees' verdicts."""
import math
import re
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.llm import url_filter as U

from conftest import SF_SMALL

URLS = [None, "", "no scheme", "http://", "http://A.Org", "https://x.example.org/es/1", "https://example.org/en/12?q#f", "ftp://É.COM/fr/x", "http://a.com?x=/fr/", "http://b.com#/de/",
        "http://b.com/de/9", "http://xcom/fr/", "a://b://c/d", "http://notexample.org/es/", "http://a.net/x-1/2.html?a=1&b=2", "http://h/\n/p?q", "://x.org/y"]


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path):
    fits = [(len(r), r, v) for v, r in U.RULES for s, _, p in [r.partition("/")] if (host == s or host.endswith("." + s)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def check(rows):
    for r in rows:
        host, path = slow_parts(r["url"])
        rule, verdict = slow_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
        assert (r["block_score"] is None) == (rule is not None)


def test_parts_rules_and_edge_cases(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[5], "x"), (5, URLS[5], "x")], "page_id long, url string, host string")
    got = U.filter_urls(df)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"] and got.count() == len(URLS) + 2
    check(got.join(df.select("page_id", "url").distinct(), "page_id").collect())
    assert U.filter_urls(spark.createDataFrame([], T.StructType.fromDDL("page_id long, url string"))).count() == 0
    assert U.filter_urls(df.where("page_id = 2")).first()["verdict"] == "block"  # nothing to learn from: even odds


def test_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = U.filter_urls(pages)
    assert got.count() == pages.count()
    check(got.join(pages, "page_id").collect())


def test_features(spark):
    row = U.lexical(spark.createDataFrame([("https://a-b.x.com/p/q22/r.html?u=1&v=2#t",)], "url string").withColumns(
        {"host": U.parts(F.col("url"))[0], "path": U.parts(F.col("url"))[1]})).first()
    u = row["url"]
    n = Counter(u)
    assert abs(row["entropy"] + sum(k / len(u) * math.log2(k / len(u)) for k in n.values())) < 1e-9
    assert (row["depth"], row["n_params"], row["n_hyphens"], row["n_labels"], row["longest_segment"], row["has_extension"], row["is_https"], row["has_fragment"]) == (3, 2, 1, 3, 6, 1, 1, 1)
    assert (row["segment"], row["tld"], row["tail"]) == ("p", "com", "x.com") and row["digit_ratio"] == 4 / len(u)


def test_trees_learn_from_rules_and_hold_out(spark):
    rows = [(i, f"http://s{i % 7}.{'good' if i % 2 else 'bad'}.net/{'en' if i % 2 else 'spam'}/{i}" + ("" if i % 2 else "?a=1&b=2&c=3")) for i in range(600)]
    rules = [("allow", "s1.good.net/"), ("allow", "s3.good.net/"), ("block", "s0.bad.net/"), ("block", "s2.bad.net/"), ("block", "s4.bad.net/")]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()
    assert len(got) > 200 and all(r["verdict"] == ("block" if ".bad." in r["host"] else "allow") for r in got)


def test_every_suffix_value_has_statistics(spark):
    n = 1_500
    rows = [(f"http://h.d{i}.net/p{i}/x", f"h.d{i}.net", f"/p{i}/x", float(i % 2)) for i in range(n)]
    labelled = U.lexical(spark.createDataFrame(rows, "url string, host string, path string, url_label double"))
    got = U.with_shares(labelled, U.suffix_statistics(labelled), 0.5, leave_out=False).collect()
    assert len(got) == n
    for r in got:
        share = (r["url_label"] + U.PRIOR * 0.5) / (1 + U.PRIOR)
        assert abs(r["segment_share"] - share) < 1e-9 and abs(r["tail_share"] - share) < 1e-9 and abs(r["tld_share"] - 0.5) < 1e-9
    own = U.with_shares(labelled, U.suffix_statistics(labelled), 0.5, leave_out=True).collect()
    assert all(abs(r["tail_share"] - 0.5) < 1e-9 for r in own)


def test_a_repeated_url_changes_no_other_verdict(spark):
    rows = [(i, f"http://s{i % 7}.{'good' if i % 2 else 'bad'}.net/{'en' if i % 2 else 'spam'}/{i}" + ("" if i % 2 else "?a=1&b=2&c=3")) for i in range(600)]
    rules = [("allow", "s1.good.net/"), ("allow", "s3.good.net/"), ("block", "s0.bad.net/"), ("block", "s2.bad.net/"), ("block", "s4.bad.net/")]
    first = min((u for _, u in rows if "s0.bad" in u or "s1.good" in u), key=len)
    df = spark.createDataFrame(rows, "page_id long, url string")
    many = df.unionByName(spark.range(600, 900).select(F.col("id").alias("page_id"), F.lit(first).alias("url")))
    one, two = ({r["page_id"]: tuple(r) for r in U.filter_urls(d, rules, fit_rows=50).where("page_id < 600").collect()} for d in (df, many))
    assert one == two
    free = [r for r in one.values() if r[3] is None]
    assert len(free) > 200 and all(r[4] == ("block" if ".bad." in r[1] else "allow") for r in free)
