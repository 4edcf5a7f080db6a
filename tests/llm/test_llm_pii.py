"""Personal data: base spans against the plain patterns, planted disguises."""
import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from searchscore.llm import pii as P


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        s += n // 10 + n % 10
    return s % 10 == 0


def slow(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_match_the_patterns():
    r = random.Random(2)
    bits = ["a", "b.c", "@", ".", "1", "255", "256", "10.0.0.1", "+1", " ", "-", "(", ")", "4111 1111 1111 1111", "4111111111111111", "x@y.z", "@@", "%", "+49 30 ", "1.2.3.4.5", "0007", "é", "\n"]
    for _ in range(4000):
        t = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        assert P.plain_spans(t) == slow(t), t


DISGUISED = [
    ("write to {} now", "john.doe (at) mail5 (dot) example (dot) com", "email"), ("see {}.", "jane[at]corp[dot]de", "email"), ("user {} end", "ann at example dot com", "email"),
    ("x {} y", "ann dot lee at mail dot example dot org", "email"), ("x {} y", "jоhn@exаmple.com", "email"), ("x {} y", "ｊｏ＠ｅｘ．ｏｒｇ", "email"), ("x {} y", "bob {at} example {dot} net", "email"),
    ("call {} ok", "plus one four one five five five five one two three four", "phone"), ("call {} ok", "+١٤١٥٥٥٥١٢٣٤", "phone"), ("call {} ok", "+1 four one five, five five five, one two three four", "phone"),
    ("call {} ok", "four one five five five five one two double three", "phone"), ("card {} end", "four one one one " + " ".join(["one"] * 12), "card"), ("card {} end", "4​111 1111‑1111 1111", "card"),
    ("x {} y", "ana at correo dot mx", "email"), ("x {} y", "jan at firma dot nl", "email"), ("x {} y", "bob at site dot it", "email"), ("x {} y", "li at firm dot museum", "email"),
    ("call {} ok", "four one five five two nine three eight", "phone"),
    ("ip {} end", "192 dot 168 dot 1 dot 10", "ip"), ("ip {} end", "192[.]168[.]1[.]10", "ip"), ("é😀 {} é", "ann (at) example (dot) com", "email"),
]


@pytest.mark.parametrize("frame,secret,kind", DISGUISED)
def test_disguises_map_back_to_the_source(frame, secret, kind):
    text = frame.format(secret)
    plain, every = P.spans(text)
    assert [(k, text[a:b]) for k, a, b in every] == [(kind, secret)] and plain == []


@pytest.mark.parametrize("text", ["look at example.com today", "he is at the dot", "one two three", "un un un un un un un un un un un un", "meet at 5. Then at 6.", "at dot at dot", "a @ b", "point at it. Dot com", "naïve café — “x”", "look at this dot and that", "he stood at the dot on the map", "one two three four five six seven", "at home the dot is red", "we met at noon. Dot was there"])
def test_clean_text_stays_clean(text):
    assert P.spans(text) == ([], [])


def test_long_runs_take_linear_time():
    for t in ["a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 200_000, " " * 400_000, "+1 " * 100_000, "one " * 60_000]:
        P.spans(t)


def test_query_and_edge_cases(spark):
    rows = [(1, "a@b.com and 10.0.0.1", 0), (1, "a@b.com and 10.0.0.1", 0), (2, None, 0), (3, "", 0), (None, "jo (at) ex (dot) org", 0)]
    got = P.find_pii(spark.createDataFrame(rows, "doc_id long, text string, n_email int")).collect()
    by = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"]) for r in got)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    base = "email:0:7,ip:12:20"
    assert by == [("1", 1, 1, 0, 0, sha(base), base)] * 2 + [("2", 0, 0, 0, 0, sha(""), ""), ("3", 0, 0, 0, 0, sha(""), ""), ("None", 0, 0, 0, 0, sha(""), "email:0:20")]
    masked = P.mask(spark.createDataFrame(rows, "doc_id long, text string, n_email int"))
    assert {r["text"] for r in masked.collect()} == {"xxxxxxx and xxxxxxxx", None, "", "x" * 20}
    assert P.find_pii(spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string"))).count() == 0
