"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found on the text as it is. For disguised ones the text is
rewritten by three transducers, one after another, each emitting characters
together with the source span they stand for:

1. characters: look-alikes (full-width, Cyrillic, Greek, foreign digits and
   dashes) to ASCII, invisible characters to nothing;
2. marks: ``(at)``, ``[dot]``, `` at ``, `` dot `` and their translations to @ and .;
3. spelled digits: runs of three or more digit words to digits, ``plus`` to +.

The identifiers are detected on the rewritten text by the same patterns, and each
match that rests on a rewritten character is mapped back to the source
characters it came from.
"""
from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at the start of a run of digits, hence the look-behind
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @
    outwards, so that long runs without one cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        local = text[end:at]
        start = end + len(local.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        end = domain.end() if domain else at + 1
        if domain:
            yield start, end
        at = text.find("@", end)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind in the order of KINDS, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in m.groups()):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Characters that look like the ASCII ones below them.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһӏВЕКМНОРСТХАІЈЅαινορυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlBEKMHOPCTXAIJSaivopuxABEZHIKMNOPTYX", strict=True))
SIGNS = {**dict.fromkeys("\uff0e\u3002\u2024\u2027\u2219\u30fb", "."), **dict.fromkeys("\uff20\ufe6b", "@"), **dict.fromkeys("\uff0b\ufe62", "+"),
         **dict.fromkeys("\u00a0\u2002\u2003\u2007\u2009\u202f\u3000", " ")}
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe63\uff0d"
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def _foreign_digits() -> dict[str, str]:
    """Decimal digits of other scripts, by their numeric value."""
    return {chr(c): str(unicodedata.decimal(chr(c))) for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Nd"}


def _table() -> dict[str, str]:
    full_width = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
    return {**full_width, **_foreign_digits(), **LOOKALIKES, **SIGNS, **dict.fromkeys(DASHES, "-"), **dict.fromkeys(INVISIBLE, "")}


CHARACTERS = _table()


def _has_odd(text: str) -> bool:
    """Does the text hold a character of the table? Quick for ASCII and Latin-1."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not CHARACTERS.keys().isdisjoint(text)
    return "\u00a0" in text or "\u00ad" in text

# Words for the marks, and for the digits 0 to 9, in English, German, French and Spanish.
AT_WORDS, DOT_WORDS = ["at", "arroba", "arobase", "klammeraffe"], ["dot", "punkt", "point", "punto"]
DIGIT_WORDS = ["zero null zéro cero oh", "one eins un uno", "two zwei zwo deux dos", "three drei trois tres", "four vier quatre cuatro",
               "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve"]
TIMES = {"double": 2, "triple": 3}
DIGIT_OF = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words.split()}
#: Letters of a top-level domain, and of the name before it, where a mark is a plain word.
TOP = re.compile(r"[A-Za-z]{2,24}")
#: Words that stand after "at" or "dot" in prose and are no part of a domain.
NO_TOPS = set("and the that this was of on or but then".split())
NO_NAMES = NO_TOPS | set("it is to in".split())

_OPEN, _CLOSE = r"[(\[{<]", r"[)\]}>]"
_GAP, _JOIN = r"\s{0,3}", r"[ _*-]{1,3}"  # bounded, so that long blank runs cost nothing
MARK = re.compile(
    rf"(?P<batt>{_GAP}{_OPEN}{_GAP}(?:{'|'.join(AT_WORDS)}|a|@){_GAP}{_CLOSE}{_GAP})"
    rf"|(?P<bdot>{_GAP}{_OPEN}{_GAP}(?:{'|'.join(DOT_WORDS)}|\.){_GAP}{_CLOSE}{_GAP})"
    rf"|(?P<watt>(?<=[^\s_*-]){_JOIN}(?:{'|'.join(AT_WORDS)}){_JOIN}(?=\w))|(?P<wdot>(?<=[^\s_*-]){_JOIN}(?:{'|'.join(DOT_WORDS)}){_JOIN}(?=\w))"
    r"|(?P<satt>(?<=[A-Za-z0-9])[ ]{1,2}@[ ]{1,2}(?=[A-Za-z0-9]))", re.IGNORECASE)
_DIGIT = rf"(?:(?:{'|'.join(TIMES)})[ -])?(?:{'|'.join(sorted(DIGIT_OF, key=len, reverse=True))}|[0-9]+)"
_WORD = rf"(?:(?:{'|'.join(TIMES)})[ -])?(?:{'|'.join(sorted(DIGIT_OF, key=len, reverse=True))})"
SPELLED = re.compile(rf"(?<!\w)(?:(?P<plus>plus|\+)[ -]?)?(?P<run>{_WORD}(?:[ ,-]{{1,2}}{_WORD}){{2,}}(?:[ ,-]{{1,2}}{_DIGIT})*)(?!\w)", re.IGNORECASE)
TOKEN = re.compile(rf"(?P<times>{'|'.join(TIMES)})|(?P<digits>[0-9]+)|(?P<word>\w+)|(?P<sep>\W)", re.IGNORECASE)


_SPELLED_WORDS = frozenset(DIGIT_OF) | frozenset(TIMES)
_AROUND = ",-()[].:;!?\"'"


def _may_spell(low: str) -> bool:
    """Three words of digits in a row? Words stand between white space or common punctuation."""
    for c in _AROUND:
        low = low.replace(c, " ")
    return b"\1\1\1" in bytes(map(_SPELLED_WORDS.__contains__, low.split()))


def _may_mark(text: str, low: str) -> bool:
    """Brackets, a word for the dot or a lone @: without any of them no mark makes an identifier."""
    return any(c in text for c in "([{<") or any(w in low for w in DOT_WORDS) or " @ " in text or "@  " in text


class Tape:
    """Rewritten characters, each with the source span it stands for and how it came about:
    '' unchanged, c look-alike, b bracketed mark, w mark in plain words, d spelled digit."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.how = text, range(len(text)), range(1, len(text) + 1), [""] * len(text)

    def rewrite(self, edits: list[tuple[int, int, list[tuple[str, int, int, str]]]]) -> None:
        """Replace [start, end) by characters (char, start, end, how) given on this tape."""
        text, starts, ends, how, at = [], [], [], [], 0
        for a, b, chars in edits:
            text.append(self.text[at:a])
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            how += self.how[at:a]
            for c, x, y, h in chars:
                text.append(c)
                starts.append(self.starts[x])
                ends.append(self.ends[y - 1])
                how.append(h)
            at = b
        text.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        how += self.how[at:]
        self.text, self.starts, self.ends, self.how = "".join(text), starts, ends, how


def _characters(tape: Tape) -> None:
    tape.rewrite([(i, i + 1, [(c, i, i + 1, "c") for c in CHARACTERS[odd]]) for i, odd in enumerate(tape.text) if odd in CHARACTERS])


def _marks(tape: Tape) -> None:
    edits = []
    for m in MARK.finditer(tape.text):
        name = m.lastgroup
        edits.append((m.start(), m.end(), [("@" if name.endswith("att") else ".", m.start(), m.end(), "w" if name[0] == "w" else "b")]))
    tape.rewrite(edits)


def _digits(tape: Tape) -> None:
    edits = []
    for m in SPELLED.finditer(tape.text):
        out, times = [], 1
        if m["plus"]:
            out.append(("+", m.start("plus"), m.end("plus"), "d"))
        for t in TOKEN.finditer(tape.text, m.start("run"), m.end("run")):
            if t["times"]:
                times = TIMES[t["times"].lower()]
            if t["times"] or t["sep"]:
                continue
            if t["digits"]:
                out += [(c, t.start() + i, t.start() + i + 1, tape.how[t.start() + i]) for i, c in enumerate(t["digits"])]
            elif t["word"]:
                out += [(DIGIT_OF[t["word"].lower()], t.start(), t.end(), "d")] * times
            times = 1
        edits.append((m.start(), m.end(), out))
    tape.rewrite(edits)


def _credible(kind: str, text: str, how: list[str]) -> bool:
    """Is a match on rewritten text an identifier that was disguised?"""
    if kind == "email":
        at = text.index("@")
        dots = [how[i] for i in range(at + 1, len(text)) if text[i] == "."]
        top = text.rpartition(".")[2]
        if how[at] == "w" and not any(h in ("w", "b") for h in dots):
            return False  # "at" before an ordinary dotted name
        if how[at] == "w" or "w" in dots:
            # by shape: nothing between the parts but the marks, and an ending of letters
            return bool(TOP.fullmatch(top)) and top.lower() not in NO_TOPS and NO_NAMES.isdisjoint(text[at + 1:].lower().split(".")[:-1])
        return len(top) >= 2 and top.isalpha()
    return True


def disguised_spans(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of identifiers that show only on the rewritten text, none overlapping a plain span of its kind."""
    low = text.lower()
    odd = _has_odd(text)
    marked = _may_mark(text, low) and MARK.search(text)
    spelled = _may_spell(low) and SPELLED.search(text)
    if not (odd or marked or spelled):
        return []
    tape = Tape(text)
    if odd:
        _characters(tape)
    if odd or marked:
        _marks(tape)
    if odd or spelled:
        _digits(tape)
    found = plain_spans(tape.text)
    for m in re.finditer(r"(?<![0-9+])[0-9]{8,15}(?![0-9])", tape.text):  # a number spelled out digit by digit
        in_phone = any(k == "phone" and a < m.end() and m.start() < b for k, a, b in found)
        spelled_out = all(h == "d" for h in tape.how[m.start():m.end()]) and len(set(m[0])) > 2  # no litany of one word
        if spelled_out and not in_phone:
            found.append(("phone", m.start(), m.end()))
    out = []
    for kind, a, b in found:
        how = tape.how[a:b]
        start, end = tape.starts[a], tape.ends[b - 1]
        rewritten = any(how) or end - start != b - a  # the latter: invisible characters left out
        if rewritten and _credible(kind, tape.text[a:b], how):
            if not any(k == kind and s < end and start < e for k, s, e in plain):
                out.append((kind, start, end))
    return out


def spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain spans, all spans), each by kind in the order of KINDS, then start; code points, end exclusive."""
    if not text:
        return [], []
    plain = plain_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    return plain, sorted({*plain, *disguised_spans(text, plain)}, key=lambda s: (order[s[0]], *s[1:]))


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, base_sha256, spans), one row per row of ``docs``.

    The counts and ``base`` are of plain identifiers; ``spans`` lists disguised
    ones as well, all as kind:start:end. Null and empty texts have none. Repeated
    rows and null ids stay; an empty table gives an empty one; only the two named
    columns are read. One pass over the rows, no shuffle."""
    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            plain, every = spans(t)
            base = listed(plain)
            kinds = [k for k, _, _ in plain]
            out.append((*(kinds.count(k) for k in KINDS), base, hashlib.sha256(base.encode()).hexdigest(), listed(every)))
        return pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), found(F.col(text)).alias("f")).select("doc_id", "f.*")


def mask(docs: DataFrame, text: str = "text", fill: str = "x") -> DataFrame:
    """``docs`` with every character of a found span replaced by ``fill``; offsets and columns stay."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            chars = None
            for _, a, b in spans(t)[1]:
                chars = list(t) if chars is None else chars
                chars[a:b] = fill * (b - a)
            out.append(t if chars is None else "".join(chars))
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, masked(F.col(f"`{text}`")))
