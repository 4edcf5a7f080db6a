"""Column functions for text features.

All but ``levenshtein_to_text``, ``common_words_with_text`` and ``row_jaccard_to_text``,
which take long texts through Arrow batches, are built from Spark SQL expressions: they stay
inside whole-stage codegen and never cross into Python. Semantics follow the JVM string functions the
features were defined with:

* ``java_split`` mirrors ``String.split(regex)``: leading and inner empty
  strings are kept, trailing empty strings are dropped, and a text made only
  of separators gives an empty list.
* ``tokenize_ws`` mirrors the ML ``Tokenizer``: lower-case, split at single
  whitespace characters, same trailing rule; ``""`` gives ``[""]``; a NULL
  text gives an empty array instead of failing.
"""
from __future__ import annotations

from collections import Counter
from itertools import pairwise

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# The separators between words. The raw form splits at the
# space only; the separator-aware form also splits at the NUL byte that joins
# attributes, so words at an attribute boundary do not stick together.
SPACE = " "
SPACE_OR_NUL = "[ \\x00]"
# Java's \s class: space, tab, newline, vertical tab, form feed, carriage return.
JAVA_WS = "[ \\t\\n\\x0B\\f\\r]"
# Fixed value: default pattern of the regex tokenizer (gaps between tokens).
REGEX_TOKEN_GAPS = "[\\W_]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, pattern: str) -> Column:
    """``String.split(pattern)`` as a Column expression (pattern matches one separator)."""
    c = _col(c)
    # the search for trailing separators looks at every character: only for texts that end with one
    trimmed = F.when(F.substring(c, -1, 1).rlike(pattern), F.regexp_replace(c, f"(?:{pattern})+$", "")).otherwise(c)
    return (F.when(c.isNull(), F.lit(None))
            .when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern)))


def tokenize_ws(c) -> Column:
    """Whitespace tokenizer (lower, split at each whitespace char)."""
    c = _col(c)
    return F.coalesce(java_split(F.lower(c), JAVA_WS), F.array().cast("array<string>"))


def regex_tokenize(c, pattern: str = REGEX_TOKEN_GAPS, min_token_length: int = 1,
                   to_lowercase: bool = True) -> Column:
    """Regex tokenizer; the pattern matches the gaps, empty tokens are dropped."""
    c = _col(c)
    if to_lowercase:
        c = F.lower(c)
    parts = F.split(F.coalesce(c, F.lit("")), pattern)
    return F.filter(parts, lambda t: F.length(t) >= F.lit(max(min_token_length, 1)))


def multiset_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two string arrays.

    Sum over distinct words w of ``a`` of min(count of w in a, count in b).
    Unlike ``array_intersect`` repeated words count as often as they repeat on
    both sides. A count is size(arr) - size(array_remove(arr, w)): the scan of
    the long side runs inside the built-in, only the short loop over the
    distinct words of ``a`` (the query) is a lambda. Cost is linear in |b| per
    distinct query word.
    """
    def count(arr, w):
        return F.size(arr) - F.size(F.array_remove(arr, w))

    return F.aggregate(F.array_distinct(a), F.lit(0),
                       lambda acc, w: acc + F.least(count(a, w), count(b, w)))


def words(c, separator_aware: bool = True) -> Column:
    return java_split(c, SPACE_OR_NUL if separator_aware else SPACE)


def spaced_words(c, separator_aware: bool = True, below: int | None = None) -> Column:
    """The text with a space of its own on either side of every word, for ``occurrences``;
    NULL for a text that has not fewer than ``below`` bytes."""
    c = _col(c)
    if below is not None:
        c = F.when(F.octet_length(c) < below, c)
    if separator_aware:
        c = F.replace(c, F.lit("\x00"), F.lit(SPACE))
    return F.concat(F.lit(SPACE), F.replace(c, F.lit(SPACE), F.lit(2 * SPACE)), F.lit(SPACE))


def spaced_tokens(c) -> Column:
    """``spaced_words`` for the tokens of ``tokenize_ws``."""
    c = F.lower(_col(c))
    for white in "\t\n\x0b\f\r":
        c = F.replace(c, F.lit(white), F.lit(SPACE))
    return spaced_words(c, separator_aware=False)


def occurrences(spaced, word) -> Column:
    """How often ``word`` (not empty, without a space) is a word of a text given as ``spaced_words``.

    A byte search: the words of the text are never made rows or arrays. Most texts
    do not hold the word at all, which its first letter tells fastest."""
    spaced, word = _col(spaced), _col(word)
    whole = F.concat(F.lit(SPACE), word, F.lit(SPACE))
    gone = F.octet_length(spaced) - F.octet_length(F.replace(spaced, whole, F.lit("")))
    return F.when(F.contains(spaced, word), (gone / (F.octet_length(word) + 2)).cast("int")).otherwise(F.lit(0))


def common_words(a, b, separator_aware: bool = True, words_a=None, spaced_b=None) -> Column:
    """Number of words two texts share, counted as a multiset.

    0 when either side is NULL or empty. Words are the parts between single
    spaces (and NULs when ``separator_aware``); inner empty parts count.
    ``words_a`` may pass the words of ``a``, ``spaced_b`` the ``spaced_words`` of
    ``b``, so that a long text that meets many queries is prepared only once.
    Cost: one byte search of ``b`` per distinct word of ``a``, the shorter text.
    """
    a, b = _col(a), _col(b)
    wa = _col(words_a) if words_a is not None else words(a, separator_aware)
    spaced = _col(spaced_b) if spaced_b is not None else spaced_words(b, separator_aware)

    def count(arr, w):
        return F.size(arr) - F.size(F.array_remove(arr, w))

    def in_b(w):  # empty words, of queries with doubled spaces, are counted among the words themselves
        return F.when(w == "", count(words(b, separator_aware), w)).otherwise(occurrences(spaced, w))

    overlap = F.aggregate(F.array_distinct(wa), F.lit(0), lambda acc, w: acc + F.least(count(wa, w), in_b(w)))
    return (F.when(a.isNull() | b.isNull() | (a == "") | (b == ""), F.lit(0))
            .otherwise(overlap)).cast("int")


def common_words_with_text(query, text, separator_aware: bool = True, words_q=None, spaced=None) -> Column:
    """``common_words`` of a query and a text that may be long: the same values.

    Texts from ``LONG_TEXT`` bytes on are searched in an Arrow batch, where a search is a
    fast byte scan and the pairs of one product share what is prepared of the text;
    ``spaced`` (see ``common_words``) is read for shorter texts only."""
    query, text = _col(query), _col(text)
    count = _common_words_aware if separator_aware else _common_words_raw
    return F.coalesce(count(text, query),
                      F.when(~_is_long(text) | query.isNull(), common_words(query, text, separator_aware, words_q, spaced)))


def word_count(c, separator_aware: bool = True) -> Column:
    """Number of words of a text as ``words`` splits it; 0 for an empty text, NULL for NULL."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(None)).when(c == "", F.lit(0)).otherwise(F.size(words(c, separator_aware))).cast("int")


def ratio_of_common_words(common, length) -> Column:
    """Common words divided by the query length, as float.

    ``length`` is the character length of the query (as defined by the
    feature), or its ``word_count`` for the share of common words; an empty query gives 0/0 = NaN (that row is later dropped by the
    validity filter), a NULL side gives NULL.
    """
    common, length = _col(common), _col(length)
    quotient = common.cast("double") / F.when(length != 0, length.cast("double"))
    return (F.when(common.isNull() | length.isNull(), F.lit(None))
            .when(length == 0, F.when(common == 0, F.lit(float("nan")))
                  .otherwise(F.lit(float("inf"))))
            .otherwise(quotient)).cast("float")


def len_of_query(c) -> Column:
    """Character length of the query.

    Counts code points; a JVM ``String.length()`` counts UTF-16 units, which
    differs only for characters outside the Basic Multilingual Plane.
    """
    return F.length(_col(c)).cast("int")


def len_of_attributes(c) -> Column:
    """Character length of the attribute text, 0 for NULL or empty."""
    return F.coalesce(F.length(_col(c)), F.lit(0)).cast("int")


def num_of_attributes(c, separator: str = "\x00") -> Column:
    """Number of attributes: parts between separators, trailing empty parts
    dropped; 0 for NULL or empty text."""
    c = _col(c)
    trimmed = F.regexp_replace(F.coalesce(c, F.lit("")), f"{separator}+$", "")
    seps = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(separator), F.lit("")))
    return F.when(trimmed == "", F.lit(0)).otherwise(seps + 1).cast("int")


def row_jaccard(a, b) -> Column:
    """Jaccard similarity of the token sets of two texts in the same row
    (whitespace tokens, empty tokens ignored); 0 when both sets are empty."""
    sa = F.array_distinct(F.filter(tokenize_ws(a), lambda t: t != ""))
    sb = F.array_distinct(F.filter(tokenize_ws(b), lambda t: t != ""))
    inter = F.size(F.array_intersect(sa, sb))
    union = F.size(sa) + F.size(sb) - inter
    return F.when(union > 0, inter.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


#: From this many bytes on a text is searched for the words and, by a short query, for its characters.
LONG_TEXT = 256
#: Pairs of an Arrow batch whose texts a Python worker holds at once, besides the batch.
PAIRS_AT_ONCE = 256


def distance_to_longer(text: str, word: str) -> int:
    """Edit distance of ``text`` and a ``word`` that is not longer, for a word much shorter than the text.

    Turning n characters into m takes n - m deletions at least; a substitution costs one
    more, an insertion two. ``ends[i]`` is the earliest place in the text where the first i
    characters of the word can end at so much extra, so a character is one search in the
    text, and the table of n x m cells is not filled. Mostly the word's characters stand in
    the text in their order and nothing is extra; each extra is one more pass over the word."""
    n, beyond = len(text), len(text) + 1
    at, ends = 0, [0]
    for c in word:
        at = text.find(c, at) + 1
        if not at:
            break
        ends.append(at)
    else:
        return n - len(word)
    ends += [beyond] * (len(word) + 1 - len(ends))
    extra, one_less, two_less = 0, ends, [beyond] * len(ends)
    while True:
        extra += 1
        at, ends = beyond, [beyond]
        for i, c in enumerate(word):
            found = text.find(c, at) + 1 if at <= n else 0
            at = min(found or beyond, one_less[i] + 1, two_less[i])
            ends.append(at)
        if at <= n:
            return n - len(word) + extra
        one_less, two_less = ends, one_less


def _pairs_of_texts(texts: pa.Array, queries: pa.Array, measure, least: int = 0) -> list:
    """The measures of all pairs; None for a text below ``least`` bytes and where a side is NULL.

    A merge on the product leaves a product's pairs side by side: equal neighbours are found
    in Arrow, and ``measure(text, queries)`` gets a text, as bytes, once with the queries it meets."""
    out = []
    for at in range(0, len(texts), PAIRS_AT_ONCE):
        some, asked = texts.slice(at, PAIRS_AT_ONCE), queries.slice(at, PAIRS_AT_ONCE).cast(pa.binary()).to_pylist()
        other = pc.invert(pc.fill_null(pc.equal(some.slice(1), some.slice(0, len(some) - 1)), False))
        starts = [0, *(i + 1 for i in pc.indices_nonzero(other).to_pylist()), len(some)]
        for start, end in pairwise(starts):
            met = asked[start:end]
            text = some[start].as_buffer()
            if text is None or text.size < least:
                out += [None] * len(met)
                continue
            known = [q for q in met if q is not None]
            values = measure(text.to_pybytes(), known) if known else []
            if len(known) < len(met):
                ready = iter(values)
                values = [None if q is None else next(ready) for q in met]
            out += values
    return out


def _distances_if_short(text: bytes, queries: list[bytes]) -> list[int | None]:
    decoded = text.decode()
    return [distance_to_longer(decoded, q.decode()) if len(q) * 8 <= len(text) else None for q in queries]


@F.arrow_udf(IntegerType())
def _distance_to_longer(texts: pa.Array, queries: pa.Array) -> pa.Array:
    return pa.array(_pairs_of_texts(texts, queries, _distances_if_short, LONG_TEXT), pa.int32())


#: Bytes of a text, up to the next space, that are cut into words at once.
BYTES_AT_ONCE = 1 << 20


def _count_words(text: bytes, wanted: set[bytes]) -> Counter:
    """How often each of the ``wanted`` words is a word of the text, between single spaces."""
    text = text.rstrip(b" ")
    found, at = Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + BYTES_AT_ONCE)
        end = len(text) if end < 0 else end
        found.update(filter(wanted.__contains__, text[at:end].split(b" ")))
        at = end + 1
    return found


def _shared_words(text: bytes, queries: list[bytes]) -> list[int]:
    """Words shared with each query; the text is cut into words once for all of them."""
    stripped = [q.rstrip(b" ") for q in queries]
    words = [q.split(b" ") if q else [] for q in stripped]
    found = _count_words(text, set().union(*words))
    return [sum(min(n, found[w]) for w, n in Counter(ws).items()) if len(set(ws)) < len(ws) else sum(w in found for w in ws) for ws in words]


@F.arrow_udf(IntegerType())
def _common_words_raw(texts: pa.Array, queries: pa.Array) -> pa.Array:
    return pa.array(_pairs_of_texts(texts, queries, _shared_words, LONG_TEXT), pa.int32())


@F.arrow_udf(IntegerType())
def _common_words_aware(texts: pa.Array, queries: pa.Array) -> pa.Array:
    plain = lambda t: t.replace(b"\x00", b" ")
    out = _pairs_of_texts(texts, queries, lambda t, qs: _shared_words(plain(t), [*map(plain, qs)]), LONG_TEXT)
    return pa.array(out, pa.int32())


def _is_long(text: Column) -> Column:
    return F.coalesce(F.octet_length(text) >= LONG_TEXT, F.lit(False))


def _token_set(text: bytes) -> frozenset[bytes]:
    return frozenset(text.split())  # at the white space of ``tokenize_ws``; leaves no empty token


def _shared_tokens(text: bytes, queries: list[bytes]) -> list[tuple[int, int]]:
    known = _token_set(text)
    return [(len(tokens & known), len(tokens | known)) for tokens in map(_token_set, queries)]


SHARED_TOKENS = StructType([StructField("shared", IntegerType()), StructField("all", IntegerType())])


@F.arrow_udf(SHARED_TOKENS)
def _tokens_in_common(texts: pa.Array, queries: pa.Array) -> pa.Array:
    found = _pairs_of_texts(texts, queries, _shared_tokens)
    return pa.StructArray.from_arrays([pa.array([f and f[i] for f in found], pa.int32()) for i in (0, 1)], ["shared", "all"])


def row_jaccard_to_text(query, text) -> Column:
    """``row_jaccard`` of a query and a text that may be long, both in lower case: the same values.

    In an Arrow batch, where the pairs of one product share the text's token set."""
    both = _tokens_in_common(_col(text), _col(query))
    return F.when(both["all"] > 0, both["shared"].cast("double") / both["all"].cast("double")).otherwise(F.lit(0.0))


def levenshtein_distance(left, right, threshold: int | None = None) -> Column:
    """T5: edit distance in characters, NULL when either side is NULL.

    With ``threshold`` Spark stops early and returns -1 beyond it.
    """
    if threshold is not None:
        return F.levenshtein(_col(left), _col(right), threshold)
    return F.levenshtein(_col(left), _col(right))


def levenshtein_to_text(text, query) -> Column:
    """``levenshtein_distance`` of texts that may be long and queries that are mostly short.

    The same values; long texts with a short query go through ``distance_to_longer``
    in an Arrow batch, whose time is n + m and not n x m."""
    text, query = _col(text), _col(query)
    short = _is_long(text) & (F.octet_length(query) * 8 <= F.octet_length(text))
    return F.coalesce(_distance_to_longer(text, query),
                      F.when(~F.coalesce(short, F.lit(False)), F.levenshtein(text, query)))


def name_value(name, value) -> Column:
    """``name value`` with NULL parts skipped; never NULL."""
    return F.concat_ws(" ", _col(name), _col(value))


def binary_label(c, threshold: float = 2.0) -> Column:
    """1.0 when the label is strictly above the threshold, else 0.0."""
    return (_col(c) > F.lit(threshold)).cast("double")


def text_length(c) -> Column:
    """Character length of a text (e.g. the product title)."""
    return F.length(_col(c)).cast("int")


# Relevance levels predictions may be snapped to, in list order,
# and the level the search starts from.
SNAP_LEVELS = (1.0, 1.33, 1.67, 1.75, 2.0, 2.25, 2.33, 2.5, 2.67, 2.75, 3.0)
SNAP_START = 2.0


def snap_to_levels(c, levels=SNAP_LEVELS, start: float = SNAP_START) -> Column:
    """Nearest level; on ties the start level wins, then the earlier level."""
    c = _col(c)
    cands = [F.struct(F.abs(F.lit(start) - c).alias("d"), F.lit(-1).alias("r"),
                      F.lit(start).alias("v"))]
    cands += [F.struct(F.abs(F.lit(v) - c).alias("d"), F.lit(i).alias("r"), F.lit(v).alias("v"))
              for i, v in enumerate(levels)]
    return F.when(c.isNull(), F.lit(None)).otherwise(F.array_min(F.array(*cands))["v"])
