"""E2 stop-word removal and E3 text cleaning, as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words (the default English list of Spark ML's
# StopWordsRemover, in its order).
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)

# Cleaning rules, applied in order to lower-case text.
# (pattern, replacement); replacements use $1 for the first group. Units keep
# their number.
UNIT_RULES = (
    ("([0-9]) *(?:x|\\*|by) *([0-9])", "$1 xbi $2"),
    ("([0-9]+) *(?:inches|inch|in)\\b", "$1 in. "),
    ("([0-9]+) *(?:foot|feet|ft)\\b", "$1 ft. "),
    ("([0-9]+) *(?:pounds|pound|lbs|lb)\\b", "$1 lb. "),
    ("([0-9]+) *(?:square|sq) *(?:feet|foot|ft)\\b", "$1 sq.ft. "),
    ("([0-9]+) *(?:cubic|cu) *(?:feet|foot|ft)\\b", "$1 cu.ft. "),
    ("([0-9]+) *(?:gallons|gallon|gal)\\b", "$1 gal. "),
    ("([0-9]+) *(?:ounces|ounce|oz)\\b", "$1 oz. "),
    ("([0-9]+) *(?:centimeters|cm)\\b", "$1 cm. "),
    ("([0-9]+) *(?:milimeters|millimeters|mm)\\b", "$1 mm. "),
)
# No unit rule fits a text without a number before the first letters of a unit.
UNIT_START = "[0-9] *(?:x|\\*|by|in|f[oet]|po|lb|sq|cu|ga|o[uz]|ce|cm|mi|mm)"
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
CLEANING_RULES = (
    ("°", " degrees "),
    *UNIT_RULES,
    *[(f"\\b{word}\\b", str(n)) for n, word in enumerate(NUMBER_WORDS)],
    ("[^a-z0-9. ]", " "),
    (" +", " "),
)
# The last two rules in one: every run of other characters but a lone space.
OTHER_RUNS = "[^a-z0-9. ][^a-z0-9.]*| [^a-z0-9.]+"


def remove_stop_words(tokens, words=STOP_WORDS) -> Column:
    """Drop stop words from a token array, keeping order and repeats."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(tokens, lambda t: ~t.isin(*words))  # a hash set from ten words on


def _where_found(text: Column, found, replace) -> Column:
    """``replace(text)`` where ``found(text)``; the text is worked out once."""
    return F.transform(F.array(text), lambda t: F.when(found(t), replace(t)).otherwise(t))[0]


def clean_text(c, rules=CLEANING_RULES) -> Column:
    """Lower-case, then apply the cleaning rules in order, then trim.

    The fixed rules run only on texts that they can fit: a byte search for a number
    word, one search for all units."""
    out = F.lower(F.col(c) if isinstance(c, str) else c)
    if rules is CLEANING_RULES:
        out = F.replace(out, F.lit(rules[0][0]), F.lit(rules[0][1]))
        out = _where_found(out, lambda t: t.rlike(UNIT_START), lambda t: _replaced(t, UNIT_RULES))
        for n, word in enumerate(NUMBER_WORDS):
            out = _where_found(out, lambda t, w=word: F.contains(t, F.lit(w)), lambda t, r=rules[1 + len(UNIT_RULES) + n]: _replaced(t, [r]))
        return F.trim(F.regexp_replace(out, OTHER_RUNS, " "))
    return F.trim(_replaced(out, rules))


def _replaced(out: Column, rules) -> Column:
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out
