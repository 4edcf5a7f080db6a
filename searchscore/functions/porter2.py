"""The English (Porter2) Snowball stemming algorithm for one lower-case word.

Written from the published algorithm description; used as the per-word helper
of the stemming operator (``operators.stemming``), which runs it inside Arrow
batches and memoises results per worker.
"""
from __future__ import annotations

from functools import lru_cache

# Fixed values of the published algorithm.
VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = frozenset(("inning", "outing", "canning", "herring", "earring", "proceed",
                      "exceed", "succeed"))
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
         "ous", "ive", "ize", "ion", "al", "er", "ic")


def _is_vowel(word: str, i: int) -> bool:
    return word[i] in VOWELS


def _region_after_vc(word: str, start: int) -> int:
    for i in range(start + 1, len(word)):
        if not _is_vowel(word, i) and _is_vowel(word, i - 1):
            return i + 1
    return len(word)


def _regions(word: str) -> tuple[int, int]:
    r1 = None
    for p in R1_PREFIXES:
        if word.startswith(p):
            r1 = len(p)
            break
    if r1 is None:
        r1 = _region_after_vc(word, 0)
    r2 = _region_after_vc(word, r1)
    return r1, r2


def _short_syllable_at_end(word: str) -> bool:
    n = len(word)
    if n == 2:
        return _is_vowel(word, 0) and not _is_vowel(word, 1)
    if n >= 3:
        return (not _is_vowel(word, n - 3) and _is_vowel(word, n - 2)
                and not _is_vowel(word, n - 1) and word[n - 1] not in "wxY")
    return False


def _is_short(word: str, r1: int) -> bool:
    return r1 >= len(word) and _short_syllable_at_end(word)


def _has_vowel(s: str) -> bool:
    return any(ch in VOWELS for ch in s)


@lru_cache(maxsize=262144)
def stem(word: str) -> str:
    """Stem one lower-case word."""
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    if word[0] == "'":
        word = word[1:]
    # Y marks a consonant y: at the start or after a vowel.
    chars = list(word)
    for i, ch in enumerate(chars):
        if ch == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    word = "".join(chars)
    r1, r2 = _regions(word)

    # Step 0: possessive endings.
    for suf in ("'s'", "'s", "'"):
        if word.endswith(suf):
            word = word[: -len(suf)]
            break

    # Step 1a.
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ied") or word.endswith("ies"):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("us") or word.endswith("ss"):
        pass
    elif word.endswith("s"):
        if _has_vowel(word[:-2]):
            word = word[:-1]

    if word in AFTER_1A:
        return word

    # Step 1b.
    if word.endswith("eedly") or word.endswith("eed"):
        suf = "eedly" if word.endswith("eedly") else "eed"
        if len(word) - len(suf) >= r1:
            word = word[: -len(suf)] + "ee"
    else:
        for suf in ("ingly", "edly", "ing", "ed"):
            if word.endswith(suf):
                stem_part = word[: -len(suf)]
                if _has_vowel(stem_part):
                    word = stem_part
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif word.endswith(DOUBLES):
                        word = word[:-1]
                    elif _is_short(word, r1):
                        word += "e"
                break

    # Step 1c.
    if len(word) > 2 and word[-1] in "yY" and not _is_vowel(word, len(word) - 2):
        word = word[:-1] + "i"

    # Step 2.
    for suf, rep in STEP2:
        if word.endswith(suf):
            if len(word) - len(suf) >= r1:
                if suf == "ogi":
                    if word[-4:-3] == "l":
                        word = word[:-3] + rep
                elif suf == "li":
                    if len(word) >= 3 and word[-3] in LI_ENDINGS:
                        word = word[:-2]
                else:
                    word = word[: -len(suf)] + rep
            break

    # Step 3.
    for suf, rep in STEP3:
        if word.endswith(suf):
            if len(word) - len(suf) >= r1:
                if suf == "ative":
                    if len(word) - len(suf) >= r2:
                        word = word[: -len(suf)]
                else:
                    word = word[: -len(suf)] + rep
            break

    # Step 4.
    for suf in STEP4:
        if word.endswith(suf):
            if len(word) - len(suf) >= r2:
                if suf == "ion":
                    if len(word) >= 4 and word[-4] in "st":
                        word = word[:-3]
                else:
                    word = word[: -len(suf)]
            break

    # Step 5.
    if word.endswith("e"):
        base = word[:-1]
        if len(base) >= r2 or (len(base) >= r1 and not _short_syllable_at_end(base)):
            word = base
    elif word.endswith("l"):
        if len(word) - 1 >= r2 and word.endswith("ll"):
            word = word[:-1]

    return word.replace("Y", "y")
