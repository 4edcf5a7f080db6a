"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text, in one pass over its words: the ledger
keeps the measurements and one failure bit per rule. Policies are versioned
sets of bits and are applied afterwards to the ledger alone; ablations (what
each rule rejects by itself, what a policy would keep without it) come from one
aggregate over the distinct masks.
"""
from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOL = re.compile(r"[#*$%&|<>]")

#: Rule names in bit order. New rules are added at the end, so that old masks keep their meaning.
RULES = ["too_few_words", "repeated_windows", "symbol_words", "duplicate_lines", "odd_word_length",
         "few_letters", "shouting", "top_word"]
BIT = {name: 1 << i for i, name in enumerate(RULES)}

#: Versioned policies: the rules that reject.
POLICIES = {
    "base": ["too_few_words", "repeated_windows"],
    "v1": ["too_few_words", "repeated_windows", "symbol_words", "duplicate_lines"],
    "v2": RULES,
}

#: Fixed bounds of the rules beyond the base.
MAX_SYMBOLS_PER_WORD = 0.10
MAX_DUP_LINE_SHARE = 0.50
MIN_MEAN_WORD, MAX_MEAN_WORD = 2.0, 20.0
MIN_LETTER_SHARE = 0.60
MAX_UPPER_SHARE = 0.70
MAX_TOP_WORD_SHARE = 0.30

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_letters long, n_upper long, top_word_count long")


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES (null: as empty).

    Words are maximal runs without \\x20 and \\x09-\\x0D. n_repeat_words counts
    the words covered by a 3-word window found twice or more in the text, its
    first occurrence included; n_dup_lines the lines with a word that equal an
    earlier line."""
    if not text:
        return (0,) * 9
    # str.split() would also split at Unicode spaces; ASCII white space survives a bytes split unharmed
    words = text.encode("utf-8", "surrogatepass").split()
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    repeated = covered = 0
    if len(times) < len(windows):
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    lines, seen, dup = text.split("\n"), set(), 0
    n_lines = 0
    for line in lines:
        if line.strip(" \t\n\x0b\x0c\r"):
            n_lines += 1
            dup += line in seen
            seen.add(line)
    joined = b"".join(words).decode("utf-8", "surrogatepass")
    letters = len(joined) - len(NOT_LETTER.findall(joined))
    return (len(words), len(joined), len(SYMBOL.findall(text)), dup, repeated, n_lines, letters,
            len(UPPER.findall(joined)), Counter(words).most_common(1)[0][1] if words else 0)


#: Characters that are no letters: digits and underscore are \\w, the rest is \\W.
NOT_LETTER = re.compile(r"[\W\d_]")
#: Upper-case letters of Latin-1; other scripts count as not upper.
UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")


def failures() -> list[Column]:
    """One boolean per rule of RULES, over the measurements."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        n < 50,
        100 * F.col("n_repeat_words") > 50 * n,
        F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"),
        (chars < MIN_MEAN_WORD * n) | (chars > MAX_MEAN_WORD * n),
        F.col("n_letters") < MIN_LETTER_SHARE * chars,
        F.col("n_upper") > MAX_UPPER_SHARE * F.col("n_letters"),
        F.col("top_word_count") > MAX_TOP_WORD_SHARE * n,
    ]


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id), the measurements and ``failure_mask`` (bigint).

    One row per row of ``docs``, repeated rows and null ids included; a null
    text counts as empty (0 words, rejected by the word rule); an empty table
    gives an empty ledger. Other columns are not read."""
    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=[c.split()[0] for c in MEASURES.split(", ")])

    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], measured(F.col(text)).alias("m"))
    rows = rows.select(*[F.col(f"k{i}") for i in range(len(keep))], "m.*")
    mask = sum((F.when(f, F.lit(BIT[name])).otherwise(F.lit(0)).cast("long") for name, f in zip(RULES, failures())), F.lit(0).cast("long"))
    rows = rows.withColumn("failure_mask", mask)
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *rows.columns[len(keep):])


def policy_mask(policy: str | list[str]) -> int:
    return sum(BIT[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | list[str]) -> Column:
    """True where no rule of the policy failed."""
    return F.col("failure_mask").bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablation(rows: DataFrame, policy: str | list[str]) -> DataFrame:
    """Per rule of the policy: rows it fails, rows that it alone rejects, and rows
    kept with and without it. One aggregate over at most 2 ** len(RULES) masks."""
    full = policy_mask(policy)
    masks = rows.groupBy(F.col("failure_mask").bitwiseAND(F.lit(full)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for r, b in BIT.items() if b & full]))
    per = masks.select("mask", "n", rules.alias("r")).select("mask", "n", "r.rule", "r.bit")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return per.groupBy("rule", "bit").agg(
        count(F.col("mask").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("mask") == F.col("bit")).alias("n_only_this_rule"),
        count(F.col("mask") == 0).alias("n_kept"),
        count(F.col("mask").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"))


def judge(docs: DataFrame, policy: str | list[str] = "v2", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` (the policy's verdict; never true where the base failed)."""
    rows = ledger(docs, text, keep)
    base = ~passes("base")
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & passes(policy))


def keep_good(docs: DataFrame, policy: str | list[str] = "v2", text: str = "text") -> DataFrame:
    """``docs`` without the rows that the policy rejects; columns as given. One pass, no shuffle."""
    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=[c.split()[0] for c in MEASURES.split(", ")])

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("whole_row"), measured(F.col(text)).alias("m")).select("whole_row", "m.*")
    failed = F.lit(False)
    for name, f in zip(RULES, failures()):
        if BIT[name] & (policy_mask("base") | policy_mask(policy)):
            failed = failed | f
    return rows.where(~failed).select("whole_row.*")
