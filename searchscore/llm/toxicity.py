"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insult, threat, target, negation, reported speech, or
other; quotation marks and the ends of clauses and lines are symbols too. Scope
transducers (target, negation, report) say of each symbol whether it stands in
their scope. They are composed into one machine that runs over the text from the
left and one that runs from the right, so that both "you idiot" and "idiot, you"
are aimed. The insult and threat transducers rewrite what comes out into hits, and
the pattern machine composed after them accepts

* an aimed insult: a target within three words of it in its clause,
* an aimed threat likewise (a threat at nobody is a plain verb),
* a run of insults: another one within ``RUN_REACH`` words, across clauses too.

A pattern weighs as much as its words, less for what is negated or reported. The
text has the weight of its heaviest accepted pattern, not a sum: repeating or
lengthening a text changes nothing. A lone insult is not accepted; it gives a
residue below every threshold, for the order of scores alone. A logistic curve
turns the weight into a probability.

Weights of words and the curve come from labelled rows. Words of the insult and
threat classes are those that are significantly more often in toxic texts, both by
documents and by neighbourhoods (the words before and after, counted once, so that
copies of a text do not add up).
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

#: Labelled rows that the weights are learned from at most, taken by hash of their id.
FIT_ROWS = 20_000
#: Learned words at most, the most significant; default of the parameter ``lexicon_words``.
LEXICON = 2_000
#: Words that are looked at by neighbourhoods, the most significant by documents; default of the parameter ``candidates``.
CANDIDATES = 10_000
#: Chance of a word to come out as significant by accident.
SIGNIFICANCE = 1e-4
#: Least and greatest weight of a word.
LEAST, MOST = 1.0, 6.0

# General words of each class, in English, German, French and Spanish.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumbass bastard trottel abschaum connard ordure imbécile basura imbécil".split()
THREATS = "kill hurt destroy strangle stab töten umbringen tuer matar".split()
TARGETS = "you your yours yourself he she they them him her his du dich dein ihr euch tu toi vous votre ton vosotros usted tú ellos".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie pas jamais ni nunca".split()
REPORTS = "said says say told called calls claimed wrote quote quoted sagte sagt schrieb nannte dit écrit dijo dice llamó".split()

#: Weight of a general word that the labels say nothing about.
GENERAL_WEIGHT = 2.0
#: Factors of the transducers, and the words that their scope reaches.
AIMED, NEGATED, REPORTED = 2.0, 0.35, 0.5
AIM_REACH, NEGATION_REACH, REPORT_REACH = 3, 2, 5
#: Words between two insults of a run at most.
RUN_REACH = 60
#: Greatest weight of a text without an accepted pattern.
RESIDUE = 0.5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, CLAUSE, LINE = SYMBOLS = range(9)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n\"“”«»|]")
MARKS = {**dict.fromkeys(".!?;|", CLAUSE), "\n": LINE, **dict.fromkeys("\"“”«»", QUOTE)}


def symbols() -> dict[str, int]:
    """Words of the closed classes, and marks."""
    return {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT), **MARKS}


def scope(trigger: int, reach: int, quotes: bool = False) -> dict[tuple[int, int], int]:
    """Transducer (state, symbol) -> state: words left of the trigger's scope, 0 outside.

    With ``quotes`` a quotation that begins in the scope is in it as a whole (state
    -1), up to the next mark or the end of the line."""
    table = {}
    for state in range(-1 if quotes else 0, reach + 1):
        for symbol in SYMBOLS:
            if symbol == LINE:
                after = 0
            elif state == -1:
                after = 0 if symbol == QUOTE else -1
            elif symbol == trigger:
                after = reach
            elif symbol == QUOTE:
                after = -1 if quotes and state else state
            else:
                after = 0 if symbol == CLAUSE else max(0, state - 1)
            table[state, symbol] = after
    return table


def compose(*machines: dict[tuple[int, int], int]) -> list[list[tuple[int, tuple[bool, ...]]]]:
    """Product of scope transducers: [state][symbol] -> (state, which scopes the symbol stands in); 0 is the start."""
    states, table = [(0,) * len(machines)], []
    for at in states:  # grows while read
        row = []
        for symbol in SYMBOLS:
            after = tuple(m[s, symbol] for m, s in zip(machines, at))
            if after not in states:
                states.append(after)
            row.append((states.index(after), tuple(s != 0 for s in at)))
        table.append(row)
    return table


class Grammar:
    """The composed transducers over one lexicon: word -> (symbol, weight)."""

    def __init__(self, lexicon: dict[str, tuple[int, float]]):
        self.hits, self.read = lexicon, symbols()
        self.read |= {w: symbol for w, (symbol, _) in lexicon.items()}
        self.ahead = compose(scope(TARGET, AIM_REACH), scope(NEGATION, NEGATION_REACH), scope(REPORT, REPORT_REACH, quotes=True))
        self.back = compose(scope(TARGET, AIM_REACH), scope(REPORT, REPORT_REACH, quotes=True))

    def events(self, words: list[str]) -> Iterator[tuple[int, int, float, bool]]:
        """(words before, symbol, weight, aimed) of every hit, out of the scope transducers."""
        tape = [self.read.get(w, OTHER) for w in words]
        behind, state = {}, 0
        for i in range(len(tape) - 1, -1, -1):
            state, inside = self.back[state][tape[i]]
            if tape[i] in (INSULT, THREAT):
                behind[i] = inside
        state = place = 0
        for i, symbol in enumerate(tape):
            state, (aimed, negated, reported) = self.ahead[state][symbol]
            if i in behind:
                aimed_at, told = behind[i]
                factor = (NEGATED if negated else 1.0) * (REPORTED if reported or told else 1.0)
                yield place, symbol, self.hits[words[i]][1] * factor, aimed or aimed_at
            place += symbol < QUOTE

    def patterns(self, words: list[str]) -> Iterator[tuple[str, float]]:
        """(kind, weight) of every accepted pattern, and ``lone`` for hits in none."""
        last = None  # place and weight of the last insult: the state of the pattern machine
        for place, symbol, weight, aimed in self.events(words):
            if aimed:
                yield "aimed", weight * AIMED
            if symbol == INSULT:
                if last and place - last[0] <= RUN_REACH:
                    yield "run", last[1] + weight
                last = place, weight
            yield "lone", min(RESIDUE, RESIDUE * weight / MOST)

    def mass(self, text: str | None) -> float:
        """Weight of the heaviest pattern of the whole text."""
        words = WORD.findall((text or "").lower())
        if self.hits.keys().isdisjoint(words):
            return 0.0
        return max(w for _, w in self.patterns(words))


@dataclass
class Model:
    """Lexicon and logistic curve; the whole of what was learned."""
    lexicon: dict[str, tuple[int, float]]
    slope: float
    middle: float

    def probability(self, mass: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * (mass - self.middle)))))


def learn_lexicon(rows: DataFrame, lexicon_words: int = LEXICON, candidates: int = CANDIDATES) -> dict[str, tuple[int, float]]:
    """Weights of words from ``rows`` (text, label 0/1): general words, and learned ones.

    A word counts once per pair of neighbours and label. Its weight is the shrunken
    log ratio of its share of toxic occurrences to the overall share. ``candidates`` words
are looked at by neighbourhoods, ``lexicon_words`` of them learned: the most significant."""
    n, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    lexicon = {**dict.fromkeys(THREATS, (THREAT, GENERAL_WEIGHT)), **dict.fromkeys(INSULTS, (INSULT, GENERAL_WEIGHT))}
    if not n or not toxic or toxic == n:
        return lexicon
    words = rows.select("label", F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1).alias("w"))
    base = words.agg(F.sum(F.col("label") * F.size("w")) / F.sum(F.size("w"))).first()[0]  # by words, as texts differ in length
    base = min(max(base or 0.0, 1e-6), 1 - 1e-6)
    share = F.col("t") / F.col("n")
    # Chernoff bound: chance of t or more of n at the base share
    surprise = F.col("n") * (share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    significant = (share > 0.5) & (surprise > -math.log(SIGNIFICANCE))
    # by documents first, which leaves few words; then by neighbourhoods
    each = words.select("label", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("t"))
    some = each.where(significant).orderBy(surprise.desc(), "word").limit(candidates).select("word")
    near = words.select("label", F.explode(F.arrays_zip(
        F.col("w").alias("word"),
        F.concat(F.array(F.lit("")), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))).alias("before"),
        F.concat(F.slice("w", 2, F.size("w")), F.array(F.lit(""))).alias("after"))).alias("o"))
    near = near.select("label", "o.*").join(F.broadcast(some), "word").select("label", "word", "before", "after").distinct()
    counts = near.groupBy("word").agg(F.count("*").alias("n"), F.sum("label").alias("t"))
    weight = F.log((F.col("t") + base) / (F.col("n") + 1) / base)
    strong = counts.where(significant).select("word", weight.alias("weight"), surprise.alias("surprise"))
    for r in strong.orderBy(F.desc("surprise"), "word").limit(lexicon_words).collect():
        symbol = THREAT if r["word"] in THREATS else INSULT
        # rare words shrink towards nothing: their evidence against that of the heaviest
        lexicon[r["word"]] = (symbol, max(LEAST, min(MOST, r["weight"])) * min(1.0, r["surprise"] / 40.0))
    return lexicon


def _masses(rows: DataFrame, sent) -> DataFrame:
    def mass(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(sent.value)
        for texts in batches:
            yield pd.Series([grammar.mass(t) for t in texts], dtype=float)

    return rows.withColumn("mass", F.pandas_udf(mass, "double")("text"))


def fit_curve(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(slope, middle) of the logistic curve over (mass, label, rows).

    middle is the mass that splits the two labels with the least errors, both weighing
    the same; of equally good ones the middle of the widest gap, and never below
    ``RESIDUE``. The slope puts 0.7 at a quarter of the way from there to the toxic
    side's next mass."""
    toxic = sum(n for _, y, n in counts if y)
    clean = sum(n for _, y, n in counts if not y)
    if not toxic or not clean:
        return 2.0, 1.5
    masses = sorted({m for m, _, _ in counts})
    share = dict.fromkeys(masses, 0.0)
    for m, y, n in counts:
        share[m] += n / toxic if y else -n / clean
    best, wrong = None, 1.0  # everything called toxic: all clean rows wrong
    for m, above in zip(masses, [*masses[1:], masses[-1] + 1.0]):
        wrong += share[m]
        if best is None or (round(wrong, 9), m - above) < best[0]:
            best = (round(wrong, 9), m - above), (m + above) / 2, above - m
    _, middle, gap = best
    return math.log(0.7 / 0.3) / max(gap / 8, 1e-3), max(middle, RESIDUE)


def learn(labelled: DataFrame, lexicon_words: int = LEXICON, candidates: int = CANDIDATES) -> Model:
    """Model from all rows of ``labelled`` (text, label 0/1)."""
    rows = cut_lineage(labelled.select("text", F.col("label").cast("int").alias("label")))
    lexicon = learn_lexicon(rows, lexicon_words, candidates)
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)
    # to hundredths: no weight is above 2 MOST, so few rows come to the driver however often an id repeats
    counts = _masses(rows, sent).groupBy(F.round("mass", 2).alias("mass"), "label").agg(F.count("*").alias("rows"))
    return Model(lexicon, *fit_curve([tuple(r) for r in counts.collect()]))


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3, is 1 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                   predict_at: float = 0.7, fit_rows: int = FIT_ROWS, lexicon_words: int = LEXICON, candidates: int = CANDIDATES) -> DataFrame:
    """(doc_id, held_out, score, predicted, mass), one row per row of ``docs``.

    Weights are learned from labelled rows that are not held out, at most
    ``fit_rows`` ids by hash; ``lexicon_words`` and ``candidates`` as in ``learn_lexicon``. Null, empty and wordless texts have
    mass 0. Labels of null, of unknown ids and contradictory ones (both labels for
    an id) are not learned from; repeated rows stay; an empty table gives an empty
    one; without labels the general words decide. Only the named columns are read."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    chosen = cut_lineage(known.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("id", "label"))  # bounded: an id and a label for each of fit_rows
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = learn(rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")), lexicon_words, candidates)
    sent = docs.sparkSession.sparkContext.broadcast(model.lexicon)
    slope, middle = model.slope, model.middle
    x = F.least(F.greatest(F.lit(slope) * (F.col("mass") - F.lit(middle)), F.lit(-30.0)), F.lit(30.0))
    scored = _masses(rows, sent).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-x))).alias("score"), "mass")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= predict_at).cast("int").alias("predicted"), "mass")
