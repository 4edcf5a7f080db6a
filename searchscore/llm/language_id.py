"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's words, lower-cased and with a mark at both ends, give subwords of 2 to 4
characters; each subword is hashed to one of ``BUCKETS`` rows of an embedding
table. The average of the rows over all subwords of the whole text goes through a
linear layer and a softmax. Table and layer are learned together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows. Of that sample a
fifth is kept apart: on it the softmax is calibrated (one temperature), and the
least probability is found from which on predictions are accepted, so that at
most ``MAX_ERROR`` of the accepted ones are wrong there.

The subword counts are taken on the executors. What reaches the driver is the
sample's counts: at most ``FIT_ROWS`` rows of at most ``BUCKETS`` counts.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

#: Labelled rows that are learned from at most.
FIT_ROWS = 6_000
#: Rows of the embedding table (a power of two), and its columns.
BUCKETS = 1 << 12
WIDTH = 16
#: Characters of a subword.
SUBWORDS = (2, 3, 4)
#: Passes over the sample, steps at least, rows of a step, and the first step's length.
EPOCHS, STEPS, BATCH, RATE = 12, 1_200, 32, 20.0
#: Wrong share that accepted predictions may have on the rows kept apart.
MAX_ERROR = 0.01
#: Characters counted at a time, which bounds a task's memory on very long texts.
CHUNK = 1 << 18

UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter (Unicode categories L*)."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subword_counts(text: str, is_letter: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of a text's hashed subwords; all 0 if it has no letter."""
    counts = np.zeros(buckets, np.int64)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    for lo in range(0, len(text), CHUNK):
        # a chunk also sees the last characters before it; subwords that lie in these are counted there
        back = min(lo, max(SUBWORDS) - 1)
        part = text[lo - back:lo + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(part) == len(text[lo - back:lo + CHUNK]):
            overlap = back
        else:  # lower case may be longer
            overlap = len(text[lo - back:lo].lower())
        letter = is_letter[codes]
        codes = np.where(letter, codes, 0)
        first, last = lo == 0, lo + CHUNK >= len(text)
        pad = lambda x, v: np.concatenate(([v] * first, x, [v] * last)).astype(x.dtype)
        codes, letter, overlap = pad(codes, 0), pad(letter, False), 0 if first else overlap
        for n in SUBWORDS:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            ok = np.ones(m, bool)
            for k in range(1, n - 1):  # only the ends may be marks
                ok &= letter[k:m + k]
            if n == 2:
                ok &= letter[:m] | letter[1:]
            ok[:max(0, overlap - n + 1)] = False
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ codes[k:m + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            counts += np.bincount(((h * np.uint64(0xBF58476D1CE4E5B9)) >> shift)[ok].astype(np.int64), minlength=buckets)
    return counts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float
    accept_from: float

    def probabilities(self, shares: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of rows of subword shares."""
        return softmax((shares @ self.table @ self.layer + self.bias) / self.temperature)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> np.ndarray:
    x = np.zeros((len(rows), buckets), np.float32)
    for i, (at, share) in enumerate(rows):
        x[i, at] = share
    return x


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_languages: int, buckets: int = BUCKETS, seed: int = 7):
    """(table, layer, bias) by stochastic gradient descent on the cross-entropy; rows are (buckets, shares)."""
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.1, (buckets, WIDTH)).astype(np.float32)
    layer = random.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, n_languages)).astype(np.float32)
    bias = np.zeros(n_languages, np.float32)
    each = -(-len(rows) // BATCH)
    epochs, done = max(EPOCHS, -(-STEPS // each)), 0
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            at = order[lo:lo + BATCH]
            x = _dense([rows[i] for i in at], buckets)
            mean = x @ table
            miss = softmax(mean @ layer + bias)
            miss[np.arange(len(at)), labels[at]] -= 1
            miss /= len(at)
            rate = RATE * (1 - done / (epochs * each))
            back = miss @ layer.T
            layer -= rate / 10 * (mean.T @ miss)
            bias -= rate / 100 * miss.sum(axis=0)
            table -= rate * (x.T @ back)
            done += 1
    return table, layer, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, max_error: float = MAX_ERROR) -> tuple[float, float]:
    """(temperature, accept_from): the temperature of the least cross-entropy against labels that are
    believed to (n + 1) / (n + 2), and the least probability from which on at most ``max_error`` of the
    predictions are wrong (no rows: 1, 0)."""
    if not len(labels):
        return 1.0, 0.0
    doubt = 1 / (len(labels) + 2)
    target = np.full(logits.shape, doubt / max(logits.shape[1] - 1, 1))
    target[np.arange(len(labels)), labels] = 1 - doubt
    loss = lambda t: -(target * np.log(np.maximum(softmax(logits / t), 1e-12))).sum(axis=1).mean()
    temperature = min(np.geomspace(0.1, 10, 61), key=loss)
    p = softmax(logits / temperature)
    top, wrong = p.max(axis=1), p.argmax(axis=1) != labels
    order = np.argsort(-top, kind="stable")
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share <= max_error)
    if len(good) and good[-1] == len(order) - 1:  # all may be accepted: nothing says where to begin but an even chance
        return float(temperature), min(float(top.min()), 0.5)
    return float(temperature), float(top[order][good[-1]]) if len(good) else 1.0


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4, is 2 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """At most ``fit_rows`` ids of (id, lang, text), about equally many of each language, by hash of the id;
    an id stands for one text (of several, that of the largest hash); ids with several languages are left out."""
    ids = labelled.groupBy("id").agg(F.min("lang").alias("lang"), F.max("lang").alias("most")).where("lang = most").drop("most")
    size = ids.groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language"), F.col("id")), 11).cast("double")
    drawn = ids.join(size, "lang").withColumn("draw", draw * F.col("n")).orderBy("draw", "id").limit(fit_rows)
    return cut_lineage(drawn.select("id", "lang"))


def learn(labelled: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS, max_error: float = MAX_ERROR) -> Model | None:
    """Model from (id, lang, text), lang not null; None without a row of letters."""
    chosen = sample(labelled.select("id", "lang"), fit_rows)
    # bounded: an id and a language for each of fit_rows
    texts = labelled.select("id", "text").join(F.broadcast(chosen), "id").groupBy("id").agg(F.first("lang").alias("lang"), F.max_by("text", F.xxhash64("text")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_letter = letter_table()
        for b in batches:
            out = []
            for doc, lang, text in zip(b["id"], b["lang"], b["text"]):
                counts = subword_counts(text or "", is_letter, buckets)
                at = np.flatnonzero(counts)
                if len(at):
                    out.append((doc, lang, at.astype(np.int16).tobytes(), (counts[at] / counts.sum()).astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["id", "lang", "at", "share"])

    id_type = labelled.schema["id"].dataType.simpleString()
    found = sorted(texts.mapInPandas(count, f"id {id_type}, lang string, at binary, share binary").collect(), key=lambda r: r["id"])  # bounded by fit_rows
    if not found:
        return None
    rows = [(np.frombuffer(r["at"], np.int16).astype(np.int64), np.frombuffer(r["share"], np.float32)) for r in found]
    languages = sorted({r["lang"] for r in found})
    labels = np.array([languages.index(r["lang"]) for r in found])
    apart = np.arange(len(rows)) % 5 == 4
    table, layer, bias = descend([r for r, a in zip(rows, apart) if not a], labels[~apart], len(languages), buckets)
    kept = [r for r, a in zip(rows, apart) if a]
    logits = np.concatenate([_dense(kept[i:i + 256], buckets) @ table @ layer + bias for i in range(0, len(kept), 256)] or [np.zeros((0, len(languages)))])
    return Model(languages, table, layer, bias, *calibrate(logits, labels[apart], max_error))


def identify(docs: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             fit_rows: int = FIT_ROWS, buckets: int = BUCKETS, max_error: float = MAX_ERROR) -> DataFrame:
    """(doc_id, lang_pred, score, accepted), one row a row of ``docs``.

    Rows where ``learn_from`` holds and id and language are not null may be learned
    from, at most ``fit_rows`` of them (``sample``). lang_pred is the likeliest
    learned language, score its calibrated probability; accepted says whether the
    score reaches the calibrated threshold. A null or empty text or one without a
    letter is "und" with score 0, not accepted, and so is every text where nothing
    can be learned. Repeated rows stay; an empty table gives an empty one. Only the
    named columns are read, whatever else the table has."""
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), learn_from.alias("may"))
    model = learn(named.where("may and id is not null and lang is not null").drop("may"), fit_rows, buckets, max_error)
    if model is None:
        return named.select(F.col("id").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets x WIDTH numbers

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        is_letter, m = letter_table(), sent.value
        for texts in batches:
            langs, scores = [], []
            for t in texts:
                counts = subword_counts(t or "", is_letter, buckets)
                total = counts.sum()
                if not total:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = m.probabilities((counts / total).astype(np.float32)[None, :])[0]
                best = int(p.argmax())
                langs.append(m.languages[best])
                scores.append(float(p[best]))
            yield pd.DataFrame({"lang": langs, "score": scores})

    out = named.select(F.col("id").alias("doc_id"), predict("text").alias("p"))
    return out.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                      ((F.col("p.lang") != UNKNOWN) & (F.col("p.score") >= model.accept_from)).alias("accepted"))
