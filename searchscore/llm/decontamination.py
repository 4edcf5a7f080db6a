"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming
blocks, exact weighted-shingle verification.

For every item of s shingles, each run of s successive shingles of a text is a
window. Windows and items get 64-bit SimHash fingerprints over their shingles.
Eight blocks of eight bits index the items: two fingerprints within ``radius``
(23) agree to within 23 // 8 = 2 bits in at least one block, so looking up each
block with all values within 2 bits returns every item within the radius. Each
candidate is then held to the exact weighted Jaccard similarity of its shingles,
weights being numbers of occurrences.

Two sets of shingles at 0.8 differ by 10 bits on average (standard deviation 3),
so the radius lies over four deviations out. So wide a radius selects little by
itself; what spares the work is that a window of n shingles can only be as similar
as t to an item of s if t (n + s) / (1 + t) of its shingles are shingles of items.
Windows with fewer are not fingerprinted, which loses nothing. Shingles are told
by a 64-bit key from their words' hashes; a false hit costs a probe, never a result.

An item of fewer words than a shingle is one shingle of its own width: its windows
are runs of as many words, and it is found where one equals it (at so few words
nothing less is 0.8 alike).

The benchmark is a stated query set: it goes to the tasks in slices of at most
``SLICE_ITEMS`` items and ``SLICE_CHARS`` characters, however many there are. Texts
are read once a slice; a Python worker builds a slice's index once.
"""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, BLOCKS = 64, 8
BLOCK_BITS = BITS // BLOCKS
SEED = 42
KEY_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Items (of any length) sent to the tasks at a time, and their characters.
SLICE_ITEMS = 100_000
SLICE_CHARS = 64_000_000
#: Pairs of a window and an item looked at in one step.
PROBED = 1 << 21
#: Shingles of a text that are fingerprinted at a time.
REGION = 1 << 15


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingles_of(words: list[bytes], width: int) -> list[bytes]:
    """Runs of ``width`` words; fewer words make one shingle, none make none."""
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(width)))))


def _hashes(shingles: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))


def window_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` hashes, by running sums of bits."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = 2 * (sums[size:] - sums[:-size]) > size
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_keys(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit key of every run of ``width`` words, from the words' hashes in this process."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - width + 1
    key = each[:n]
    for k in range(1, width):
        key = key * KEY_FACTOR + each[k:k + n]
    return key ^ (key >> np.uint64(32))


@dataclass
class _Sized:
    """Items of one size and, for each block, a posting list from its value to them."""
    items: list[int] = field(default_factory=list)
    prints: np.ndarray | None = None
    order: np.ndarray | None = None  # places -> item: block after block, by the block's value
    starts: np.ndarray | None = None  # block * (values + 1) + value -> first place


class Index:
    """Multi-index Hamming blocks over one slice of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], width: int, radius: int):
        self.width, self.radius = width, radius
        self.texts = [t for _, t in items]
        self.ids = [k for k, _ in items]
        self.sizes: dict[int, _Sized] = defaultdict(_Sized)
        #: words of a short item -> its text -> items
        self.short: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
        self._weights: dict[int, Counter] = {}
        prints, keys = {}, [np.zeros(0, dtype=np.uint64)]
        for i, text in enumerate(self.texts):
            words = words_of(text)
            if 0 < len(words) < width:
                self.short[len(words)][b" ".join(words)].append(i)
            elif words:
                s = shingles_of(words, width)
                prints[i] = window_fingerprints(_hashes(s), len(s))[0]
                self.sizes[len(s)].items.append(i)
                keys.append(shingle_keys(words, width))
        self.keys = np.unique(np.concatenate(keys))
        # one flag per leading bits of a key, at least eight times as many as keys
        self._shift = np.uint64(64 - min(26, max(10, (8 * len(self.keys)).bit_length())))
        self._flags = np.zeros(1 << (64 - int(self._shift)), dtype=bool)
        self._flags[self.keys >> self._shift] = True
        self._reach = np.array([sum(1 << b for b in c) for k in range(radius // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), k)], dtype=np.uint8)
        for at in self.sizes.values():
            at.prints = np.array([prints[i] for i in at.items], dtype=np.uint64)
            values = at.prints.view(np.uint8).reshape(-1, 8).T
            at.order = np.argsort(values, axis=1, kind="stable").astype(np.int32).ravel()
            at.starts = np.concatenate([b * len(at.items) + np.searchsorted(np.sort(v), np.arange((1 << BLOCK_BITS) + 1)) for b, v in enumerate(values)])

    def weights(self, item: int) -> Counter:
        """Occurrences of each shingle of an item."""
        if item not in self._weights:
            self._weights[item] = Counter(shingles_of(words_of(self.texts[item]), self.width))
        return self._weights[item]

    def held(self, words: list[bytes]) -> np.ndarray:
        """Places of the shingles that are shingles of some item."""
        keys = shingle_keys(words, self.width)
        maybe = np.flatnonzero(self._flags[keys >> self._shift])
        at = np.searchsorted(self.keys, keys[maybe])
        return maybe[self.keys[np.minimum(at, len(self.keys) - 1)] == keys[maybe]] if len(self.keys) else maybe

    def probed(self, prints: np.ndarray, size: int) -> np.ndarray:
        """Sorted pairs window * items + item whose fingerprints are within the block radius in some block."""
        at = self.sizes[size]
        values = prints.view(np.uint8).reshape(-1, BLOCKS, 1) ^ self._reach
        probes = (values + np.arange(BLOCKS)[:, None] * ((1 << BLOCK_BITS) + 1)).ravel()
        first = at.starts[probes]
        n = at.starts[probes + 1] - first
        full = np.flatnonzero(n)  # most lists are empty
        first, n = first[full], n[full]
        place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.unique(np.repeat(full // (BLOCKS * len(self._reach)), n) * len(at.items) + at.order[place])

    def candidates(self, prints: np.ndarray, size: int):
        """(window, item, differing bits) within the radius, in window order."""
        at = self.sizes[size]
        step = max(1, PROBED // len(at.items))
        out = []
        for lo in range(0, len(prints), step):
            w, k = np.divmod(self.probed(prints[lo:lo + step], size), len(at.items))
            d = np.bitwise_count(prints[lo + w] ^ at.prints[k])
            near = d <= self.radius
            out += [(lo + int(x), at.items[y], int(z)) for x, y, z in zip(w[near], k[near], d[near])]
        return out


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: least weights over greatest weights, occurrences being weights."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if low else 0.0


def _regions(hits: list[int], reach: int, last: int):
    """Ranges of shingles that windows of up to ``reach`` shingles around the hits cover."""
    lo = hi = None
    for p in hits:
        a, b = max(0, p - reach + 1), min(last, p + reach)
        if hi is not None and a <= hi and b - lo <= REGION:
            hi = b
        else:
            if hi is not None:
                yield lo, hi
            lo, hi = a, b
    if hi is not None:
        yield lo, hi


def contaminations(text: str | None, index: Index, threshold: float) -> list[tuple]:
    """(item index, start word, words, differing bits, similarity) of the best window of
    each item found in the text: most similar, then nearest, then first."""
    words = words_of(text)
    short: dict[int, tuple] = {}
    for n, texts in index.short.items():
        for at, run in enumerate(shingles_of(words, n) if len(words) >= n else []):
            for i in texts.get(run, ()):
                short.setdefault(i, (i, at, n, 0, 1.0))
    hits = index.held(words)
    if not len(hits) or len(hits) < threshold * min(index.sizes):
        return sorted(short.values())
    best: dict[int, tuple] = {}
    last = len(words) - index.width + 1
    counts = np.zeros(last + 1, dtype=np.int64)
    counts[hits + 1] = 1
    counts = np.cumsum(counts)
    for lo, hi in _regions(hits.tolist(), max(index.sizes), last):
        part = hashes = None
        before = counts[lo:hi + 1]
        for size in sorted(index.sizes):
            n = min(size, hi - lo)
            need = max(1, math.ceil(threshold * (n + size) / (1 + threshold) - 1e-9))
            if need > before[-1] - before[0]:
                break  # and larger items need more
            if need > n or n < size and n < last:
                continue  # a text shorter than the item is one window
            windows = np.flatnonzero(before[n:] - before[:-n] >= need)
            if not len(windows):
                continue
            if part is None:
                part = shingles_of(words[lo:hi + index.width - 1], index.width)
                hashes = _hashes(part)
            prints = window_fingerprints(hashes, n)[windows]
            for w, item, bits in index.candidates(prints, size):
                at = int(windows[w])
                sim = weighted_similarity(Counter(part[at:at + n]), index.weights(item))
                if sim >= threshold:
                    found = (-sim, bits, lo + at, n)
                    if item not in best or found < best[item]:
                        best[item] = found
    return sorted([*short.values(), *((i, at, min(len(words) - at, n + index.width - 1), bits, -s) for i, (s, bits, at, n) in best.items())])


def _slices(benchmark: DataFrame, item_id: str, text: str):
    """The items in slices of bounded size, read one after another."""
    part, size = [], 0
    for r in benchmark.select(F.col(item_id), F.col(text)).toLocalIterator():
        part.append((r[0], r[1]))
        size += len(r[1] or "")
        if len(part) >= SLICE_ITEMS or size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: float = 0.8, radius: int = 23,
                       doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, differing_bits, similarity): per document
    and benchmark item its best window at ``threshold`` or more.

    Null, empty and blank texts or items never match; an item of fewer than ``width``
    words matches wherever its words stand in a row. Repeated rows give repeated
    results; items of equal text each match. Null ids are passed on. An empty
    table on either side gives an empty result. Only the named columns are read."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    item_type = dict(benchmark.dtypes)[item_id]
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {item_type}, start_word long, n_words long, differing_bits int, similarity double"
    out = None
    for items in _slices(benchmark, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast({"slice": (items, width, radius)})

        def found(batches, sent=sent):
            index = _index(sent.value)
            for b in batches:
                hits = [(d, index.ids[i], *rest) for d, t in zip(b["doc_id"], b["text"]) for i, *rest in contaminations(t, index, threshold)]
                yield pd.DataFrame(hits, columns=["doc_id", "item_id", "start_word", "n_words", "differing_bits", "similarity"])

        part = rows.mapInPandas(found, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _index(sent: dict) -> Index:
    """The index of a broadcast slice, built by the worker's first task and kept beside it."""
    if "index" not in sent:
        sent["index"] = Index(*sent["slice"])
    return sent["index"]


def _clean(sent, threshold: float):
    """UDF: true for texts without any item of the slice."""
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _index(sent.value)
        for texts in batches:
            yield pd.Series([not contaminations(t, index, threshold) for t in texts], dtype=bool)

    return F.pandas_udf(clean, "boolean")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: float = 0.8, radius: int = 23,
                      text: str = "text", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item at ``threshold`` or more;
    columns as given, no shuffle. Null and empty texts stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))
    for items in _slices(benchmark, item_text, item_text):
        sent = docs.sparkSession.sparkContext.broadcast({"slice": (items, width, radius)})
        rows = rows.where(_clean(sent, threshold)(F.col("whole_row").getField(text)))
    return rows.select("whole_row.*")
