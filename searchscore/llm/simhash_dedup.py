"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints come from every shingle of the whole text. Distinct fingerprints
link when at most ``max_bits`` bits differ. To find all links:

* the 64 bits are grouped into m partitions, correlated bits together, so that
  a partition repeats itself and the others stay selective;
* partition i gets a threshold t_i (-1: not probed) with sum(t_i + 1) =
  max_bits + 1. Two fingerprints within max_bits then agree to within t_i in
  some partition i: were each distance at least t_i + 1, they would add up to
  max_bits + 1. Thresholds are allotted by dynamic programming over the
  estimated number of candidates, and m by the least total;
* every fingerprint probes partition i with all values within t_i bits, an
  equi-join on (partition, value); candidates are verified on all 64 bits.

A (partition, value) group of more than ``BUCKET_ROWS`` fingerprints is not
joined pair by pair: it is dealt into block pairs, each of which returns only a
spanning forest of its links, which keeps every component whole.
"""
from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.session import cut_lineage

from .components import component_roots

BITS = 64
SEED = 42
#: Shingles hashed at a time, which bounds a task's memory on very long texts.
HASH_CHUNK = 1 << 16
#: Fingerprints of one (partition, value) group that are still joined pair by pair.
BUCKET_ROWS = 256
#: Relative cost of writing and shuffling one probe row against checking one candidate.
PROBE_COST = 40.0


def text_fingerprint(text: str | None, width: int = 4) -> int:
    """SimHash of a text as a signed 64-bit integer (no word or null: 0)."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and \x20, \x09-\x0D only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, HASH_CHUNK):
        hi = min(n, lo + HASH_CHUNK)
        shingles = zip(*(words[lo + k:hi + k] for k in range(width))) if len(words) >= width else [words]
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles), np.uint64, hi - lo)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 4, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fp`` (long, signed); texts pass through Arrow batches."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn("fp", fp(F.col(text)))


def _bit_sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together (4,096 sums)."""
    def partial(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            bits = np.unpackbits(b["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            n, both = n + len(b), both + bits.T @ bits
        yield pd.DataFrame({"k": np.arange(BITS * BITS + 1), "s": np.append(both.ravel(), n)})

    rows = distinct.select("fp").mapInPandas(partial, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros(BITS * BITS + 1)
    for k, s in rows:
        sums[k] = s
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of near equal width: each starts at the free bit with the strongest
    link to another free bit and takes in the bits most correlated with it."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.clip(p * (1 - p), 1e-9, None))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        first = max(free, key=lambda b: (corr[b, free].max(), -b))
        group = [first]
        free.remove(first)
        while len(group) < width:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def probes(width: int, t: int) -> int:
    return sum(comb(width, k) for k in range(t + 1))


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = total and the least sum of
    costs[i][t_i + 1], by dynamic programming over the partitions."""
    best = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, c in enumerate(row[:total - used + 1]):
                if used + k not in nxt or cost + c < nxt[used + k][0]:
                    nxt[used + k] = (cost + c, chosen + [k - 1])
        best = nxt
    return best[total]


def plan_partitions(distinct: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest plan over 2 .. max_bits + 1 partitions.

    Candidates of partition i at threshold t are estimated from all fingerprints:
    the pairs that share its value (exact, one aggregate), times the number of
    values a probe reaches."""
    n, both = _bit_sums(distinct)
    # one partition alone would be probed with all words within max_bits: never worth it
    plans = {m: correlated_groups(n, both, m) for m in range(min(2, max_bits + 1), max_bits + 2)}
    keys = [(m, i, bits) for m, groups in plans.items() for i, bits in enumerate(groups)]
    row = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _value(bits).alias("v")) for j, (_, _, bits) in enumerate(keys)]))
    same = {r["j"]: float(r["pairs"]) for r in distinct.select(row.alias("r")).groupBy("r.j", "r.v").count()
            .groupBy("j").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs")).collect()}
    best = None
    for m, groups in plans.items():
        costs = [[0.0] + [probes(len(bits), t) * (same.get(keys.index((m, i, bits)), 0.0) + PROBE_COST * max(n, 1))
                          for t in range(max_bits + 1)] for i, bits in enumerate(groups)]
        cost, thresholds = allot(costs, max_bits + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, thresholds)))
    return [(bits, t) for bits, t in best[1] if t >= 0]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << BITS) if m >= 1 << (BITS - 1) else m


def _value(bits):
    return F.col("fp").bitwiseAND(F.lit(_mask(bits)))


def _forest(x: np.ndarray, y: np.ndarray, max_bits: int, step: int = 1024) -> list[tuple[int, int]]:
    """A spanning forest of the links between x and y (links inside x or y only where x is y)."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    root, out = list(range(len(nodes))), []

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    xi, yi = at[:len(x)], at[len(x):]
    for lo in range(0, len(x), step):
        # unsigned: for negative numbers numpy counts the bits of the absolute value
        near = np.bitwise_count((x[lo:lo + step, None] ^ y[None, :]).view(np.uint64)) <= max_bits
        for a, b in zip(*near.nonzero()):
            i, j = int(xi[lo + a]), int(yi[b])
            p, q = find(i), find(j)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def links(distinct: DataFrame, max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints that hold every component together:
    all of them, but for a spanning forest of each block pair of an over-full group."""
    plan = plan_partitions(distinct, max_bits)
    at = [F.struct(F.lit(i).alias("part"), _value(bits).alias("val")) for i, (bits, _) in enumerate(plan)]
    index = cut_lineage(distinct.select("fp", F.explode(F.array(*at)).alias("k")).select("k.part", "k.val", F.col("fp").alias("y")))
    flips = [F.struct(F.lit(i).alias("part"), _value(bits).bitwiseXOR(F.lit(_mask(c))).alias("val"))
             for i, (bits, t) in enumerate(plan) for k in range(t + 1) for c in combinations(bits, k)]
    probe = distinct.select(F.col("fp").alias("x"), F.explode(F.array(*flips)).alias("k")).select("x", "k.part", "k.val")
    blocks = lambda n: F.ceil(n / F.lit(16 * bucket_rows)).cast("int")
    full = cut_lineage(index.groupBy("part", "val").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
                       .withColumn("y_blocks", blocks(F.col("n"))))
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
    if full.isEmpty():
        return probe.join(index, ["part", "val"]).where(near & (F.col("x") < F.col("y"))).select(F.col("x").alias("u"), F.col("y").alias("v"))
    small = index.join(full, ["part", "val"], "left_anti")
    out = probe.join(small, ["part", "val"]).where(near & (F.col("x") < F.col("y"))).select(F.col("x").alias("u"), F.col("y").alias("v"))

    # the two sides of a value differ where it is probed with flipped bits: each is dealt by its own count
    probed = probe.join(full, ["part", "val"]).groupBy("part", "val").agg(blocks(F.count("*")).alias("x_blocks"), F.max("y_blocks").alias("y_blocks"))
    full = cut_lineage(probed)
    own = lambda c, side: F.pmod(F.xxhash64(c), F.col(side).cast("long")).cast("int")
    every = lambda side: F.explode(F.sequence(F.lit(0), F.col(side) - 1))
    xs = (probe.join(full, ["part", "val"]).withColumn("bx", own("x", "x_blocks")).withColumn("by", every("y_blocks"))
          .select("part", "val", "bx", "by", F.lit(0).alias("side"), F.col("x").alias("f")))
    ys = (index.join(full, ["part", "val"]).withColumn("by", own("y", "y_blocks")).withColumn("bx", every("x_blocks"))
          .select("part", "val", "bx", "by", F.lit(1).alias("side"), F.col("y").alias("f")))

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        f, side = pdf["f"].to_numpy(np.int64), pdf["side"].to_numpy()
        return pd.DataFrame(_forest(f[side == 0], f[side == 1], max_bits), columns=["u", "v"], dtype="int64")

    dense = xs.unionByName(ys).groupBy("part", "val", "bx", "by").applyInPandas(forest, "u long, v long")
    return out.unionByName(dense)


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, doc_id: str = "doc_id",
                    text: str = "text", extra: list | None = None) -> DataFrame:
    """(doc_id, *extra, fp, root, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own
    included; root is the least fingerprint of the component. A null, empty or
    blank text has fingerprint 0 and links like any other; null doc_ids are
    passed over in the minimum (null if a component has no other); repeated rows
    and equal doc_ids stay as they are; an empty table gives an empty one. Only
    the named columns are read, whatever else the table has."""
    rows = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), *(extra or [])), width, "__text").drop("__text")
    rows = cut_lineage(rows)
    firsts = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = component_roots(links(firsts.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = cut_lineage(firsts.join(roots, "fp"))
    low = linked.groupBy("root").agg(F.min("first").alias("low"))
    of_linked = linked.join(low, "root").select("fp", "root", "low")
    of_all = (firsts.join(of_linked, "fp", "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("low", "first").alias("component_id")))
    return rows.join(of_all, "fp", "left").select("doc_id", *[c for c in rows.columns if c not in ("doc_id", "fp")], "fp", "root", "component_id")


def keep_one(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest
    doc_id (null last; ties by row hash, equal rows once). Columns as given."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = cut_lineage(near_duplicates(docs, width, max_bits, extra=[whole.alias("row")]).select("doc_id", "row", "root"))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    firsts = rows.groupBy("root").agg(F.min(rank).alias("w"))
    winners = cut_lineage(firsts.select(F.col("w.doc_id").alias("w_id"), F.col("w.row").alias("w_row")))
    equal_rows = rows.groupBy("row", "doc_id").count().where("count > 1")
    equal_rows = equal_rows.join(winners, [F.col("doc_id").eqNullSafe(F.col("w_id")), F.col("row") == F.col("w_row")], "left_semi")
    tagged = docs.withColumn("__row", whole)
    kept = tagged.join(winners, [tagged["doc_id"].eqNullSafe(F.col("w_id")), F.col("__row") == F.col("w_row")], "left_semi")
    if not equal_rows.isEmpty():
        kept = kept.dropDuplicates(["__row", "doc_id"])
    return kept.drop("__row")
