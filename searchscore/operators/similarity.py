"""J3 Jaccard pairs (exact and MinHash), A4 term-term cosine (exact and DIMSUM),
M3 field concatenation, M5 distance columns.

Exact Jaccard pairs (``jaccard_pairs``) work on distinct token sets: rows with
the same set collapse into one set with a row count, so a query repeated by a
third of all rows is one set, and identical rows never pair up with each other
row by row. Candidates come from prefix filtering (Bayardo et al. 2007;
Vernica et al. 2010; Xiao et al. 2008): tokens are ordered rarest first, and
two sets with Jaccard similarity >= t must share a token among short prefixes
of both (the smaller set indexes |x| - ceil(2t/(1+t)|x|) + 1 tokens, the larger
probes with |y| - ceil(t|y|) + 1), sizes must be within a factor t, and the positions
of their first common token must leave room for enough overlap. Frequent
tokens sort last and rarely enter a prefix, so they add few candidate pairs;
a token that still has many rows is dealt into block pairs over many tasks.
The method stays exact (no cap, no sampling). Each candidate comes up once and
is then verified on the full sets.

Term-term cosine (``term_similarity``) is the column similarity of the
row x term matrix: for every pair of terms co-occurring in a row, the sum over
rows of the product of their values, divided by both column norms. Rows are
short texts (title and query), pairs are built inside each row from its own
term array, and sums are combined map-side before the shuffle on the pair.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize_ws
from ..session import cut_lineage
from .sampling import BUCKETS, hash_bucket

EPS = 1e-9
#: Rows of one token (or band) value on one side that are still joined in one task.
BLOCK_ROWS = 2048
#: Hexadecimal digits of a token's MD5 that order it in a permutation.
MINHASH_DIGITS = 12


def token_sets(df: DataFrame, text_col: str, tokenizer=tokenize_ws) -> DataFrame:
    """Distinct non-empty token sets of a text column with their row counts.

    Columns: set_key (sorted tokens joined by a space), tokens (sorted array),
    n_rows. Rows whose text has no token are left out (an empty set has no
    defined Jaccard distance).
    """
    toks = F.array_sort(F.array_distinct(F.filter(tokenizer(F.col(text_col)), lambda t: t != "")))
    # Grouped by the string key with the array as an aggregate result: a
    # predicate inferred later on the array (e.g. by an ML transformer's UDF)
    # then cannot be pushed below the aggregate, ahead of the non-empty filter.
    return (df.select(toks.alias("tokens"))
            .where(F.size("tokens") > 0)
            .select(F.array_join("tokens", " ").alias("set_key"), "tokens")
            .groupBy("set_key")
            .agg(F.first("tokens").alias("tokens"), F.count("*").cast("long").alias("n_rows")))


def _prefixes(sets: DataFrame, min_similarity: float) -> DataFrame:
    """(tid, set_key, k, pos, before, in_index): the prefix tokens of each set under the global
    rarest-first order, with the tokens of the set that come before.

    With sets ordered by (size, key) and x before y, J(x, y) >= t implies an
    overlap of at least ceil(2t/(1+t) |x|) and at least ceil(t |y|) tokens, so
    x's first |x| - ceil(2t/(1+t) |x|) + 1 tokens (index prefix) and y's first
    |y| - ceil(t |y|) + 1 tokens (probe prefix) share a token (PPJoin, Xiao et
    al. 2008). Rounding is taken downwards, which only lengthens prefixes.
    Tokens are numbered; equally frequent ones are ordered by number, and any
    numbering gives the same pairs.
    """
    t = min_similarity
    entries = sets.select("set_key", F.explode("tokens").alias("token"))
    vocabulary = entries.groupBy("token").agg(F.count("*").alias("freq")).withColumn("tid", F.monotonically_increasing_id())
    ranked = (entries.join(cut_lineage(vocabulary), "token").groupBy("set_key")
              .agg(F.array_sort(F.collect_list(F.struct("freq", "tid"))).alias("r")))
    k = F.size("r")
    need_probe = F.greatest(F.lit(1), F.ceil(F.lit(t) * k - F.lit(EPS)))
    need_index = F.greatest(F.lit(1), F.ceil(F.lit(2 * t / (1 + t)) * k - F.lit(EPS)))
    ranked = ranked.select("set_key", k.alias("k"), (k - need_index + 1).alias("index_len"),
                           F.transform(F.slice("r", 1, (k - need_probe + 1).cast("int")), lambda x: x["tid"]).alias("prefix"))
    return (ranked.select("set_key", "k", "index_len", "prefix", F.posexplode("prefix").alias("i", "tid"))
            .select("tid", "set_key", "k", (F.col("i") + 1).alias("pos"), F.slice("prefix", F.lit(1), F.col("i")).alias("before"),
                    (F.col("i") < F.col("index_len")).alias("in_index")))


def _dealt(entries: DataFrame, key: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(x, y): the index rows and all rows of ``entries``, to be joined on (key, _bi, _bj).

    A key of more than ``block_rows`` rows on a side is cut into blocks by set, and
    every block of one side meets every block of the other in a join key of its
    own, so a token that a third of all sets hold is no single task. Every pair of
    an x row and a y row of a key still meets exactly once."""
    n_index, n_all = F.count_if("in_index"), F.count("*")
    full = (entries.groupBy(key).agg(F.greatest(F.lit(1), F.ceil(n_index / block_rows)).cast("int").alias("_nx"), F.ceil(n_all / block_rows).cast("int").alias("_ny"))
            .where("_nx > 1 or _ny > 1"))
    tagged = entries.join(full, key, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_nx", "_ny")})
    own = lambda n: F.pmod(F.xxhash64("set_key"), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = tagged.where("in_index").withColumn("_bi", own("_nx")).withColumn("_bj", every("_ny"))
    y = tagged.withColumn("_bj", own("_ny")).withColumn("_bi", every("_nx"))
    return x.drop("_nx", "_ny").alias("x"), y.drop("_nx", "_ny").alias("y")


def _verified(cands: DataFrame, sets: DataFrame, max_distance: float) -> DataFrame:
    """The candidates (set_a, set_b) within ``max_distance``, measured on the whole sets."""
    sa = sets.select(F.col("set_key").alias("set_a"), F.col("tokens").alias("tok_a"),
                     F.col("n_rows").alias("n_rows_a"))
    sb = sets.select(F.col("set_key").alias("set_b"), F.col("tokens").alias("tok_b"),
                     F.col("n_rows").alias("n_rows_b"))
    inter = F.size(F.array_intersect("tok_a", "tok_b"))
    union = F.size("tok_a") + F.size("tok_b") - inter
    return (cands.join(sa, "set_a").join(sb, "set_b")
            .withColumn("intersection", inter.cast("int"))
            .withColumn("jaccard_distance", F.lit(1.0) - inter.cast("double") / union.cast("double"))
            .where(F.col("jaccard_distance") <= F.lit(max_distance) + F.lit(EPS))
            .withColumn("jaccard_similarity", F.lit(1.0) - F.col("jaccard_distance"))
            .select("set_a", "set_b", "n_rows_a", "n_rows_b", "intersection",
                    "jaccard_distance", "jaccard_similarity"))


def candidate_pairs(sets: DataFrame, min_similarity: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(set_a, set_b), each once: pairs that share a prefix token and may reach ``min_similarity``.

    A pair is given only where its first common token meets, that is where no token
    before is common, so there is nothing to make distinct afterwards. The positions
    there also bound the overlap (positional filter): one, and what is left after
    the token in the set that has less left."""
    t = min_similarity
    x, y = _dealt(_prefixes(sets, t), "tid", block_rows)
    smaller = ((F.col("x.k") < F.col("y.k"))
               | ((F.col("x.k") == F.col("y.k")) & (F.col("x.set_key") < F.col("y.set_key"))))
    size_ok = F.col("x.k") >= F.lit(t) * F.col("y.k") - F.lit(EPS)
    most = F.lit(1) + F.least(F.col("x.k") - F.col("x.pos"), F.col("y.k") - F.col("y.pos"))
    enough = most >= F.lit(t / (1 + t)) * (F.col("x.k") + F.col("y.k")) - F.lit(EPS)
    first = ~F.arrays_overlap("x.before", "y.before")
    met = (F.col("x.tid") == F.col("y.tid")) & (F.col("x._bi") == F.col("y._bi")) & (F.col("x._bj") == F.col("y._bj"))
    return (x.join(y, met & smaller & size_ok & enough & first)
            .select(F.least("x.set_key", "y.set_key").alias("set_a"), F.greatest("x.set_key", "y.set_key").alias("set_b")))


def jaccard_pairs(df: DataFrame, text_col: str, max_distance: float = 0.8,
                  include_self_and_mirror: bool = False, tokenizer=tokenize_ws, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """J3 exact + M5: pairs of distinct token sets within ``max_distance``.

    Output: set_a < set_b (keys), n_rows_a, n_rows_b, intersection,
    jaccard_distance, jaccard_similarity. ``include_self_and_mirror`` adds
    (b, a) and (a, a) rows, the raw self-join form.

    ``max_distance`` must be below 1: at 1 every pair of sets qualifies,
    including disjoint ones, which is a cross product and not a join.
    """
    if not 0.0 <= max_distance < 1.0:
        raise ValueError("max_distance must be in [0, 1); at 1 every pair matches")
    t = 1.0 - max_distance
    # The set table is read several times below (prefixes, two verification
    # lookups, self pairs); each read would otherwise recompute it from every
    # row of ``df``. It holds one row per distinct set: keep it once.
    sets = cut_lineage(token_sets(df, text_col, tokenizer))
    pairs = _verified(candidate_pairs(sets, t, block_rows), sets, max_distance)
    if include_self_and_mirror:
        mirror = pairs.select(F.col("set_b").alias("set_a"), F.col("set_a").alias("set_b"),
                              F.col("n_rows_b").alias("n_rows_a"), F.col("n_rows_a").alias("n_rows_b"),
                              "intersection", "jaccard_distance", "jaccard_similarity")
        selfp = sets.select(F.col("set_key").alias("set_a"), F.col("set_key").alias("set_b"),
                            F.col("n_rows").alias("n_rows_a"), F.col("n_rows").alias("n_rows_b"),
                            F.size("tokens").cast("int").alias("intersection"),
                            F.lit(0.0).alias("jaccard_distance"), F.lit(1.0).alias("jaccard_similarity"))
        pairs = pairs.unionByName(mirror).unionByName(selfp)
    return pairs


def minhash_bands(min_similarity: float, rows: int = 1, recall: float = 0.97) -> int:
    """Bands of ``rows`` permutations with which a pair of ``min_similarity`` is found with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min_similarity ** rows))) if min_similarity < 1 else 1


def minhash_pairs(df: DataFrame, text_col: str, max_distance: float = 0.8, rows: int = 1, bands: int | None = None,
                  seed: int = 1, tokenizer=tokenize_ws, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """J3 approximate: MinHash signatures of the distinct token sets, joined band by band.

    Permutation i gives a token the first 12 hexadecimal digits of MD5("seed:i:token"),
    the same in any engine; a signature holds the least of each. Sets that agree in
    all ``rows`` values of a band are candidates, given at the first band they agree
    in, and measured on the whole sets: what is returned is exact, and some of
    ``jaccard_pairs`` may be missing (``minhash_bands`` sets the number of bands,
    ``minhash_recall`` measures). A band value that many sets share is dealt into
    block pairs. Same columns as ``jaccard_pairs``.
    """
    if not 0.0 <= max_distance < 1.0:
        raise ValueError("max_distance must be in [0, 1)")
    bands = bands or minhash_bands(1.0 - max_distance, rows)
    sets = cut_lineage(token_sets(df, text_col, tokenizer))
    least = lambda i: F.array_min(F.transform("tokens", lambda w: F.substring(F.md5(F.concat(F.lit(f"{seed}:{i}:"), w)), 1, MINHASH_DIGITS)))
    values = [F.concat(F.lit(f"{b}:"), *[least(b * rows + r) for r in range(rows)]) for b in range(bands)]
    signed = sets.select("set_key", F.array(*values).alias("s"))
    entries = signed.select("set_key", "s", F.posexplode("s").alias("i", "band")).select(
        "band", "set_key", F.slice("s", F.lit(1), F.col("i")).alias("before"), F.lit(True).alias("in_index"))
    x, y = _dealt(entries, "band", block_rows)
    met = (F.col("x.band") == F.col("y.band")) & (F.col("x._bi") == F.col("y._bi")) & (F.col("x._bj") == F.col("y._bj"))
    cands = (x.join(y, met & (F.col("x.set_key") < F.col("y.set_key")) & ~F.arrays_overlap("x.before", "y.before"))
             .select(F.col("x.set_key").alias("set_a"), F.col("y.set_key").alias("set_b")))
    return _verified(cands, sets, max_distance)


def minhash_pairs_ml(df: DataFrame, text_col: str, max_distance: float = 0.8,
                     num_hash_tables: int = 3, seed: int = 1, num_features: int = 20000,
                     tokenizer=tokenize_ws) -> DataFrame:
    """J3 approximate by Spark ML: sets hashed to ``num_features`` slots (``HashingTF``, binary)
    and joined with ``MinHashLSHModel.approxSimilarityJoin``.

    Pairs with set_a < set_b and the distance of the hashed sets; recall is below 1
    by design and lower than that of ``minhash_pairs`` at three tables.
    """
    from pyspark.ml.feature import HashingTF, MinHashLSH

    sets = token_sets(df, text_col, tokenizer)
    vec = HashingTF(inputCol="tokens", outputCol="vec", numFeatures=num_features,
                    binary=True).transform(sets)
    model = MinHashLSH(inputCol="vec", outputCol="lsh", numHashTables=num_hash_tables,
                       seed=seed).fit(vec)
    joined = model.approxSimilarityJoin(vec, vec, max_distance, distCol="jaccard_distance")
    return (joined.where(F.col("datasetA.set_key") < F.col("datasetB.set_key"))
            .select(F.col("datasetA.set_key").alias("set_a"), F.col("datasetB.set_key").alias("set_b"),
                    "jaccard_distance",
                    (F.lit(1.0) - F.col("jaccard_distance")).alias("jaccard_similarity")))


def concat_fields(weights: DataFrame, fields=None, value: str = "weight") -> DataFrame:
    """M3: the field vectors of each id as one vector over (field, token) columns.

    Long form: (id, term = field || ':' || token, value).
    """
    w = weights if fields is None else weights.where(F.col("field").isin(*fields))
    return w.select("id", F.concat_ws(":", "field", "token").alias("term"),
                    F.col(value).cast("double").alias("value"))


def term_similarity(entries: DataFrame, min_similarity: float = 0.1) -> DataFrame:
    """A4 exact: cosine similarity of term columns of a (id, term, value) matrix.

    Output: term_a < term_b, similarity of at least ``min_similarity`` (pairs that
    never co-occur are 0 and left out, as in a sparse result).
    """
    # One shuffle on id serves both aggregates (hash on id clusters (id, term) too).
    cells = (entries.repartition("id").groupBy("id", "term").agg(F.sum("value").alias("value")))
    per_row = cells.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", "value"))).alias("e"))
    # The left term first, then the terms after it: a row of L terms is never an
    # array of L * L / 2 pairs, only a slice of itself at a time.
    left = per_row.select("e", F.posexplode("e").alias("i", "x"))
    rest = F.slice("e", F.col("i") + 2, F.greatest(F.size("e") - F.col("i") - 1, F.lit(0)))
    dots = (left.select("x", F.explode(rest).alias("y"))
            .groupBy(F.col("x.term").alias("term_a"), F.col("y.term").alias("term_b"))
            .agg(F.sum(F.col("x.value") * F.col("y.value")).alias("dot")))
    # Norms from the same per-row arrays as the pair products.
    norms = (per_row.select(F.explode("e").alias("x"))
             .groupBy(F.col("x.term").alias("term"))
             .agg(F.sqrt(F.sum(F.col("x.value") * F.col("x.value"))).alias("norm")))
    na = norms.select(F.col("term").alias("term_a"), F.col("norm").alias("norm_a"))
    nb = norms.select(F.col("term").alias("term_b"), F.col("norm").alias("norm_b"))
    sim = F.col("dot") / (F.col("norm_a") * F.col("norm_b"))
    out = (dots.join(na, "term_a").join(nb, "term_b")
           .select("term_a", "term_b", sim.alias("similarity")))
    if min_similarity > 0:
        out = out.where(F.col("similarity") >= F.lit(min_similarity - EPS))
    return out


def sampling_gamma(n_terms: int, threshold: float) -> float:
    """DIMSUM's oversampling parameter: 10 ln(number of columns) / threshold."""
    return 10.0 * math.log(max(n_terms, 2)) / threshold


def term_similarity_sampled(entries: DataFrame, threshold: float = 0.1, min_similarity: float = 0.0) -> DataFrame:
    """A4 approximate: DIMSUM in long form, over the (id, term, value) matrix itself.

    Columns are scaled by their largest value, which leaves cosines as they are. An
    entry of a column of norm |c| is kept with probability min(1, sqrt(gamma) / |c|)
    and then divided by min(sqrt(gamma), |c|), so the products of a row's kept
    entries add up to the cosine without bias, and a term that every row holds
    gives as many entries as a term of norm sqrt(gamma). The standard error
    of a pair of similarity s is at most sqrt(s / gamma); pairs of columns that are
    both short of sqrt(gamma) are exact. MD5 of (id, term) decides what is kept: the
    same entries under any partitioning, retry or engine.
    Output as ``term_similarity``."""
    cells = cut_lineage(entries.repartition("id").groupBy("id", "term").agg(F.sum("value").alias("value")))
    top = F.max(F.abs("value"))
    stats = cut_lineage(cells.where("value <> 0").groupBy("term").agg(top.alias("top"), (F.sqrt(F.sum(F.col("value") * F.col("value"))) / top).alias("norm")))
    root = math.sqrt(sampling_gamma(stats.count(), threshold))
    kept = cells.join(stats, "term").where(hash_bucket(F.concat_ws(":", F.col("id").cast("string"), F.col("term"))) < F.lit(root) / F.col("norm") * F.lit(float(BUCKETS)))
    kept = kept.select("id", "term", (F.col("value") / F.col("top") / F.least(F.lit(root), F.col("norm"))).alias("value"))
    per_row = kept.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", "value"))).alias("e"))
    left = per_row.select("e", F.posexplode("e").alias("i", "x"))
    rest = F.slice("e", F.col("i") + 2, F.greatest(F.size("e") - F.col("i") - 1, F.lit(0)))
    out = (left.select("x", F.explode(rest).alias("y"))
           .groupBy(F.col("x.term").alias("term_a"), F.col("y.term").alias("term_b"))
           .agg(F.sum(F.col("x.value") * F.col("y.value")).alias("similarity")))
    return out.where(F.col("similarity") >= F.lit(min_similarity - EPS)) if min_similarity > 0 else out


def sampling_error(exact: DataFrame, sampled: DataFrame, gamma: float, width: float = 4.0) -> DataFrame:
    """(n_pairs, n_inside, inside): exact pairs, and how many of them the sampled form has within
    ``width`` standard errors sqrt(similarity / gamma) (a pair it lacks counts as 0)."""
    est = sampled.select("term_a", "term_b", F.col("similarity").alias("est"))
    both = exact.join(est, ["term_a", "term_b"], "left")
    inside = F.abs(F.coalesce("est", F.lit(0.0)) - F.col("similarity")) <= F.lit(width) * F.sqrt(F.col("similarity") / F.lit(gamma)) + F.lit(EPS)
    return (both.agg(F.count("*").alias("n_pairs"), F.count_if(inside).alias("n_inside"))
            .select("n_pairs", "n_inside", (F.col("n_inside") / F.greatest(F.col("n_pairs"), F.lit(1))).alias("inside")))


def term_similarity_dimsum(vectors: DataFrame, vector_cols, threshold: float = 0.1) -> DataFrame:
    """A4 approximate: DIMSUM column similarities of one or more vector columns.

    Several columns are concatenated side by side (M3, e.g. title then
    query). Uses ``RowMatrix.columnSimilarities(threshold)``: pairs above the
    threshold are estimated without bias, smaller ones may be dropped.
    Output: (i, j, similarity) column indices, i < j. Vectors are put together
    and read by the JVM; no row passes through Python.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    cols = [vector_cols] if isinstance(vector_cols, str) else list(vector_cols)
    joined = VectorAssembler(inputCols=cols, outputCol="_vec").transform(vectors.select(*cols)).select("_vec")
    # The similarity pass reads the rows twice (column norms, then pairs).
    rows = cut_lineage(MLUtils.convertVectorColumnsFromML(joined, "_vec"))
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], "i long, j long, similarity double")
    sims = RowMatrix(rows).columnSimilarities(threshold)
    return sims.entries.toDF(["i", "j", "similarity"])


def minhash_recall(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """Share of exact pairs that the approximate join found (one row)."""
    hits = approx.select("set_a", "set_b", F.lit(1).alias("_hit")).distinct()
    return (exact.select("set_a", "set_b").join(hits, ["set_a", "set_b"], "left")
            .agg(F.count("*").alias("n_exact"), F.count("_hit").alias("n_found"))
            .select("n_exact", "n_found",
                    (F.col("n_found") / F.greatest(F.col("n_exact"), F.lit(1))).alias("recall")))
