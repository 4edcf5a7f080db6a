"""URL filter: allow and block rules, and gradient-boosted trees for the rest.

The longest rule that fits decides. URLs that a rule decides are the labelled
URLs; trees are boosted on their lexical features (length, depth, digit ratio,
entropy, parameter counts and statistics of the host's suffixes) and judge the
URLs that no rule fits.
"""
from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

#: (verdict, rule): host suffix and path prefix.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Distinct labelled URLs that the trees are fitted on at most, taken by hash within each label.
FIT_ROWS = 20_000
#: Share of these that each label has at least, if it has as many URLs.
LEAST_SHARE = 0.1
#: Kinds of suffix that have statistics: first path segment, last host label, last two host labels.
KINDS = ("segment", "tld", "tail")
#: Pseudo-count of the overall share in a suffix's share of blocked URLs.
PRIOR = 10.0

FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "n_query_chars",
            "n_hyphens", "n_labels", "longest_segment", "has_extension", "is_https", "has_fragment",
            "segment_share", "tld_share", "tail_share"]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to /, ?, # or the end, A-Z lower-cased;
    path on from there up to ? or # or the end. Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def match(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null if none does. Of equally
    long rules the one listed first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):  # from short to long: a later rule goes before
        suffix, _, prefix = r.partition("/")
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character, from the counts of the distinct characters."""
    chars = F.split(text, "")
    n = F.length(text).cast("double")
    p = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - p(c) * F.log2(p(c)))).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (columns url, host, path) with the lexical features that need no statistics."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return urls.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": F.size(segments).cast("double"),
        "digit_ratio": F.when(url != "", _count(url, "[^0-9]") / F.length(url)).otherwise(0.0),
        "entropy": entropy(url),
        "n_params": F.when(query == "", 0.0).otherwise(_count(query, "[^&]") + 1.0), "n_query_chars": F.length(query).cast("double"),
        "n_hyphens": _count(url, "[^-]"), "n_labels": F.size(F.split(host, r"\.")).cast("double"),
        "longest_segment": F.coalesce(F.array_max(F.transform(segments, lambda s: F.length(s))), F.lit(0)).cast("double"),
        "has_extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "is_https": url.startswith("https:").cast("double"), "has_fragment": url.contains("#").cast("double"),
        "segment": F.coalesce(F.get(segments, F.lit(0)), F.lit("")), "tld": F.substring_index(host, ".", -1), "tail": F.substring_index(host, ".", -2),
    })


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(kind, value, n, s): labelled URLs and blocked URLs of every value of each kind,
    counted over all labelled URLs (url_label 0/1)."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in KINDS]))
    return labelled.select("url_label", each.alias("e")).groupBy("e.kind", "e.value").agg(F.count("*").cast("double").alias("n"), F.sum("url_label").alias("s"))


def with_shares(rows: DataFrame, stats: DataFrame, overall: float, leave_out: bool) -> DataFrame:
    """``rows`` with segment_share, tld_share, tail_share: smoothed shares of blocked URLs;
    a value without labelled URLs has the overall share. ``leave_out`` takes a labelled
    row's own label out of its statistics."""
    mine, one = (F.col("url_label"), 1.0) if leave_out else (F.lit(0.0), 0.0)
    for kind in KINDS:
        of = stats.where(F.col("kind") == kind).select(F.col("value").alias("__v"), F.col("n").alias("__n"), F.col("s").alias("__s"))
        rows = rows.join(of, F.col(kind) == F.col("__v"), "left")
        known = (F.col("__s") - mine + PRIOR * overall) / (F.col("__n") - one + PRIOR)
        rows = rows.withColumn(f"{kind}_share", F.coalesce(known, F.lit(overall))).drop("__v", "__n", "__s")
    return rows


def fit(labelled: DataFrame, stats: DataFrame, overall: float, fit_rows: int = FIT_ROWS) -> GBTClassificationModel | None:
    """Trees boosted on up to ``fit_rows`` distinct labelled URLs, of each label those of the
    least URL hash, as many as its share (None if not both labels occur)."""
    by_hash = F.xxhash64("url"), F.col("url")
    blocked = round(fit_rows * min(max(overall, LEAST_SHARE), 1 - LEAST_SHARE))
    one = lambda label, n: labelled.where(F.col("url_label") == label).orderBy(*by_hash).limit(n)
    sample = one(1.0, blocked).unionByName(one(0.0, fit_rows - blocked))
    # at most ``fit_rows`` rows, in one order whatever the joins, as the trees' splits depend on it
    ordered = with_shares(sample, stats, overall, leave_out=True).repartition(1).sortWithinPartitions(*by_hash)
    rows = cut_lineage(ordered.select("url_label", *FEATURES))
    if rows.select("url_label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return GBTClassifier(labelCol="url_label", featuresCol="features", maxIter=10, maxDepth=4, maxBins=32, stepSize=0.2, seed=17,
                         cacheNodeIds=False).fit(data)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, page_id: str = "page_id", url: str = "url",
                block_at: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score), one row per row of ``pages``.

    verdict is the rule's, else block where the trees' probability of block
    (block_score, null where a rule decides) is at least ``block_at``. Without
    labelled URLs of both kinds the overall share of blocked ones (0.5 without
    any) stands in for the trees. A URL is learned from once, however many rows have it. Null and malformed URLs have an empty host and
    path, fit no rule and are judged on their features; repeated rows stay; an
    empty table gives an empty one; only the two named columns are read."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    host, path = parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = match(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    featured = lexical(rows)
    known = rows.where(F.col("by_rule").isNotNull()).select("url", "host", "path", (F.col("by_rule") == "block").cast("double").alias("url_label"))
    labelled = lexical(cut_lineage(known.distinct()))
    n, blocked = labelled.agg(F.count("*"), F.sum("url_label")).first()
    overall = blocked / n if n else 0.5
    stats = cut_lineage(suffix_statistics(labelled))
    model = fit(labelled, stats, overall, fit_rows) if n else None
    scored = with_shares(featured, stats, overall, leave_out=False)
    if model is None:
        scored = scored.withColumn("block_score", F.lit(overall))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(scored))
        scored = scored.withColumn("block_score", vector_to_array("probability")[1])
    free = F.col("by_rule").isNull()
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("by_rule", F.when(F.col("block_score") >= block_at, "block").otherwise("allow")).alias("verdict"),
                         F.when(free, F.col("block_score")).alias("block_score"))
