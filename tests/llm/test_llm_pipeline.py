"""The corpus pipeline against a brute-force version of its stages."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as P
from searchscore.llm import line_dedup
from searchscore.llm import quality_rules as Q

from conftest import SF_SMALL
from test_llm_decontamination import slow_best
from test_llm_line_dedup import slow as slow_lines
from test_llm_simhash_dedup import slow_components, slow_fingerprint


def test_run_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    def good(text):
        m = dict(zip([c.split()[0] for c in Q.MEASURES.split(", ")], Q.measure(text)))
        return not (m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"] or m["n_symbols"] > .1 * m["n_words"] or m["n_dup_lines"] > .5 * m["n_lines"]
                    or not 2 * m["n_words"] <= m["word_chars"] <= 20 * m["n_words"] or m["n_letters"] < .6 * m["word_chars"]
                    or m["n_upper"] > .7 * m["n_letters"] or m["top_word_count"] > .3 * m["n_words"])

    kept = [d for d in docs if good(d[1])]
    texts = slow_lines([(d[3], d[1]) for d in kept], 0.05, line_dedup.MIN_PAGES)
    kept = [(d[0], t, d[2], d[3], len(t) if t != d[1] else d[4]) for d, t in zip(kept, texts)]
    prints = [slow_fingerprint(d[1]) for d in kept]
    roots = slow_components(set(prints))
    first = {}
    for d, p in zip(kept, prints):
        first[roots[p]] = min(first.get(roots[p], d), d)
    kept = [d for d in first.values() if all(slow_best(d[1], i) < 0.8 for i in items)]
    out = P.run(spark, SF_SMALL)
    got = out.collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(kept) and 0 < len(kept) < len(docs)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    for r in got:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]


def test_stages_keep_columns_and_survive_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i}" for i in range(60))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, long, None, None, None), (2, long, None, None, None), (None, long + " x", "en", "s", 5)], schema)
    for docs in (odd, spark.createDataFrame([], T.StructType.fromDDL(schema))):
        n = docs.count()
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns[:5] == docs.columns
            if name != "mix":
                assert out.columns == docs.columns
            assert out.count() <= n
        clash = docs.withColumn("fp", F.lit(1)).withColumn("mix_slot", F.lit("x"))
        assert P.STAGES[2][1](spark, clash, SF_SMALL).columns == clash.columns


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_copies", "benchmark", "mix"]
