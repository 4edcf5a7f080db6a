"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_rotation, conversation_trie, decontamination, html_extraction, language_id, line_dedup, merkle_manifest, mixing, pii,
               quality_rules, simhash_dedup, toxicity, url_filter)
from .oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of sources weighted by the root of their size."""
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose best window reaches similarity 0.8."""
    return decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text less the boilerplate lines of its source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, dropped="n_dropped_lines")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and verdict of every document under policy v2."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"), "v2")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v2 rejects, alone and at all, over the ledger of every document."""
    return quality_rules.ablation(quality_rules.ledger(_table(spark, sf_dir, "documents")), "v2")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from the perspective of each participant."""
    turns = chat_rotation.rotate(_table(spark, sf_dir, "conversations"))
    spans = F.transform("train_spans", lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))
    mask = F.transform("train_mask", lambda x: x.cast("string"))
    return turns.withColumns({"train_spans": F.array_join(spans, ","), "train_mask": F.array_join(mask, "")})


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract_main_text(_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.find_pii(_table(spark, sf_dir, "documents")).drop("base")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each beginning with turns lent by the first of its five."""
    turns = conversation_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.with_lent_turns(turns))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, and whether it still verifies after half the texts lost their line ends."""
    docs = _table(spark, sf_dir, "documents")
    return merkle_manifest.manifest(docs, merkle_manifest.without_newlines_in_half(docs))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    out = language_id.identify(_table(spark, sf_dir, "documents"), ~language_id.held_out(F.col("doc_id")))
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


SPARK_QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_decontaminate, op3_chat_rotation, op4_html_extraction, op5_line_dedup, op6_quality_rules,
    op7_simhash_dedup, op8_toxicity, op9_pii, op10_url_filter, op11_conversation_trie, op12_merkle_manifest,
    op13_language_id, quality_ablation)}

__all__ = ["ORACLE_SQL", "SPARK_QUERIES"]
