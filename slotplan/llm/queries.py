"""One query per operator of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_topk, jaccard_join, licences, line_dedup, mixing, oracle, quality_rules, sentencepiece_lattice,
    substring_dedup, token_alignment, toxicity, url_reputation, warc, whitening,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    base = quality_rules.mask_of(quality_rules.POLICIES["base"])
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.linked_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose crc32(doc_id) modulo 5 is 0 are held out of training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    out = toxicity.score(docs, toxicity.train(docs, labels))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "spans")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_lattice.load()
    return sentencepiece_lattice.encode(table(spark, sf_dir, "documents"), model)


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a page: the label row of its id says quality 0 (bad) or 1."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    out = url_reputation.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = quality_rules.split_words(F.col("kept_text"))
    words = F.coalesce(words, F.array().cast("array<string>"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


MIX_TARGETS = {"clean": 0.9, "toxic": 0.05, "junk": 0.05}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    out = mixing.mix(table(spark, sf_dir, "documents"), labels, MIX_TARGETS)
    return out.select("doc_id", "n_tokens", *[F.col("posterior")[d].alias(f"p_{d}") for d in MIX_TARGETS], "rate")


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_matches", F.array_join("licences", ", ").alias("licences"),
                        F.array_join(F.transform("finds", lambda m: m["rule"]), ", ").alias("rules"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``keep``: the runs of kept lines, ``start+length`` each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.restore(docs, line_dedup.keep_bitmaps(docs))
    runs = F.transform("keep", lambda r: F.concat_ws("+", r["start"].cast("string"), r["length"].cast("string")))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"),
                      F.array_join(runs, " ").alias("keep"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_url_reputation": op4_url_reputation,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_licence_scan": op8_licence_scan,
    "op9_exact_topk": op9_exact_topk,
    "op10_warc": op10_warc,
    "op11_line_dedup": op11_line_dedup,
    "op12_whitening": op12_whitening,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE: dict[str, str] = {k: v for k, v in oracle.ORACLE.items() if k in QUERIES}
