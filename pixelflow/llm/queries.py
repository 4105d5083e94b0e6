"""The registered queries of this subpackage: one per operator, each over its
whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelflow.llm import apportion, hilbert_ann, host_paths, jaccard_join, pair_bpe, periodic_runs, pii_anchor, ppm_langid, prefix_trie, quality_ledger, secret_scan, set_decontam, toxicity_gru
from pixelflow.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), n("random"),
                        F.sha2(secret_scan.render(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.render(F.col("spans")).alias("spans"))


def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_ledger.ledger(table(spark, sf_dir, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~quality_ledger.passes(quality_ledger.BASE)).alias("base_failed"),
                      quality_ledger.passes(quality_ledger.STRICT).alias("kept"), "fail_bits")


def op3_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = pair_bpe.round_trip(table(spark, sf_dir, "documents"), path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op4_pii_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_anchor.find(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["ord"] < pii_anchor.N_BASE)
    return found.select("doc_id", *[n(k) for k in pii_anchor.KINDS],
                        F.sha2(pii_anchor.render(base).cast("binary"), 256).alias("base_sha256"),
                        pii_anchor.render(F.col("spans")).alias("spans"))


def op5_mix_apportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = apportion.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.cluster(table(spark, sf_dir, "documents"))


def op8_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity_gru.train(*toxicity_gru.training_rows(docs, table(spark, sf_dir, "labels"), toxicity_gru.GruConfig()))
    return toxicity_gru.predict(docs, net).select(
        "doc_id", toxicity_gru.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_paths.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = ppm_langid.predict(docs, ppm_langid.train(docs))
    return out.select("doc_id", ppm_langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op11_set_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = set_decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.scan(table(spark, sf_dir, "documents"), plant=True).drop("runs")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_quality_ledger, op3_pair_bpe, op4_pii_anchor, op5_mix_apportion,
                                   op6_hilbert_ann, op7_jaccard_join, op8_toxicity_gru, op9_host_paths, op10_ppm_langid, op11_set_decontam,
                                   op12_periodic_runs, op13_prefix_trie)}
