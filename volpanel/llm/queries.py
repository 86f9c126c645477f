"""Registered queries of the corpus operators: each applies its operator to its whole table and
derives the returned columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.llm import decontamination, fingerprint, hard_negatives, html_extract, line_dedup, minhash_tensor, packing, pii
from volpanel.llm import simhash, substring_dedup, token_alignment, toxicity, warc
from volpanel.llm.common import table


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup.report(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", "kept_sha256")


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.dedup_report(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(packing.pieces(table(spark, sf_dir, "documents")))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def q_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def q_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_tensor.near_groups(table(spark, sf_dir, "documents"))


def q_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {
    "op1_decontamination": q_decontamination,
    "op2_toxicity": q_toxicity,
    "op3_substring_dedup": q_substring_dedup,
    "op4_line_dedup": q_line_dedup,
    "op5_html_extract": q_html,
    "op6_warc": q_warc,
    "op7_packing": q_packing,
    "op8_simhash": q_simhash,
    "op9_fingerprint": q_fingerprint,
    "op10_pii": q_pii,
    "op11_token_alignment": q_alignment,
    "op12_hard_negatives": q_hard_negatives,
    "op13_minhash_tensor": q_minhash,
    "pipeline": q_pipeline,
}
