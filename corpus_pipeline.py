"""Corpus pipeline: five stages over ``documents``, each written and read again.

toxicity (rejected documents go) -> line dedup -> SimHash near-dedup (one document of each group
stays) -> benchmark decontamination (documents that contain a test item go) -> best-fit packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from volpanel.llm import decontamination, line_dedup, packing, simhash, toxicity
from volpanel.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: the chain of fitted models and the packing are not expressible in SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
