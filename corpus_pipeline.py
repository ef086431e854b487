"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import exact_dedup, mixing, packing, quality_cnn, similar
from tidepanel.llm.common import documents, durable, labels

STAGES = [
    ("quality_classifier", lambda spark, docs, sf_dir: quality_cnn.keep_quality(docs, labels(spark, sf_dir))),
    ("exact_dedup", lambda spark, docs, sf_dir: exact_dedup.drop_exact_duplicates(docs)),
    ("simhash_near_dedup", lambda spark, docs, sf_dir: similar.drop_similar(docs)),
    ("mixing", lambda spark, docs, sf_dir: mixing.mixed_documents(docs)),
    ("packing", lambda spark, docs, sf_dir: packing.pack_documents(docs)),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's table is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = durable(docs) if i + 1 < len(STAGES) else docs
    return docs
