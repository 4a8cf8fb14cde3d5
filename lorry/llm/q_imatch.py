"""Query of operator 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorry.llm import imatch


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return imatch.fingerprint_edits(docs, imatch.lexicon(docs))
