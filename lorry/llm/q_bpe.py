"""Query of operator 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import bpe

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str = VOCABULARY) -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of a public vocabulary."""
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, and its ids decoded."""
    ranks, pattern = vocabulary()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bpe.encode(docs, ranks, pattern, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
