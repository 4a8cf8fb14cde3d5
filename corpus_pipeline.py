"""Corpus pipeline: the stages that turn ``documents`` into a training corpus.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame: the rows
it keeps with the columns of ``documents``, the last one the token ids.  Rows
with a null ``doc_id`` pass the stages that decide by id unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import bpe, fm, graph, minhash, pii, tiling
from lorry.llm.q_bpe import vocabulary
from lorry.llm.q_fm import ACCEPT
from lorry.llm.q_pii import KEY
from lorry.session import small_batches, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return docs.where(fm.score_of(docs, fm.train(docs, labels)) >= ACCEPT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates
    (linked from a Jaccard likeness of word shingles of 0.80, not operator 5's 0.85)."""
    small_batches(spark)
    members = minhash.near_duplicates(docs, percent=80)
    return graph.without(docs, stage(members.where("doc_id <> component_id").select("doc_id").distinct(), "dropped"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = tiling.contaminated(tiling.tile_documents(docs, items))
    return graph.without(docs, stage(found.select("doc_id"), "contaminated"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    small_batches(spark)
    changed = pii.replace_entities(docs, KEY)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: ``doc_id, lang, source, n_tokens, ids``
    (little-endian unsigned 32-bit integers)."""
    small_batches(spark)
    ranks, pattern = vocabulary()
    # workers of the stages before are kept: what is remembered of strings is small and goes with its task
    encoded = bpe.encode(docs, ranks, pattern, keep=("doc_id", "lang", "source"), entries=60_000, lasting=False)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII surrogates", surrogates),
    ("byte-level BPE", tokens),
]

#: no SQL for a trained classifier or BPE merges; tests/llm hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
