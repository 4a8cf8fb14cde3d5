"""Query of operator 10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import recount
from lorry.llm.q_bpe import vocabulary


def edits_of(doc_id: Column, text: Column) -> Column:
    """Three edits of every document, at places drawn from its id: a deletion,
    an insertion and a replacement by another part of its own text."""
    n = F.greatest(F.length(text), F.lit(1))

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(k)), n.cast("long")).cast("int")

    def part(k: int, size: int) -> Column:
        return F.substring(text, place(k) + 1, F.lit(size))

    def one(start: Column, stop: Column, new: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), new.alias("text"))

    return F.array(one(place(1), place(1) + 9, F.lit("")), one(place(2), place(2), F.concat(F.lit(" "), part(3, 24))),
                   one(place(4), place(4) + 16, part(5, 31)))


def op10_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text before and after its edits."""
    ranks, pattern = vocabulary()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    edited = docs.withColumn("edits", edits_of(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    return recount.count_edits(edited, ranks, pattern).select(
        "doc_id", "n_tokens_before", "n_tokens", "n_recoded", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("edited_sha256"))
