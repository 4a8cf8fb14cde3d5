"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import tiling


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the benchmark items that they contain."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = tiling.contaminated(tiling.tile_documents(docs, items))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"))
