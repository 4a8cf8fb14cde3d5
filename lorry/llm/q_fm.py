"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import fm

ACCEPT = 0.3


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a model of the labelled rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = fm.score(docs, fm.train(docs, labels))
    return scored.select("doc_id", fm.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
