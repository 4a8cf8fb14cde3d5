"""Query of operator 3."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import order
from lorry.session import ensure_checkpoint_dir

#: bytes as token ids; these two never occur in UTF-8
END, PAD = 255, 254


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte tokens in training order; every record read back from the shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lorry-stage/shards-{uuid.uuid4().hex}"
    layout = order.materialise(docs, F.col("text").cast("binary"), path, width=1, end=END, pad=PAD)
    back = order.read_shards(spark, layout)
    padding = F.when(F.col("sequence") == layout.sequences - 1,
                     F.length(F.regexp_replace(F.hex("ids"), f"((?:{PAD:02X})*)$", ""))).otherwise(2 * layout.length * layout.width)
    return back.select("slot", "sequence", (padding / 2 / layout.width).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
