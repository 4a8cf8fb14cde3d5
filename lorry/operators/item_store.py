"""T4: item numbers that are given once and kept.

A report pair (header and detail page) refers to one numbering, and what has
been sent to the accounting import must keep its numbers.  The store is a
table of (batch, row id, item) under a path.  Asking it for the numbers of
some rows numbers only those that it does not hold: the rows of a new batch
from 1 on, late rows of a batch behind its last number.  Numbers are added as
further files; what is there is never rewritten, so a run that is repeated
finds the same numbers.  A store belongs to one numbering (one set of rows
and one order); it has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.operators.numbering import number_items
from lorry.session import stage


class ItemNumbers:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p)

    def stored(self) -> DataFrame | None:
        """The numbers given so far, or None before the first."""
        return self.spark.read.parquet(self.path) if self._exists() else None

    def assign(self, df: DataFrame, batch: Sequence[str], row_id: str, order: Sequence[str | Column], reads: Sequence[str] = (),
               out: str = "cntitem") -> DataFrame:
        """``df`` with the number of every row within its batch.

        ``row_id`` is unique in a batch; ``order`` (which reads the columns
        ``reads``) ends with it.  New batches and late rows are numbered and
        added to the store first.
        """
        batch = list(batch)
        kept = self.stored()
        new = df.select(*dict.fromkeys([*batch, row_id, *reads]))
        if kept is not None:
            kept = kept.select(*[F.col(c).alias(f"_k_{c}") for c in (*batch, row_id)], F.col("item").alias("_item"))
            new = new.join(kept, _same(batch, row_id), "left_anti")
        new = stage(new, "new-items")
        if new.take(1):
            numbered = number_items(new, batch, order, out="_nth")
            if kept is not None:
                # one row a batch: where its numbers have got to
                last = kept.groupBy(*[f"_k_{b}" for b in batch]).agg(F.max("_item").alias("_last"))
                numbered = numbered.join(last, _same(batch), "left").withColumn("_nth", F.col("_nth") + F.coalesce("_last", F.lit(0)))
            numbered.select(*batch, row_id, F.col("_nth").alias("item")).write.mode("append").parquet(self.path)
        kept = self.stored()
        if kept is None:  # no rows so far
            return df.withColumn(out, F.lit(None).cast("long"))
        kept = kept.select(*[F.col(c).alias(f"_k_{c}") for c in (*batch, row_id)], F.col("item").alias(out))
        return df.join(kept, _same(batch, row_id), "inner").drop(*[f"_k_{c}" for c in (*batch, row_id)])


def _same(batch: Sequence[str], row_id: str | None = None) -> Column:
    """Equal batches (NULL is one) and row ids."""
    terms = [F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in batch]
    if row_id is not None:
        terms.append(F.col(row_id) == F.col(f"_k_{row_id}"))
    return reduce(lambda x, y: x & y, terms)
