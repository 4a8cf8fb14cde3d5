"""B2: dense item numbering (1..n) of rows inside each batch.

The reference numbers with ``ROW_NUMBER() OVER (PARTITION BY batch ORDER BY
...)``.  Planned literally, Spark sends every row of a batch to one task; the
accounts-payable extracts even put *all* rows in one batch (the batch key is
today's date), which becomes an ``Exchange SinglePartition``.  At scale one
batch can hold a third of the data, so the default path here is distributed:

1. range-partition the rows on (batch, order keys) and sort each partition;
2. tag every row with its partition id and its position inside the partition
   (``monotonically_increasing_id`` is consecutive within a partition), and
   write the tagged rows once to the shared checkpoint folder (a lineage cut).
   Both later branches must see the *same* tags: left to the optimizer, the
   two branches prune different columns, stop sharing the range exchange and
   sample different range bounds (rows then lose their offsets);
3. count rows per (partition, batch) -- a table of at most
   ``partitions + batches`` rows -- and turn the counts into per-batch
   starting offsets with a window over that small table;
4. join the offsets back; ``item = offset + position - first position + 1``.

The order keys must be a total order inside a batch (callers append a unique
id as the last key), otherwise neither path is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorry.session import stage


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_items(
    df: DataFrame,
    batch: Sequence[str],
    order: Sequence[str | Column],
    out: str = "cntitem",
    method: str = "range",
    partitions: int | None = None,
) -> DataFrame:
    """Add column ``out`` = 1..n inside each ``batch`` following ``order``.

    ``batch`` names columns (NULL is a batch of its own, as in SQL windows);
    ``order`` holds column names or sort expressions (``asc_nulls_last`` ...).
    ``method='window'`` is the plain window, kept for small inputs and as the
    test oracle of the distributed ``'range'`` path.
    """
    batch = list(batch)
    order_cols = [_as_col(c) for c in order]
    if method == "window":
        w = Window.partitionBy(*batch).orderBy(*order_cols)
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    if method != "range":
        raise ValueError(f"unknown numbering method {method!r}")

    keys = [F.col(b).asc_nulls_last() for b in batch] + order_cols
    # without an explicit count AQE sizes the ranges from the data (merging
    # adjacent ranges keeps them contiguous, which is all the offsets need)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    tagged = stage(
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("_nb_part", F.spark_partition_id())
        .withColumn("_nb_pos", F.monotonically_increasing_id()),
        "numbering",
    )
    before = Window.partitionBy(*batch).orderBy("_nb_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        tagged.groupBy("_nb_part", *batch)
        .agg(F.count(F.lit(1)).alias("_nb_n"), F.min("_nb_pos").alias("_nb_first"))
        .withColumn("_nb_offset", F.coalesce(F.sum("_nb_n").over(before), F.lit(0)))
        .select(
            F.col("_nb_part").alias("_sp_part"),
            *[F.col(b).alias(f"_sp_{i}") for i, b in enumerate(batch)],
            "_nb_offset",
            "_nb_first",
        )
    )
    cond = F.col("_nb_part") == F.col("_sp_part")
    for i, b in enumerate(batch):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_sp_{i}"))
    numbered = tagged.join(spans, cond, "inner").withColumn(
        out, (F.col("_nb_offset") + F.col("_nb_pos") - F.col("_nb_first") + 1).cast("long")
    )
    drop = ["_nb_part", "_nb_pos", "_sp_part", "_nb_offset", "_nb_first"] + [f"_sp_{i}" for i in range(len(batch))]
    return numbered.drop(*drop)
